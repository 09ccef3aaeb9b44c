"""Queries over the cross-sectional panel, risk, portfolios and backtests."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tapewire.functions.numeric import rounded
from tapewire.operators import backtest as bt
from tapewire.operators import panel as pn
from tapewire.operators import portfolio as pf
from tapewire.operators import risk as rk
from tapewire.operators import timeseries as ts
from tapewire.plans.bars import COMPLETE, FILLED_SQL, features_sql, round_sql
from tapewire.plans.registry import query
from tapewire.session import cut_lineage
from tapewire.sources.tables import BARS_SQL, bars

CUTOFF = "2000-12-31"
HOLDOUT = ("2001-01-01", "2001-06-30")
PLAN = bt.WalkForward(start="1998-07-01", end="2001-09-30", min_names=5)

FEATURES_SQL = f"{BARS_SQL}, {features_sql('bars')}, feat AS (SELECT * FROM features WHERE {COMPLETE})"
Z = ", ".join(
    f"({c} - avg({c}) OVER d) / nullif(stddev_samp({c}) OVER d, 0) AS {c}" for c in ts.PRICE_FEATURES
)
PANEL_SQL = f"""{FEATURES_SQL},
scored AS (
  SELECT ticker, dt, {Z}, forward_return, target_end_date,
    (rank() OVER r + (count(*) OVER (PARTITION BY dt, forward_return) - 1) / 2.0) / count(*) OVER d AS target_percentile
  FROM feat WINDOW d AS (PARTITION BY dt), r AS (PARTITION BY dt ORDER BY forward_return)),
panel AS (SELECT * FROM scored WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ts.PRICE_FEATURES)})
"""
PANEL_COLUMNS = [*ts.PRICE_FEATURES, "forward_return", "target_percentile"]


def features(spark, sf):
    return ts.price_features(bars(spark, sf))


@query(
    "xs_zscore",
    f"""WITH {FEATURES_SQL} SELECT ticker, dt,
round((return_20d - avg(return_20d) OVER d) / nullif(stddev_samp(return_20d) OVER d, 0), 6) AS z_return_20d,
round((rsi_14 - avg(rsi_14) OVER d) / nullif(stddev_samp(rsi_14) OVER d, 0), 6) AS z_rsi_14
FROM features WINDOW d AS (PARTITION BY dt)""",
)
def xs_zscore(spark, sf):
    rows = ts.price_features(bars(spark, sf), complete_only=False)
    z = {f"z_{c}": F.round(pn.zscore(F.col(c)), 6) for c in ("return_20d", "rsi_14")}
    return rows.select("ticker", "dt", *[c.alias(n) for n, c in z.items()])


@query(
    "xs_rank_pct",
    f"""WITH {BARS_SQL}
SELECT ticker, dt, round((rank() OVER (PARTITION BY dt ORDER BY volume) + (count(*) OVER (PARTITION BY dt, volume) - 1) / 2.0)
       / count(*) OVER (PARTITION BY dt), 6) AS volume_pct FROM bars""",
)
def xs_rank_pct(spark, sf):
    return bars(spark, sf).select("ticker", "dt", F.round(pn.rank_pct("volume"), 6).alias("volume_pct"))


@query(
    "xs_panel",
    f"WITH {PANEL_SQL} SELECT ticker, dt, {round_sql(*PANEL_COLUMNS)}, target_end_date FROM panel WHERE dt <= DATE '{CUTOFF}'",
)
def xs_panel(spark, sf):
    return rounded(pn.build_panel(features(spark, sf), CUTOFF), *PANEL_COLUMNS)


@query(
    "panel_join",
    f"""WITH {FEATURES_SQL},
a AS (SELECT ticker, dt, return_5d FROM features WHERE return_5d IS NOT NULL),
b AS (SELECT ticker, dt, volatility_20d FROM features WHERE volatility_20d IS NOT NULL),
c AS (SELECT ticker, dt, forward_return FROM features WHERE forward_return IS NOT NULL)
SELECT ticker, dt, {round_sql("return_5d", "volatility_20d", "forward_return")}
FROM a LEFT JOIN b USING (ticker, dt) LEFT JOIN c USING (ticker, dt)""",
)
def panel_join(spark, sf):
    rows = ts.price_features(bars(spark, sf), complete_only=False)
    a, b, c = (
        rows.select("ticker", "dt", n).where(F.col(n).isNotNull()) for n in ("return_5d", "volatility_20d", "forward_return")
    )
    joined = a.join(b, ["ticker", "dt"], "left").join(c, ["ticker", "dt"], "left")
    return rounded(joined, "return_5d", "volatility_20d", "forward_return")


@query(
    "purged_labels",
    f"""WITH {PANEL_SQL} SELECT ticker, count(*) AS n_rows, max(dt) AS last_date, max(target_end_date) AS last_end
FROM panel WHERE dt <= DATE '{CUTOFF}' AND target_end_date <= DATE '{CUTOFF}' GROUP BY ticker""",
)
def purged_labels(spark, sf):
    labeled = pn.purged(pn.build_panel(features(spark, sf), CUTOFF), CUTOFF)
    return labeled.groupBy("ticker").agg(
        F.count("*").alias("n_rows"), F.max("dt").alias("last_date"), F.max("target_end_date").alias("last_end")
    )


LABELED_SQL = f"""{PANEL_SQL},
labeled AS (SELECT * FROM panel WHERE dt <= DATE '{CUTOFF}' AND target_end_date <= DATE '{CUTOFF}'),
days AS (SELECT list(DISTINCT dt ORDER BY dt) AS d FROM labeled),
cut AS (SELECT d[1 + CAST(floor(len(d) * 0.8) AS BIGINT)] AS split FROM days)
"""


def labeled_panel(spark, sf):
    return pn.purged(pn.build_panel(features(spark, sf), CUTOFF), CUTOFF)


@query(
    "time_split",
    f"""WITH {LABELED_SQL} SELECT CASE WHEN dt <= split THEN 'train' ELSE 'validation' END AS part, count(*) AS n_rows,
min(dt) AS first_date, max(dt) AS last_date FROM labeled, cut GROUP BY 1""",
)
def time_split(spark, sf):
    return pn.time_split(labeled_panel(spark, sf)).groupBy("part").agg(
        F.count("*").alias("n_rows"), F.min("dt").alias("first_date"), F.max("dt").alias("last_date")
    )


IC_SQL = """
ranked AS (
  SELECT dt, rank() OVER (PARTITION BY dt ORDER BY return_20d) + (count(*) OVER (PARTITION BY dt, return_20d) - 1) / 2.0 AS a,
    rank() OVER (PARTITION BY dt ORDER BY forward_return) + (count(*) OVER (PARTITION BY dt, forward_return) - 1) / 2.0 AS b
  FROM feat),
ics AS (SELECT dt, count(*) AS n_names, corr(a, b) AS ic FROM ranked GROUP BY dt
        HAVING count(*) >= 5 AND min(a) < max(a) AND min(b) < max(b))
"""


@query("rank_ic", f"WITH {FEATURES_SQL}, {IC_SQL} SELECT dt, n_names, round(ic, 6) AS ic FROM ics")
def rank_ic(spark, sf):
    return rounded(pn.daily_rank_ic(features(spark, sf), "return_20d", "forward_return"), "ic")


@query(
    "hist_mean",
    f"WITH {FEATURES_SQL} SELECT ticker, round(avg(daily_return) * 252, 6) AS hist_annual FROM feat GROUP BY ticker",
)
def hist_mean(spark, sf):
    return rounded(pn.hist_mean(features(spark, sf)), "hist_annual")


TILT_SQL = f"""{FEATURES_SQL}, {IC_SQL},
skill AS (SELECT avg(ic) AS ic FROM ics),
base AS (SELECT ticker, avg(daily_return) * 252 AS hist_annual FROM feat GROUP BY ticker),
pct AS (SELECT ticker, dt, (rank() OVER (PARTITION BY dt ORDER BY return_20d)
        + (count(*) OVER (PARTITION BY dt, return_20d) - 1) / 2.0) / count(*) OVER (PARTITION BY dt) AS score FROM feat),
last AS (SELECT ticker, arg_max(score, dt) AS score FROM pct GROUP BY ticker),
tilted AS (SELECT ticker, score, ic, hist_annual,
  greatest(-0.5, least(0.5, hist_annual + (score - 0.5) * 2 * greatest(0, ic) * 0.15)) AS mu
  FROM last JOIN base USING (ticker), skill)
"""


def tilted(spark, sf):
    rows = cut_lineage(features(spark, sf))
    skill = pn.daily_rank_ic(rows, "return_20d", "forward_return").agg(F.avg("ic")).first()[0]
    latest = ts.latest_row(rows.select("ticker", "dt", pn.rank_pct("return_20d").alias("score")))
    joined = latest.join(pn.hist_mean(rows), "ticker")
    mu = pn.tilted_return(F.col("hist_annual"), F.col("score"), F.lit(skill))
    return joined.select("ticker", "score", F.lit(skill).alias("ic"), "hist_annual", mu.alias("mu"))


@query("tilt_returns", f"WITH {TILT_SQL} SELECT ticker, {round_sql('score', 'ic', 'hist_annual', 'mu')} FROM tilted")
def tilt_returns(spark, sf):
    return rounded(tilted(spark, sf), "score", "ic", "hist_annual", "mu")


@query(
    "top_bottom_k",
    f"""WITH {TILT_SQL} SELECT * FROM (
(SELECT 'top' AS side, ticker, {round_sql("score", "mu")} FROM tilted ORDER BY tilted.score DESC, ticker LIMIT 10)
UNION ALL (SELECT 'bottom', ticker, {round_sql("score", "mu")} FROM tilted ORDER BY tilted.score, ticker LIMIT 10))""",
)
def top_bottom_k(spark, sf):
    rows = tilted(spark, sf).select("ticker", "score", "mu")
    top = rows.orderBy(F.desc("score"), "ticker").limit(10).withColumn("side", F.lit("top"))
    bottom = rows.orderBy("score", "ticker").limit(10).withColumn("side", F.lit("bottom"))
    return rounded(top.unionByName(bottom), "score", "mu")


RETURNS_SQL = f"""{FILLED_SQL},
whole AS (SELECT dt FROM filled GROUP BY dt HAVING count(close) = (SELECT count(DISTINCT ticker) FROM filled)),
moved AS (SELECT ticker, dt, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY dt), 0) - 1 AS ret
          FROM filled JOIN whole USING (dt)),
rets AS (SELECT * FROM moved WHERE ret IS NOT NULL)
"""
COV_SQL = f"""{RETURNS_SQL},
x AS (SELECT ticker, dt, ret - avg(ret) OVER (PARTITION BY ticker) AS x FROM rets),
size AS (SELECT count(DISTINCT dt) AS n, count(DISTINCT ticker) AS p FROM x),
pairs AS (SELECT a.ticker AS ticker_i, b.ticker AS ticker_j, sum(a.x * b.x) / max(n) AS s
          FROM x a JOIN x b ON a.dt = b.dt AND a.ticker <= b.ticker, size GROUP BY ALL),
norms AS (SELECT sum(CASE WHEN ticker_i = ticker_j THEN s END) AS trace,
                 sum(CASE WHEN ticker_i = ticker_j THEN s * s ELSE 2 * s * s END) AS frob FROM pairs),
quart AS (SELECT sum(q * q) AS quartic FROM (SELECT dt, sum(x * x) AS q FROM x GROUP BY dt)),
parts AS (SELECT n, p, trace / p AS mu, (frob - 2 * (trace / p) * trace + p * (trace / p) * (trace / p)) / p AS delta,
                 (quartic / n - frob) / (p * n) AS beta FROM norms, quart, size),
lw AS (SELECT *, coalesce(least(beta, delta) / nullif(delta, 0), 0) AS shrinkage FROM parts),
cov AS (SELECT ticker_i, ticker_j,
  ((1 - shrinkage) * s + CASE WHEN ticker_i = ticker_j THEN shrinkage * mu ELSE 0 END) * 252 AS cov FROM pairs, lw),
ridged AS (SELECT ticker_i, ticker_j, cov + CASE WHEN ticker_i = ticker_j
  THEN 1e-4 * (SELECT avg(cov) FROM cov WHERE ticker_i = ticker_j) ELSE 0 END AS cov FROM cov)
"""


def filled_prices(spark, sf):
    """Filled bars, written once: the risk and backtest steps read them several times."""
    return cut_lineage(ts.forward_filled(bars(spark, sf)))


def filled_returns(spark, sf):
    return rk.formation_returns(filled_prices(spark, sf))


@query("formation_returns", f"WITH {RETURNS_SQL} SELECT ticker, dt, round(ret, 6) AS ret FROM rets")
def formation_returns(spark, sf):
    return rounded(filled_returns(spark, sf), "ret")


@query(
    "lw_shrinkage",
    f"WITH {COV_SQL} SELECT CAST(n AS BIGINT) AS n, CAST(p AS BIGINT) AS p, {round_sql('mu', 'delta', 'beta', 'shrinkage')} FROM lw",
)
def lw_shrinkage(spark, sf):
    return rounded(rk.ledoit_wolf(filled_returns(spark, sf)), "mu", "delta", "beta", "shrinkage")


@query("cov_matrix", f"WITH {COV_SQL} SELECT ticker_i, ticker_j, round(cov, 6) AS cov FROM cov")
def cov_matrix(spark, sf):
    return rounded(rk.covariance(filled_returns(spark, sf)), "cov")


@query("cov_ridge", f"WITH {COV_SQL} SELECT ticker_i, ticker_j, round(cov, 6) AS cov FROM ridged")
def cov_ridge(spark, sf):
    return rounded(rk.ridged(rk.covariance(filled_returns(spark, sf))), "cov")


MU_SQL = f"""{COV_SQL},
means AS (SELECT ticker, avg(ret) * 252 AS mu FROM rets GROUP BY ticker),
diag AS (SELECT ticker_i AS ticker, cov AS variance FROM ridged WHERE ticker_i = ticker_j),
aligned AS (SELECT ticker, mu, variance, greatest(mu, 0) / nullif(variance, 0) AS sharpe_score,
                   1 / nullif(variance, 0) AS inverse_score
            FROM means JOIN diag USING (ticker) WHERE isfinite(mu) AND isfinite(variance))
"""


def cap_sql(score: str, name: str) -> str:
    """CTEs for weights capped at 5 %: repeated redistribution, written out."""
    rounds = [f"{name}0 AS (SELECT ticker, {score} AS score, false AS capped, 0.0 AS weight FROM aligned)"]
    for i in range(1, 21):
        rounds.append(
            f"""{name}{i} AS MATERIALIZED (SELECT ticker, score, capped OR share > 0.05 + 1e-13 AS capped,
  CASE WHEN capped OR share > 0.05 + 1e-13 THEN 0.05 ELSE share END AS weight
  FROM (SELECT *, score * (1 - 0.05 * (SELECT count(*) FROM {name}{i - 1} WHERE capped))
    / nullif((SELECT sum(score) FROM {name}{i - 1} WHERE NOT capped), 0) AS share FROM {name}{i - 1}))"""
        )
    rounds.append(f"{name} AS (SELECT ticker, weight FROM {name}20)")
    return ",\n".join(rounds)


def aligned(spark, sf):
    """Expected return and variance of the names that have both, as one written table."""
    returns = cut_lineage(filled_returns(spark, sf))
    means = returns.groupBy("ticker").agg((F.avg("ret") * 252).alias("mu"))
    cov = rk.ridged(rk.covariance(returns))
    same = F.col("ticker_i") == F.col("ticker_j")
    variance = cov.where(same).select(F.col("ticker_i").alias("ticker"), F.col("cov").alias("variance"))
    both = means.join(variance, "ticker")
    for name in ("mu", "variance"):
        both = both.where(F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(name) != float("inf")))
    return cut_lineage(both), cov, returns


def sharpe_score(both):
    return both.withColumn("score", F.greatest("mu", F.lit(0.0)) / F.nullif("variance", F.lit(0.0)))


def inverse_score(both):
    return both.withColumn("score", 1 / F.nullif(F.col("variance"), F.lit(0.0)))


@query("align_inner", f"WITH {MU_SQL} SELECT ticker, {round_sql('mu', 'variance')} FROM aligned")
def align_inner(spark, sf):
    return rounded(aligned(spark, sf)[0], "mu", "variance")


@query("capped_weights", f"WITH {MU_SQL}, {cap_sql('sharpe_score', 'w')} SELECT ticker, round(weight, 6) AS weight FROM w")
def capped_weights(spark, sf):
    weights = pf.capped_weights(sharpe_score(aligned(spark, sf)[0]))
    return rounded(weights.select("ticker", "weight"), "weight")


@query("minvar_weights", f"WITH {MU_SQL}, {cap_sql('inverse_score', 'w')} SELECT ticker, round(weight, 6) AS weight FROM w")
def minvar_weights(spark, sf):
    weights = pf.capped_weights(inverse_score(aligned(spark, sf)[0]))
    return rounded(weights.select("ticker", "weight"), "weight")


@query(
    "weights_feasible",
    f"WITH {BARS_SQL} SELECT count(*) AS n_names, count(*) * 0.05 >= 1 AS feasible FROM (SELECT DISTINCT ticker FROM bars)",
)
def weights_feasible(spark, sf):
    return pf.feasible(bars(spark, sf).select("ticker").distinct())


@query(
    "portfolio_stats",
    f"""WITH {MU_SQL}, {cap_sql("sharpe_score", "w")},
gain AS (SELECT sum(weight * mu) AS expected_return FROM w JOIN aligned USING (ticker)),
risk AS (SELECT sqrt(sum(a.weight * b.weight * cov * CASE WHEN ticker_i = ticker_j THEN 1 ELSE 2 END)) AS volatility
         FROM ridged JOIN w a ON a.ticker = ticker_i JOIN w b ON b.ticker = ticker_j)
SELECT round(expected_return, 6) AS expected_return, round(volatility, 6) AS volatility,
       round(expected_return / nullif(volatility, 0), 6) AS sharpe FROM gain, risk""",
)
def portfolio_stats(spark, sf):
    both, cov, _ = aligned(spark, sf)
    stats = pf.portfolio_stats(pf.capped_weights(sharpe_score(both)), both.select("ticker", "mu"), cov)
    return rounded(stats, "expected_return", "volatility", "sharpe")


@query(
    "turnover",
    f"""WITH {MU_SQL}, {cap_sql("sharpe_score", "w")}, {cap_sql("inverse_score", "v")}
SELECT round(sum(abs(w.weight - coalesce(v.weight, 0))), 6) AS turnover,
       round(sum(abs(w.weight - coalesce(v.weight, 0))) * 0.001, 6) AS cost FROM w LEFT JOIN v USING (ticker)""",
)
def turnover(spark, sf):
    both = aligned(spark, sf)[0]
    moved = pf.turnover(pf.capped_weights(sharpe_score(both)), pf.capped_weights(inverse_score(both)))
    return rounded(moved, "turnover", "cost")


DAILY_SQL = f"""{MU_SQL}, {cap_sql("sharpe_score", "w")},
opt AS (SELECT dt, sum(ret * weight) AS ret FROM rets JOIN w USING (ticker) GROUP BY dt),
eq AS (SELECT dt, sum(ret) / (SELECT count(*) FROM w) AS ret FROM rets JOIN w USING (ticker) GROUP BY dt),
daily AS (SELECT 'optimized' AS strategy, dt, ret FROM opt UNION ALL SELECT 'equal_weight', dt, ret FROM eq),
curve AS (SELECT strategy, dt, product(1 + ret) OVER (PARTITION BY strategy ORDER BY dt ROWS UNBOUNDED PRECEDING) AS equity
          FROM daily)
"""


def both_strategies(spark, sf):
    both, _, returns = aligned(spark, sf)
    weights = pf.capped_weights(sharpe_score(both)).select("ticker", "weight")
    equal = weights.select("ticker", (1 / F.count("*").over(Window.partitionBy())).alias("weight"))
    optimized = pf.daily_returns(returns, weights).withColumn("strategy", F.lit("optimized"))
    return optimized.unionByName(pf.daily_returns(returns, equal).withColumn("strategy", F.lit("equal_weight")))


@query("portfolio_daily", f"WITH {DAILY_SQL} SELECT strategy, dt, round(ret, 6) AS ret FROM daily")
def portfolio_daily(spark, sf):
    return rounded(both_strategies(spark, sf), "ret")


@query(
    "portfolio_net",
    f"""WITH {DAILY_SQL} SELECT dt, round(ret - CASE WHEN dt = (SELECT min(dt) FROM opt) THEN 0.001 ELSE 0 END, 6) AS ret
FROM opt""",
)
def portfolio_net(spark, sf):
    both, _, returns = aligned(spark, sf)
    daily = pf.daily_returns(returns, pf.capped_weights(sharpe_score(both)))
    return rounded(pf.net_of_cost(daily, pf.COST), "ret")


@query("equity_curve", f"WITH {DAILY_SQL} SELECT strategy, dt, round(ln(equity), 6) AS log_equity FROM curve")
def equity_curve(spark, sf):
    curve = bt.equity_curve(both_strategies(spark, sf))
    return curve.select("strategy", "dt", F.round(F.log("equity"), 6).alias("log_equity"))


@query(
    "max_drawdown",
    f"""WITH {DAILY_SQL}, depth AS (SELECT strategy, equity / max(equity) OVER (PARTITION BY strategy ORDER BY dt) - 1 AS d
FROM curve) SELECT strategy, round(min(d), 6) AS max_drawdown FROM depth GROUP BY strategy""",
)
def max_drawdown(spark, sf):
    return rounded(bt.drawdown(bt.equity_curve(both_strategies(spark, sf))), "max_drawdown")


@query(
    "buy_hold_curve",
    f"""WITH {FILLED_SQL}, rel AS (SELECT dt, close / nullif(first_value(close) OVER (PARTITION BY ticker ORDER BY dt), 0) AS rel
FROM filled WHERE dt BETWEEN DATE '{HOLDOUT[0]}' AND DATE '{HOLDOUT[1]}')
SELECT dt, round(avg(rel), 6) AS equity FROM rel GROUP BY dt""",
)
def buy_hold_curve(spark, sf):
    low, high = (F.lit(d).cast("date") for d in HOLDOUT)
    segment = ts.forward_filled(bars(spark, sf)).where(F.col("dt").between(low, high))
    return rounded(bt.buy_and_hold(segment), "equity")


@query(
    "final_holdout",
    f"""WITH {FILLED_SQL},
whole AS (SELECT dt FROM filled GROUP BY dt HAVING count(close) = (SELECT count(DISTINCT ticker) FROM filled)),
formed AS (SELECT ticker, dt, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY dt), 0) - 1 AS ret
           FROM filled JOIN whole USING (dt) WHERE dt < DATE '{HOLDOUT[0]}'),
aligned AS (SELECT ticker, greatest(avg(ret), 0) / nullif(var_samp(ret), 0) AS sharpe_score FROM formed
            WHERE ret IS NOT NULL GROUP BY ticker),
{cap_sql("sharpe_score", "w")},
held AS (SELECT ticker, dt, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY dt), 0) - 1 AS ret FROM filled
         WHERE dt BETWEEN DATE '{HOLDOUT[0]}' AND DATE '{HOLDOUT[1]}'),
gross AS (SELECT dt, sum(ret * weight) AS o, sum(ret) / (SELECT count(*) FROM w) AS e FROM held JOIN w USING (ticker)
          WHERE ret IS NOT NULL GROUP BY dt),
daily AS (
  SELECT 'optimized' AS strategy, dt, o - CASE WHEN dt = (SELECT min(dt) FROM gross) THEN
    0.001 * (SELECT sum(abs(weight)) FROM w) ELSE 0 END AS ret FROM gross
  UNION ALL SELECT 'equal_weight', dt, e FROM gross)
SELECT strategy, count(*) AS n_days, round(ln(product(1 + ret)), 6) AS log_growth,
  round(stddev_samp(ret) * sqrt(252), 6) AS volatility, round(avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(252), 6) AS sharpe
FROM daily GROUP BY strategy""",
)
def final_holdout(spark, sf):
    """Weights fixed before the holdout; the optimised side pays for buying in, the equal side does not."""
    low, high = (F.lit(d).cast("date") for d in HOLDOUT)
    prices = filled_prices(spark, sf)
    formed = rk.formation_returns(prices).where(F.col("dt") < low)
    figures = formed.groupBy("ticker").agg(F.avg("ret").alias("mu"), F.var_samp("ret").alias("variance"))
    weights = pf.capped_weights(sharpe_score(figures)).select("ticker", "weight")
    equal = weights.select("ticker", (1 / F.count("*").over(Window.partitionBy())).alias("weight"))
    segment = prices.where(F.col("dt").between(low, high))
    moves = segment.select("ticker", "dt", ts.pct_change(F.col("close")).alias("ret")).where("ret IS NOT NULL")
    bought = weights.agg(F.sum(F.abs("weight"))).first()[0]
    optimized = pf.net_of_cost(pf.daily_returns(moves, weights), pf.COST * bought)
    daily = optimized.withColumn("strategy", F.lit("optimized")).unionByName(
        pf.daily_returns(moves, equal).withColumn("strategy", F.lit("equal_weight"))
    )
    return bt.summary(daily).select(
        "strategy", "n_days", F.round(F.log("total_growth"), 6).alias("log_growth"),
        F.round("volatility", 6).alias("volatility"), F.round("sharpe", 6).alias("sharpe"),
    )


CUTOFFS_SQL = f"""
cutoffs AS (
  SELECT row_number() OVER (ORDER BY c) AS window_id, CAST(c AS DATE) AS cutoff, CAST(c + INTERVAL 3 MONTH AS DATE) AS next_cutoff
  FROM (SELECT unnest(generate_series(
    greatest(DATE '{PLAN.start}', CAST((SELECT min(dt) FROM filled) + INTERVAL 36 MONTH AS DATE))::TIMESTAMP,
    least(DATE '{PLAN.end}', (SELECT max(dt) FROM filled))::TIMESTAMP, INTERVAL 3 MONTH)) AS c))
"""
WALK_SQL = f"""{RETURNS_SQL}, {CUTOFFS_SQL}, {features_sql("filled")},
feat AS (SELECT * FROM features WHERE {COMPLETE}), {IC_SQL},
pct AS (SELECT ticker, dt, daily_return, (rank() OVER (PARTITION BY dt ORDER BY return_20d)
        + (count(*) OVER (PARTITION BY dt, return_20d) - 1) / 2.0) / count(*) OVER (PARTITION BY dt) AS score FROM feat),
known AS (SELECT window_id, dt, row_number() OVER (PARTITION BY window_id ORDER BY dt) - 1 AS nth,
                 count(*) OVER (PARTITION BY window_id) AS n
          FROM cutoffs JOIN (SELECT dt, max(target_end_date) AS e FROM feat GROUP BY dt) ON e <= cutoff),
skill AS (SELECT window_id, avg(ic) AS ic FROM known LEFT JOIN ics USING (dt) WHERE nth > floor(n * 0.8) GROUP BY window_id),
risk AS (SELECT window_id, ticker, var_samp(ret) * 252 AS variance, count(*) AS n FROM cutoffs JOIN rets ON dt <= cutoff GROUP BY ALL),
drift AS (SELECT window_id, ticker, avg(daily_return) * 252 AS base, arg_max(score, dt) AS score
          FROM cutoffs JOIN pct ON dt <= cutoff GROUP BY ALL),
formed AS (SELECT window_id, ticker, variance, coalesce(ic, 0) AS ic, count(*) OVER (PARTITION BY window_id) AS n_names,
    greatest(-0.5, least(0.5, base + (score - 0.5) * 2 * greatest(0, coalesce(ic, 0)) * 0.15)) AS mu
  FROM risk JOIN drift USING (window_id, ticker) LEFT JOIN skill USING (window_id) WHERE n >= 300),
c0 AS (SELECT *, greatest(mu, 0) / nullif(variance, 0) AS score, false AS capped, 0.0 AS weight FROM formed WHERE n_names >= 5),
{", ".join(f'''c{i} AS MATERIALIZED (SELECT * EXCLUDE (share) REPLACE (capped OR share > 0.05 + 1e-13 AS capped, CASE WHEN capped OR share > 0.05 + 1e-13 THEN 0.05
  ELSE share END AS weight) FROM (SELECT *, score * (1 - 0.05 * count(*) FILTER (capped) OVER g)
  / nullif(sum(score) FILTER (NOT capped) OVER g, 0) AS share FROM c{i - 1} WINDOW g AS (PARTITION BY window_id)))''' for i in range(1, 21))},
wts AS (SELECT 'optimized' AS strategy, window_id, ticker, ic, n_names, coalesce(weight, 0) AS weight FROM c20
        UNION ALL SELECT 'equal_weight', window_id, ticker, ic, n_names, 1.0 / n_names FROM c20),
costs AS (SELECT a.strategy, a.window_id, max(a.ic) AS ic, max(a.n_names) AS n_names, sum(abs(a.weight - coalesce(b.weight, 0))) AS turnover
  FROM wts a LEFT JOIN wts b ON b.strategy = a.strategy AND b.ticker = a.ticker AND b.window_id = a.window_id - 1 GROUP BY ALL),
inside AS (SELECT window_id, ticker, dt, close / nullif(lag(close) OVER (PARTITION BY window_id, ticker ORDER BY dt), 0) - 1 AS ret
  FROM cutoffs JOIN filled ON dt > cutoff AND dt <= least(next_cutoff, DATE '{PLAN.end}')),
gross AS (SELECT strategy, window_id, dt, sum(ret * weight) AS ret FROM inside JOIN wts USING (window_id, ticker)
  WHERE ret IS NOT NULL GROUP BY ALL),
daily AS (SELECT strategy, window_id, dt, ic, n_names, turnover,
  ret - CASE WHEN row_number() OVER (PARTITION BY strategy, window_id ORDER BY dt) = 1 THEN 0.001 * turnover ELSE 0 END AS ret
  FROM gross JOIN costs USING (strategy, window_id))
"""


def walk(spark, sf):
    prices = filled_prices(spark, sf)
    return bt.walk_forward(prices, cut_lineage(ts.price_features(prices)), PLAN), prices


@query("rebalance_cutoffs", f"WITH {FILLED_SQL}, {CUTOFFS_SQL} SELECT window_id, cutoff, next_cutoff FROM cutoffs")
def rebalance_cutoffs(spark, sf):
    span = bars(spark, sf).agg(F.min("dt").alias("a"), F.max("dt").alias("z")).first()
    return bt.rebalance_cutoffs(spark, span["a"], span["z"], PLAN)


@query("walk_forward", f"WITH {WALK_SQL} SELECT strategy, window_id, dt, round(ret, 6) AS ret FROM daily")
def walk_forward(spark, sf):
    return rounded(walk(spark, sf)[0]["daily"].select("strategy", "window_id", "dt", "ret"), "ret")


@query(
    "window_results",
    f"""WITH {WALK_SQL}, t AS (SELECT window_id, min(dt) AS first_day, max(dt) AS last_day, max(n_names) AS n_names,
  max(ic) AS validation_ic, max(CASE WHEN strategy = 'optimized' THEN turnover END) AS turnover,
  product(1 + ret) FILTER (strategy = 'optimized') - 1 AS optimized_return,
  product(1 + ret) FILTER (strategy = 'equal_weight') - 1 AS equal_weight_return FROM daily GROUP BY window_id)
SELECT window_id, first_day, last_day, n_names, round(validation_ic, 6) AS validation_ic, round(turnover, 6) AS turnover,
  round(ln(1 + optimized_return), 6) AS log_optimized, round(ln(1 + equal_weight_return), 6) AS log_equal_weight,
  optimized_return > equal_weight_return AS beat_equal_weight FROM t""",
)
def window_results(spark, sf):
    table = bt.window_results(walk(spark, sf)[0]["daily"])
    logs = {f"log_{s}": F.round(F.log(1 + F.col(f"{s}_return")), 6) for s in ("optimized", "equal_weight")}
    table = table.withColumns(logs).drop("optimized_return", "equal_weight_return")
    return rounded(table, "validation_ic", "turnover")


@query(
    "strategy_summary",
    f"""WITH {WALK_SQL},
held AS (SELECT ticker, dt, close / nullif(first_value(close) OVER (PARTITION BY ticker ORDER BY dt), 0) AS rel FROM filled
  WHERE dt >= (SELECT min(dt) FROM daily) AND dt <= DATE '{PLAN.end}'),
level AS (SELECT dt, avg(rel) AS equity FROM held GROUP BY dt),
three AS (SELECT strategy, dt, ret FROM daily UNION ALL
  SELECT 'buy_and_hold', dt, r FROM (SELECT dt, equity / lag(equity) OVER (ORDER BY dt) - 1 AS r FROM level) WHERE r IS NOT NULL),
curve AS (SELECT strategy, dt, product(1 + ret) OVER (PARTITION BY strategy ORDER BY dt ROWS UNBOUNDED PRECEDING) AS equity FROM three),
deep AS (SELECT strategy, min(d) AS dd FROM (SELECT strategy, equity / max(equity) OVER (PARTITION BY strategy ORDER BY dt) - 1 AS d
  FROM curve) GROUP BY strategy)
SELECT strategy, count(*) AS n_days, round(ln(product(1 + ret)), 6) AS log_growth,
  round(ln(product(1 + ret)) * 252 / count(*), 6) AS log_annualized, round(stddev_samp(ret) * sqrt(252), 6) AS volatility,
  round(avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(252), 6) AS sharpe, round(max(dd), 6) AS max_drawdown
FROM three JOIN deep USING (strategy) GROUP BY strategy""",
)
def strategy_summary(spark, sf):
    result, prices = walk(spark, sf)
    daily = cut_lineage(result["daily"].select("strategy", "dt", "ret"))
    first = daily.agg(F.min("dt")).first()[0]
    held = prices.where((F.col("dt") >= F.lit(first)) & (F.col("dt") <= F.lit(PLAN.end).cast("date")))
    hold = bt.curve_returns(bt.buy_and_hold(held)).withColumn("strategy", F.lit("buy_and_hold"))
    return bt.summary(daily.unionByName(hold)).select(
        "strategy", "n_days",
        F.round(F.log("total_growth"), 6).alias("log_growth"),
        F.round(F.log(1 + F.col("annualized_return")), 6).alias("log_annualized"),
        *[F.round(c, 6).alias(c) for c in ("volatility", "sharpe", "max_drawdown")],
    )
