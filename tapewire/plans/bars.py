"""Queries over daily bars: rolling features, labels, calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewire.functions.numeric import rounded
from tapewire.operators import timeseries as ts
from tapewire.plans.registry import query
from tapewire.sources.tables import BARS_SQL, bars

CUTOFF = "2000-12-31"

FILLED_SQL = f"""{BARS_SQL},
grid AS (SELECT t.ticker, d.dt FROM (SELECT DISTINCT ticker FROM bars) t, (SELECT DISTINCT dt FROM bars) d),
filled AS (
  SELECT * FROM (
    SELECT ticker, dt,
      last_value(open IGNORE NULLS) OVER w AS open, last_value(high IGNORE NULLS) OVER w AS high,
      last_value(low IGNORE NULLS) OVER w AS low, last_value(close IGNORE NULLS) OVER w AS close,
      last_value(volume IGNORE NULLS) OVER w AS volume
    FROM grid LEFT JOIN bars USING (ticker, dt)
    WINDOW w AS (PARTITION BY ticker ORDER BY dt ROWS UNBOUNDED PRECEDING))
  WHERE close IS NOT NULL)
"""


def features_sql(source: str) -> str:
    """CTEs `features` over a bars-like CTE: twelve features, forward return, its end date."""
    return f"""
moves AS (
  SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS r, close - lag(close) OVER w AS move
  FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY dt)),
swings AS (SELECT *, CASE WHEN move IS NULL THEN NULL WHEN move > 0 THEN move ELSE 0 END AS gain,
                  CASE WHEN move IS NULL THEN NULL WHEN move < 0 THEN -move ELSE 0 END AS loss FROM moves),
features AS (
  SELECT ticker, dt, r AS daily_return,
    close / nullif(lag(close, 5) OVER w, 0) - 1 AS return_5d,
    close / nullif(lag(close, 20) OVER w, 0) - 1 AS return_20d,
    close / nullif(lag(close, 60) OVER w, 0) - 1 AS return_60d,
    CASE WHEN count(r) OVER w20 = 20 THEN stddev_samp(r) OVER w20 END AS volatility_20d,
    CASE WHEN count(r) OVER w60 = 60 THEN stddev_samp(r) OVER w60 END AS volatility_60d,
    close / nullif(CASE WHEN count(close) OVER w10 = 10 THEN avg(close) OVER w10 END, 0) - 1 AS ma_10_gap,
    close / nullif(CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END, 0) - 1 AS ma_50_gap,
    close / nullif(CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END, 0) - 1 AS ma_200_gap,
    CASE WHEN count(gain) OVER w14 = 14 THEN
      (100 - 100 / (1 + avg(gain) OVER w14 / nullif(avg(loss) OVER w14, 0))) / 100 END AS rsi_14,
    volume / nullif(lag(volume, 20) OVER w, 0) - 1 AS volume_change_20d,
    CASE WHEN count(volume) OVER w20 = 20 THEN
      (volume - avg(volume) OVER w20) / nullif(stddev_samp(volume) OVER w20, 0) END AS volume_z_20d,
    lead(close, 20) OVER w / nullif(close, 0) - 1 AS forward_return,
    lead(dt, 20) OVER w AS target_end_date
  FROM swings
  WINDOW w AS (PARTITION BY ticker ORDER BY dt),
    w10 AS (PARTITION BY ticker ORDER BY dt ROWS 9 PRECEDING), w14 AS (PARTITION BY ticker ORDER BY dt ROWS 13 PRECEDING),
    w20 AS (PARTITION BY ticker ORDER BY dt ROWS 19 PRECEDING), w50 AS (PARTITION BY ticker ORDER BY dt ROWS 49 PRECEDING),
    w60 AS (PARTITION BY ticker ORDER BY dt ROWS 59 PRECEDING), w200 AS (PARTITION BY ticker ORDER BY dt ROWS 199 PRECEDING))
"""


COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*ts.PRICE_FEATURES, "forward_return", "target_end_date"])


def round_sql(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


@query(
    "label_next_day",
    f"""WITH {BARS_SQL},
ahead AS (SELECT ticker, lead(close) OVER (PARTITION BY ticker ORDER BY dt) / nullif(close, 0) - 1 AS r FROM bars)
SELECT ticker, CASE WHEN r > 0.015 THEN 'spike' WHEN r < -0.015 THEN 'crash' ELSE 'neutral' END AS label,
       count(*) AS n FROM ahead WHERE r IS NOT NULL GROUP BY ALL ORDER BY ticker, label""",
)
def label_next_day(spark, sf):
    labels = ts.next_day_label(bars(spark, sf))
    return labels.groupBy("ticker", "label").agg(F.count("*").alias("n")).orderBy("ticker", "label")


@query(
    "returns_k",
    f"""WITH {BARS_SQL} SELECT ticker, dt,
{", ".join(f"round(close / nullif(lag(close, {k}) OVER w, 0) - 1, 6) AS return_{k}d" for k in (1, 3, 5, 10, 20, 60))}
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY dt)""",
)
def returns_k(spark, sf):
    return rounded(ts.returns(bars(spark, sf)), *[f"return_{k}d" for k in (1, 3, 5, 10, 20, 60)])


@query(
    "rolling_mean",
    f"""WITH {BARS_SQL} SELECT ticker, dt,
{", ".join(f"round(CASE WHEN count(close) OVER w{k} = {k} THEN avg(close) OVER w{k} END, 6) AS mean_{k}" for k in (10, 50, 200))}
FROM bars WINDOW {", ".join(f"w{k} AS (PARTITION BY ticker ORDER BY dt ROWS {k - 1} PRECEDING)" for k in (10, 50, 200))}""",
)
def rolling_mean(spark, sf):
    means = {f"mean_{k}": F.round(ts.rolling_mean(F.col("close"), k), 6) for k in (10, 50, 200)}
    return bars(spark, sf).select("ticker", "dt", *[c.alias(n) for n, c in means.items()])


@query(
    "rolling_std",
    f"""WITH {BARS_SQL},
moves AS (SELECT ticker, dt, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY dt), 0) - 1 AS r FROM bars)
SELECT ticker, dt,
{", ".join(f"round(CASE WHEN count(r) OVER w{k} = {k} THEN stddev_samp(r) OVER w{k} END, 6) AS std_{k}" for k in (10, 20, 60))}
FROM moves WINDOW {", ".join(f"w{k} AS (PARTITION BY ticker ORDER BY dt ROWS {k - 1} PRECEDING)" for k in (10, 20, 60))}""",
)
def rolling_std(spark, sf):
    moves = bars(spark, sf).select("ticker", "dt", ts.pct_change(F.col("close")).alias("r"))
    stds = {f"std_{k}": F.round(ts.rolling_std(F.col("r"), k), 6) for k in (10, 20, 60)}
    return moves.select("ticker", "dt", *[c.alias(n) for n, c in stds.items()])


@query(
    "rsi",
    f"WITH {BARS_SQL}, {features_sql('bars')} SELECT ticker, dt, round(rsi_14 * 100, 6) AS rsi FROM features",
)
def rsi(spark, sf):
    return rounded(ts.rsi(bars(spark, sf)), "rsi")


@query(
    "forward_return",
    f"""WITH {BARS_SQL}, {features_sql("bars")}
SELECT ticker, dt, round(forward_return, 6) AS forward_return, target_end_date FROM features""",
)
def forward_return(spark, sf):
    return rounded(ts.forward_return(bars(spark, sf)), "forward_return")


@query(
    "features_price12",
    f"""WITH {BARS_SQL}, {features_sql("bars")}
SELECT ticker, dt, {round_sql(*ts.PRICE_FEATURES, "forward_return")}, target_end_date FROM features WHERE {COMPLETE}""",
)
def features_price12(spark, sf):
    return rounded(ts.price_features(bars(spark, sf)), *ts.PRICE_FEATURES, "forward_return")


MARKET_SQL = """
daily AS (SELECT *, lag(close) OVER w AS before, close / nullif(lag(close) OVER w, 0) - 1 AS return_1d
          FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY dt)),
market AS (
  SELECT ticker, dt, return_1d, close / nullif(lag(close, 3) OVER w, 0) - 1 AS return_3d,
    close / nullif(lag(close, 5) OVER w, 0) - 1 AS return_5d, close / nullif(lag(close, 10) OVER w, 0) - 1 AS return_10d,
    CASE WHEN count(return_1d) OVER w10 = 10 THEN stddev_samp(return_1d) OVER w10 END AS volatility_10d,
    (high - low) / nullif(close, 0) AS hl_range,
    CASE WHEN count(volume) OVER w10 = 10 THEN avg(volume) OVER w10 END AS volume_avg_10d,
    volume / nullif(CASE WHEN count(volume) OVER w10 = 10 THEN avg(volume) OVER w10 END, 0) AS volume_ratio,
    (open - before) / nullif(before, 0) AS gap_pct
  FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY dt), w10 AS (PARTITION BY ticker ORDER BY dt ROWS 9 PRECEDING))
"""


@query("features_market", f"WITH {BARS_SQL}, {MARKET_SQL} SELECT ticker, dt, {round_sql(*ts.MARKET_FEATURES)} FROM market")
def features_market(spark, sf):
    return rounded(ts.market_features(bars(spark, sf)), *ts.MARKET_FEATURES)


@query("calendar_grid", f"WITH {FILLED_SQL} SELECT ticker, dt FROM grid")
def calendar_grid(spark, sf):
    return ts.calendar_grid(bars(spark, sf)).select("ticker", "dt")


@query("ffill", f"WITH {FILLED_SQL} SELECT ticker, dt, {round_sql('open', 'high', 'low', 'close', 'volume')} FROM filled")
def ffill(spark, sf):
    return rounded(ts.forward_filled(bars(spark, sf)), "open", "high", "low", "close", "volume")


@query(
    "asof_latest",
    f"""WITH {BARS_SQL} SELECT ticker, max(dt) AS dt, round(arg_max(close, dt), 6) AS close
FROM bars WHERE dt <= DATE '{CUTOFF}' GROUP BY ticker""",
)
def asof_latest(spark, sf):
    return rounded(ts.latest_row(bars(spark, sf), CUTOFF).select("ticker", "dt", "close"), "close")


@query(
    "complete_history",
    f"""WITH {FILLED_SQL}, late AS (SELECT * FROM filled WHERE dt > DATE '{CUTOFF}')
SELECT ticker, count(*) AS n_rows, round(avg(close), 6) AS mean_close FROM late GROUP BY ticker
HAVING count(close) = (SELECT count(DISTINCT dt) FROM late)""",
)
def complete_history(spark, sf):
    late = ts.forward_filled(bars(spark, sf)).where(F.col("dt") > F.lit(CUTOFF).cast("date"))
    whole = ts.complete_history(late).groupBy("ticker")
    return whole.agg(F.count("*").alias("n_rows"), F.round(F.avg("close"), 6).alias("mean_close"))


@query(
    "min_history",
    f"""WITH {BARS_SQL}, c AS (SELECT ticker, count(close) AS n FROM bars WHERE dt <= DATE '{CUTOFF}' GROUP BY ticker)
SELECT ticker, coalesce(n, 0) AS n_rows, coalesce(n, 0) >= 300 AS kept
FROM (SELECT DISTINCT ticker FROM bars) LEFT JOIN c USING (ticker)""",
)
def min_history(spark, sf):
    return ts.min_history(bars(spark, sf), CUTOFF)


@query(
    "coverage_by_key",
    f"""WITH {BARS_SQL} SELECT ticker, count(*) AS n_rows, count(DISTINCT dt) AS n_dates, min(dt) AS first_date,
max(dt) AS last_date FROM bars GROUP BY ticker""",
)
def coverage_by_key(spark, sf):
    return ts.coverage(bars(spark, sf))


@query(
    "oos_segment",
    f"""WITH {BARS_SQL}
SELECT ticker, dt, round(close, 6) AS close, dt >= DATE '2001-04-01' AS in_holdout FROM bars
WHERE dt > DATE '{CUTOFF}' AND dt <= DATE '2001-06-30'""",
)
def oos_segment(spark, sf):
    day = F.col("dt")
    segment = bars(spark, sf).where((day > F.lit(CUTOFF).cast("date")) & (day <= F.lit("2001-06-30").cast("date")))
    held = (day >= F.lit("2001-04-01").cast("date")).alias("in_holdout")
    return segment.select("ticker", "dt", F.round("close", 6).alias("close"), held)


@query(
    "fallback_rows",
    f"""WITH {BARS_SQL}, fresh AS (SELECT * FROM bars WHERE dt >= DATE '2001-10-01'),
lacking AS (SELECT ticker FROM (SELECT DISTINCT ticker FROM bars) WHERE ticker NOT IN (SELECT ticker FROM fresh
            WHERE volume > 50))
SELECT ticker, dt, round(close, 6) AS close FROM bars WHERE dt < DATE '2001-10-01' AND ticker IN (FROM lacking)
UNION ALL SELECT ticker, dt, round(close, 6) FROM fresh WHERE volume > 50""",
)
def fallback_rows(spark, sf):
    all_bars = bars(spark, sf)
    recent = F.col("dt") >= F.lit("2001-10-01").cast("date")
    fresh = all_bars.where(recent & (F.col("volume") > 50))
    return rounded(ts.fallback_rows(all_bars.where(~recent), fresh).select("ticker", "dt", "close"), "close")
