"""Equity curves, strategy figures and the walk-forward test.

Series hold one row per strategy and date, bounded by the trading calendar.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapewire.functions.numeric import safe_div
from tapewire.operators.panel import average_rank, daily_rank_ic, rank_pct, tilted_return
from tapewire.operators.portfolio import COST, MAX_WEIGHT, capped_weights, daily_returns
from tapewire.operators.risk import formation_returns

TRADING_DAYS = 252


def equity_curve(daily: DataFrame, by: str = "strategy") -> DataFrame:
    upto = Window.partitionBy(by).orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("equity", F.product(1 + F.col("ret")).over(upto))


def drawdown(curve: DataFrame, by: str = "strategy") -> DataFrame:
    """Deepest fall of the curve below its running maximum."""
    upto = Window.partitionBy(by).orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.col("equity") / F.max("equity").over(upto) - 1
    return curve.select(by, depth.alias("_depth")).groupBy(by).agg(F.min("_depth").alias("max_drawdown"))


def buy_and_hold(prices: DataFrame) -> DataFrame:
    """Mean over tickers of the price relative to the first price of the segment."""
    first = F.first("close").over(Window.partitionBy("ticker").orderBy("dt"))
    relative = prices.select("dt", safe_div(F.col("close"), first).alias("rel"))
    return relative.groupBy("dt").agg(F.avg("rel").alias("equity"))


def curve_returns(curve: DataFrame) -> DataFrame:
    """Daily returns of one curve, its first date dropped."""
    days = Window.orderBy("dt")
    change = safe_div(F.col("equity"), F.lag("equity").over(days)) - 1
    return curve.select("dt", change.alias("ret")).where("ret IS NOT NULL")


def summary(daily: DataFrame, by: str = "strategy", risk_free: float = 0.0) -> DataFrame:
    """Growth, annualised return, volatility, Sharpe ratio and drawdown per strategy."""
    spread = F.stddev_samp("ret")
    figures = daily.groupBy(by).agg(
        F.count("*").alias("n_days"),
        F.product(1 + F.col("ret")).alias("total_growth"),
        (spread * TRADING_DAYS**0.5).alias("volatility"),
        (safe_div(F.avg("ret") - risk_free / TRADING_DAYS, spread) * TRADING_DAYS**0.5).alias("sharpe"),
    )
    yearly = F.pow("total_growth", F.lit(float(TRADING_DAYS)) / F.col("n_days")) - 1
    return figures.withColumn("annualized_return", yearly).join(drawdown(equity_curve(daily, by), by), by)


@dataclass(frozen=True)
class WalkForward:
    """Settings of the rolling test; dates as yyyy-mm-dd."""

    start: str = "2021-01-01"
    end: str = "2025-09-30"
    step_months: int = 3
    formation_months: int = 36
    min_names: int = 30
    min_rows: int = 300
    cap: float = MAX_WEIGHT
    cost: float = COST
    train_share: float = 0.8


def rebalance_cutoffs(spark: SparkSession, first, last, plan: WalkForward) -> DataFrame:
    """Cutoff dates with their number and the next cutoff: one row per rebalance."""
    start = F.greatest(F.lit(plan.start).cast("date"), F.add_months(F.lit(first), plan.formation_months))
    stop = F.least(F.lit(plan.end).cast("date"), F.lit(last))
    steps = F.sequence(start, stop, F.expr(f"interval {plan.step_months} months"))
    dates = spark.range(1).select(F.when(start <= stop, steps).alias("_d"))
    return dates.select(F.posexplode("_d").alias("_i", "cutoff")).select(
        (F.col("_i") + 1).cast("bigint").alias("window_id"),
        "cutoff",
        F.add_months("cutoff", plan.step_months).alias("next_cutoff"),
    )


def _days(table: DataFrame, low, high, *keep) -> DataFrame:
    day = F.explode(F.sequence(low, high, F.expr("interval 1 day"))).alias("dt")
    return table.where(low <= high).select(*keep, day)


def segment_days(cutoffs: DataFrame, plan: WalkForward) -> DataFrame:
    """(window_id, dt) for every day after a cutoff up to the next one."""
    low = F.date_add("cutoff", 1)
    return _days(cutoffs, low, F.least("next_cutoff", F.lit(plan.end).cast("date")), "window_id")


def first_known_days(cutoffs: DataFrame, first) -> DataFrame:
    """(window_id, dt): the first window whose cutoff is at or after the day."""
    before = F.lag("cutoff").over(Window.orderBy("window_id"))
    spans = cutoffs.withColumn("_low", F.coalesce(F.date_add(before, 1), F.lit(first)))
    return _days(spans, F.col("_low"), F.col("cutoff"), "window_id")


def _ic_per_window(features: DataFrame, known: DataFrame, windows: DataFrame, score: str, plan: WalkForward) -> DataFrame:
    """Mean daily IC over the validation dates known at each cutoff.

    Dates are numbered once; a window's validation dates are a range of numbers,
    so its mean is a difference of two running sums.
    """
    daily = features.groupBy("dt").agg(F.max("target_end_date").alias("_end"))
    ics = daily_rank_ic(features, score, "forward_return")
    numbered = daily.join(ics.select("dt", "ic"), "dt", "left").select(
        "_end",
        F.row_number().over(Window.orderBy("dt")).alias("at"),
        F.sum(F.coalesce("ic", F.lit(0.0))).over(Window.orderBy("dt")).alias("ic_sum"),
        F.count("ic").over(Window.orderBy("dt")).alias("ic_n"),
    )
    ready = numbered.join(known.withColumnRenamed("dt", "_end"), "_end").groupBy("window_id").agg(F.count("*").alias("_new"))
    upto = Window.orderBy("window_id")
    sizes = windows.join(ready, "window_id", "left").select(
        "window_id", F.sum(F.coalesce("_new", F.lit(0))).over(upto).alias("n")
    )
    edges = sizes.select("window_id", F.col("n"), (F.floor(F.col("n") * plan.train_share) + 1).alias("split"))
    last = numbered.select(F.col("at").alias("n"), F.col("ic_sum").alias("s1"), F.col("ic_n").alias("n1"))
    cut = numbered.select(F.col("at").alias("split"), F.col("ic_sum").alias("s0"), F.col("ic_n").alias("n0"))
    joined = edges.join(last, "n", "left").join(cut, "split", "left")
    mean = safe_div(F.col("s1") - F.col("s0"), F.col("n1") - F.col("n0"))
    return joined.select("window_id", F.coalesce(mean, F.lit(0.0)).alias("ic"))


def walk_forward(
    prices: DataFrame, features: DataFrame, plan: WalkForward, score: str = "return_20d", model: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Walk-forward test of all windows at once; gives `windows`, `weights` and `daily`.

    `prices` are filled bars, `features` complete feature rows. Every row belongs
    to one segment and to one first window that knows it, so formation figures
    are sums per window, accumulated over the windows; history is not copied
    once per cutoff. The default score is a feature; `model` gives scores fitted per
    window instead (window_id, ticker, score, ic), where windows without a model are
    skipped and a window with too few positive scores is weighed by inverse variance.
    """
    spark = prices.sparkSession
    returns = formation_returns(prices)
    span = prices.agg(F.min("dt").alias("a"), F.max("dt").alias("z")).first()
    cutoffs = rebalance_cutoffs(spark, span["a"], span["z"], plan)
    known = first_known_days(cutoffs, span["a"])
    windows = cutoffs.select("window_id")
    upto = Window.partitionBy("ticker").orderBy("window_id")

    risk = returns.join(known, "dt").groupBy("ticker", "window_id").agg(
        F.count("*").alias("_n"), F.sum("ret").alias("_s"), F.sum(F.col("ret") * F.col("ret")).alias("_q")
    )
    drift = (
        features.withColumn("_score", rank_pct(score)).join(known, "dt").groupBy("ticker", "window_id")
        .agg(F.count("*").alias("_m"), F.sum("daily_return").alias("_d"), F.max_by("_score", "dt").alias("_score"))
    )
    cells = returns.select("ticker").distinct().select(
        "ticker", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(cutoffs.count()).cast("bigint"))).alias("window_id")
    )
    formed = (
        cells.join(risk, ["ticker", "window_id"], "left").join(drift, ["ticker", "window_id"], "left")
        .select(
            "ticker", "window_id",
            *[F.sum(F.coalesce(c, F.lit(0))).over(upto).alias(c) for c in ("_n", "_m")],
            *[F.sum(F.coalesce(c, F.lit(0.0))).over(upto).alias(c) for c in ("_s", "_q", "_d")],
            F.last("_score", ignorenulls=True).over(upto).alias("_score"),
        )
        .where((F.col("_m") > 0) & (F.col("_n") >= plan.min_rows))
    )
    if model is None:
        formed = formed.join(_ic_per_window(features, known, windows, score, plan), "window_id")
    else:
        fitted = model.select("window_id", "ticker", F.col("score").alias("_score"), "ic")
        formed = formed.drop("_score").join(fitted, ["window_id", "ticker"])
    base = F.col("_d") / F.col("_m") * TRADING_DAYS
    variance = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1) * TRADING_DAYS
    names = formed.withColumn("n_names", F.count("*").over(Window.partitionBy("window_id"))).where(
        F.col("n_names") >= plan.min_names
    )
    scored = names.select(
        "window_id", "ticker", "n_names", "ic",
        tilted_return(base, F.col("_score"), F.col("ic")).alias("mu"), variance.alias("variance"),
    ).withColumn("score", safe_div(F.greatest("mu", F.lit(0.0)), F.col("variance")))
    if model is not None:
        scored = scored.withColumn("safe", safe_div(F.lit(1.0), F.col("variance")))
    weighed = capped_weights(scored, plan.cap, ["window_id"], fallback=None if model is None else "safe")
    optimised = weighed.select("window_id", "ticker", "n_names", "ic", "weight")
    equal = names.select("window_id", "ticker", "n_names", "ic", (1 / F.col("n_names")).alias("weight"))
    weights = optimised.withColumn("strategy", F.lit("optimized")).unionByName(
        equal.withColumn("strategy", F.lit("equal_weight"))
    )

    inside = prices.join(segment_days(cutoffs, plan), "dt")
    steps = Window.partitionBy("window_id", "ticker").orderBy("dt")
    moves = inside.select(
        "window_id", "ticker", "dt", (safe_div(F.col("close"), F.lag("close").over(steps)) - 1).alias("ret")
    ).where("ret IS NOT NULL")
    gross = moves.join(weights, ["window_id", "ticker"]).groupBy("strategy", "window_id", "dt").agg(
        F.sum(F.col("ret") * F.col("weight")).alias("ret")
    )
    held = Window.partitionBy("strategy", "ticker").orderBy("window_id")
    running = weights.withColumn("_seq", F.dense_rank().over(Window.partitionBy("strategy").orderBy("window_id")))
    followed = F.lag("_seq").over(held) == F.col("_seq") - 1
    old = F.when(followed, F.lag("weight").over(held)).otherwise(0.0)
    costs = running.withColumn("_old", old).groupBy("strategy", "window_id").agg(
        F.sum(F.abs(F.col("weight") - F.col("_old"))).alias("turnover"),
        F.max("n_names").alias("n_names"),
        F.max("ic").alias("ic"),
    )
    opening = F.row_number().over(Window.partitionBy("strategy", "window_id").orderBy("dt")) == 1
    daily = gross.join(costs, ["strategy", "window_id"]).select(
        "strategy", "window_id", "dt", "turnover", "n_names", "ic",
        (F.col("ret") - F.when(opening, F.col("turnover") * plan.cost).otherwise(0.0)).alias("ret"),
    )
    return {"windows": cutoffs, "weights": weights, "daily": daily}


def window_results(daily: DataFrame) -> DataFrame:
    """Per window: span, names, IC, both returns, turnover and whether the equal weights were beaten."""
    own = F.col("strategy") == "optimized"
    grown = {s: F.product(F.when(F.col("strategy") == s, 1 + F.col("ret"))) - 1 for s in ("optimized", "equal_weight")}
    table = daily.groupBy("window_id").agg(
        F.min("dt").alias("first_day"),
        F.max("dt").alias("last_day"),
        F.max("n_names").alias("n_names"),
        F.max("ic").alias("validation_ic"),
        F.max(F.when(own, F.col("turnover"))).alias("turnover"),
        *[v.alias(f"{s}_return") for s, v in grown.items()],
    )
    return table.withColumn("beat_equal_weight", F.col("optimized_return") > F.col("equal_weight_return"))
