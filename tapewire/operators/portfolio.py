"""Long-only capped weights and portfolio figures.

Tables here hold one row per ticker (and window), so windows over them are
bounded by the listed universe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tapewire.functions.numeric import safe_div

MAX_WEIGHT = 0.05
COST = 0.001


def capped_weights(
    scores: DataFrame,
    cap: float = MAX_WEIGHT,
    group: Sequence[str] = (),
    score: str = "score",
    fallback: str | None = None,
) -> DataFrame:
    """Weights proportional to `score`, none above `cap`, the excess shared by the rest.

    In descending score order the capped names come first. Name i stays below the
    cap if its share of what the i-1 names above leave is at most the cap; the
    first such name fixes the scale of all names from there on. Scores up to zero get zero.
    Where too few scores are positive to reach one under the cap, the group is weighed by
    the column `fallback`, such as an inverse variance, instead.
    """
    if fallback:
        able = F.sum((F.col(score) > 0).cast("int")).over(Window.partitionBy(*group)) * cap >= 1 - 1e-12
        chosen = scores.withColumn("_score", F.when(able, F.col(score)).otherwise(F.col(fallback)))
        return capped_weights(chosen, cap, group, "_score").drop("_score")
    ranked = Window.partitionBy(*group).orderBy(F.desc(score), "ticker")
    onward = ranked.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*group)
    share = F.greatest(F.col(score), F.lit(0.0))
    scaled = scores.select(
        *scores.columns,
        F.row_number().over(ranked).alias("_at"),
        safe_div(1 - cap * (F.row_number().over(ranked) - 1), F.sum(share).over(onward)).alias("_scale"),
    )
    fits = (share > 0) & (share * F.col("_scale") <= cap)
    first = F.min(F.when(fits, F.col("_at"))).over(whole)
    level = F.min_by("_scale", F.when(fits, F.col("_at"))).over(whole)
    below = F.when(F.col("_at") >= first, share * level).otherwise(cap)
    return scaled.withColumn("weight", F.when(share > 0, below).otherwise(0.0)).drop("_scale", "_at")


def feasible(names: DataFrame, low: float = 0.0, high: float = MAX_WEIGHT) -> DataFrame:
    """Whether weights within [low, high] can sum to one."""
    n = F.count("*")
    return names.agg(n.alias("n_names"), ((n * low <= 1) & (n * high >= 1)).alias("feasible"))


def portfolio_stats(weights: DataFrame, mu: DataFrame, cov: DataFrame, risk_free: float = 0.0) -> DataFrame:
    """Expected return, volatility sqrt(w'Cw) and Sharpe ratio."""
    left = weights.select(F.col("ticker").alias("ticker_i"), F.col("weight").alias("w_i"))
    right = weights.select(F.col("ticker").alias("ticker_j"), F.col("weight").alias("w_j"))
    times = F.when(F.col("ticker_i") == F.col("ticker_j"), 1.0).otherwise(2.0)
    risk = (
        cov.join(left, "ticker_i").join(right, "ticker_j")
        .agg(F.sqrt(F.sum(times * F.col("w_i") * F.col("w_j") * F.col("cov"))).alias("volatility"))
    )
    gain = weights.select("ticker", "weight").join(mu, "ticker").agg(F.sum(F.col("weight") * F.col("mu")).alias("expected_return"))
    joined = gain.withColumn("_k", F.lit(1)).join(risk.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return joined.withColumn("sharpe", safe_div(F.col("expected_return") - risk_free, F.col("volatility")))


def turnover(new: DataFrame, old: DataFrame) -> DataFrame:
    """Sum of absolute weight changes over the names of the new portfolio.

    Names that leave the portfolio are not counted, as in the method.
    """
    moved = new.join(old.select("ticker", F.col("weight").alias("_old")), "ticker", "left")
    change = F.sum(F.abs(F.col("weight") - F.coalesce("_old", F.lit(0.0))))
    return moved.agg(change.alias("turnover")).withColumn("cost", F.col("turnover") * COST)


def daily_returns(returns: DataFrame, weights: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Weighted sum of returns per date."""
    joined = returns.join(weights.select(*group, "ticker", "weight"), [*group, "ticker"])
    return joined.groupBy(*group, "dt").agg(F.sum(F.col("ret") * F.col("weight")).alias("ret"))


def net_of_cost(daily: DataFrame, cost: float) -> DataFrame:
    """Deduct the cost from the first day; the first day is one value read off the series."""
    first = daily.agg(F.min("dt")).first()[0]
    return daily.withColumn("ret", F.col("ret") - F.when(F.col("dt") == F.lit(first), cost).otherwise(0.0))
