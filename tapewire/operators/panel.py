"""Cross-sectional panel: per-date z-scores and ranks, purging, rank IC, tilt.

A window over one date holds one row per ticker, so it is bounded by the listed
universe. The z-scores and ranks of a date do not depend on a cutoff; they are
computed once and filtered per cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tapewire.functions.numeric import clip, safe_div
from tapewire.operators.timeseries import PRICE_FEATURES

# Bounds and scale of the expected-return tilt.
TILT_SCALE = 0.15
MAX_ANNUAL_RETURN = 0.50
TRADING_DAYS = 252


def by_date() -> WindowSpec:
    return Window.partitionBy("dt")


def zscore(value: Column) -> Column:
    return safe_div(value - F.avg(value).over(by_date()), F.stddev_samp(value).over(by_date()))


def average_rank(name: str, *partition: str) -> Column:
    """Rank from 1 with tied values sharing their mean rank; null stays null."""
    ordered = Window.partitionBy(*partition).orderBy(F.col(name).asc_nulls_last())
    last_of_tie = F.count(name).over(ordered)
    return F.when(F.col(name).isNotNull(), (F.rank().over(ordered) + last_of_tie) / 2)


def rank_pct(name: str) -> Column:
    return average_rank(name, "dt") / F.nullif(F.count(name).over(by_date()), F.lit(0))


def build_panel(features: DataFrame, cutoff: str | None = None, columns=tuple(PRICE_FEATURES)) -> DataFrame:
    """z-scored features and the target percentile of each date, rows up to the cutoff."""
    if cutoff:
        features = features.where(F.col("dt") <= F.lit(cutoff).cast("date"))
    return features.select(
        "ticker",
        "dt",
        *[zscore(F.col(c)).alias(c) for c in columns],
        rank_pct("forward_return").alias("target_percentile"),
        "forward_return",
        "target_end_date",
    ).dropna(subset=list(columns))


def purged(panel: DataFrame, cutoff: str) -> DataFrame:
    """Labelled rows whose target is known by the cutoff."""
    known = panel.dropna(subset=["target_end_date", "forward_return", "target_percentile"])
    return known.where(F.col("target_end_date") <= F.lit(cutoff).cast("date"))


def time_split(labeled: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Mark rows as train or validation at the distinct date with index int(share * n).

    The numbered table is one row per trading date; it is small by the calendar.
    """
    dates = labeled.select("dt").distinct()
    numbered = dates.select(
        "dt",
        (F.row_number().over(Window.orderBy("dt")) - 1).alias("_at"),
        F.count("*").over(Window.partitionBy()).alias("_n"),
    )
    part = F.when(F.col("_at") <= F.floor(F.col("_n") * train_share), "train").otherwise("validation")
    return labeled.join(numbered.select("dt", part.alias("part")), "dt")


def daily_rank_ic(rows: DataFrame, score: str, target: str, min_names: int = 5) -> DataFrame:
    """Spearman correlation of score and target per date, where the date is wide enough."""
    both = rows.dropna(subset=[score, target])
    ranked = both.select("dt", average_rank(score, "dt").alias("a"), average_rank(target, "dt").alias("b"))
    usable = (F.count("*") >= min_names) & (F.min("a") < F.max("a")) & (F.min("b") < F.max("b"))
    return (
        ranked.groupBy("dt")
        .agg(F.count("*").alias("n_names"), usable.alias("_ok"), F.corr("a", "b").alias("ic"))
        .where("_ok")
        .drop("_ok")
    )


def hist_mean(features: DataFrame) -> DataFrame:
    return features.groupBy("ticker").agg((F.avg("daily_return") * TRADING_DAYS).alias("hist_annual"))


def tilted_return(base: Column, score: Column, ic: Column) -> Column:
    """A ticker's own mean plus a tilt by its score, no larger than the proven skill."""
    skill = F.greatest(F.lit(0.0), ic)
    tilt = (score - 0.5) * 2 * skill * TILT_SCALE
    return clip(F.coalesce(base, F.lit(0.0)) + tilt, -MAX_ANNUAL_RETURN, MAX_ANNUAL_RETURN)
