"""Ordered operators that never hold a whole group in one task.

Ranks, ids and exact quantiles need a total order. Here the rows are range
partitioned, each range is summed up, and the sums of the ranges before give
every range its offset. A group that holds a third of all rows is cut over many
ranges like any other data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.session import cut_lineage


def join_groups(rows: DataFrame, figures: DataFrame, group: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Inner join of rows to the figures of their group; a null in a group column is a group of its own."""
    renamed = figures.withColumnsRenamed({c: f"_of_{c}" for c in [*group, *also]})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group] + [F.col(c) == F.col(f"_of_{c}") for c in also]
    return rows.join(renamed, same).drop(*[f"_of_{c}" for c in [*group, *also]])


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], weight: Column, out: str = "running"
) -> DataFrame:
    """Running sum of `weight` within `group` in ascending `order`.

    The range bounds are sampled, so the ranged rows are checkpointed before the
    two reads of them (sums per range, then the rows) that must agree.
    """
    keys = [*group, *order]
    ranged = cut_lineage(
        df.withColumn("_w", weight).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    )
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum("_w").alias("_sum"))
        .select(*group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    local = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        join_groups(ranged, offsets, group, ["_range"])
        .withColumn(out, F.col("_offset") + F.sum("_w").over(local))
        .drop("_w", "_range", "_offset")
    )


def sequential_id(df: DataFrame, order: Sequence[str], out: str = "id") -> DataFrame:
    """Dense ids 1..n in `order`, without a single-partition window."""
    return running_total(df, [], order, F.lit(1).cast("bigint"), out)


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Linear-interpolated quantiles per group, one column per entry of `probabilities`.

    Equal values are merged first, so a value that fills a third of the rows is
    one row; the rest are ranked by range (see `running_total`).
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    ranked = running_total(counted, group, [value], F.col("_n"), "_upto")
    totals = counted.groupBy(*group).agg(F.sum("_n").alias("_total"))
    if group:
        ranked = join_groups(ranked, totals, group)
    else:
        ranked = ranked.withColumn("_total", F.lit(totals.first()["_total"]))
    picks, columns = [], []
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("_total") - 1)
        picks += [
            F.min(F.when(F.col("_upto") > F.floor(position), F.col(value))).alias(f"{name}_lo"),
            F.min(F.when(F.col("_upto") > F.ceil(position), F.col(value))).alias(f"{name}_hi"),
            F.max(position - F.floor(position)).alias(f"{name}_part"),
        ]
        low, high, part = (F.col(f"{name}_{s}") for s in ("lo", "hi", "part"))
        columns.append((low + (high - low) * part).alias(name))
    return ranked.groupBy(*group).agg(*picks).select(*group, *columns)


HASH_BUCKETS = 4  # leading hex digits of the md5: 65,536 even buckets per class


def hashed_rank(df: DataFrame, group: Sequence[str], key: str, out: str = "rank") -> DataFrame:
    """Rank within `group` by the md5 of `key` (then `key`), from 1, plus the group size.

    md5 spreads evenly, so its leading digits cut every group into buckets of a
    known share; counts of the buckets give the offsets and only rows of one
    bucket are ranked together.
    """
    marked = df.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_bucket", F.substring("_hash", 1, HASH_BUCKETS)
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*group, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            *group,
            "_bucket",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(whole).alias("group_size"),
        )
    )
    local = Window.partitionBy(*group, "_bucket").orderBy("_hash", key)
    return (
        join_groups(marked, offsets, group, ["_bucket"])
        .withColumn(out, F.col("_offset") + F.row_number().over(local))
        .drop("_hash", "_bucket", "_offset")
    )
