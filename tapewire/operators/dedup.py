"""Keep-first deduplication, greedy two-key deduplication, upsert and resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.session import cut_lineage


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order.

    A filter on row_number = 1 is planned as a group limit before the shuffle:
    every map task hands on one row per key, however many copies a key has.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    """The first k rows per key, cut before the shuffle like `keep_first`."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= k).drop("_n")


def mark_repeats(df: DataFrame, key: str, pos: str, out: str = "repeat") -> DataFrame:
    """Flag every row of a key but the first; a null key repeats nothing.

    First positions are found with a partial aggregate; the join back is on
    (key, pos), which is unique, so a frequent key does not pile up in one task.
    """
    firsts = df.groupBy(key).agg(F.min(pos).alias(pos)).withColumn("_first", F.lit(True))
    return df.join(firsts, [key, pos], "left").withColumn(out, F.col(key).isNotNull() & F.col("_first").isNull()).drop("_first")


def greedy_two_key(df: DataFrame, first: str, second: str, pos: str) -> DataFrame:
    """Scan in `pos` order and drop a row if either key was kept before; dropped rows leave no mark.

    Rounds: an undecided row that comes first in both its groups is kept, rows
    that share a key with it are dropped, the rest wait for the next round.
    Copies equal in both keys can only lose to their first, so they go at once.
    """
    undecided = cut_lineage(df.groupBy(first, second).agg(F.min(pos).alias(pos)))
    kept = None
    while not undecided.isEmpty():
        by_first = undecided.groupBy(first).agg(F.min(pos).alias(pos)).select(pos)
        by_second = undecided.groupBy(second).agg(F.min(pos).alias(pos)).select(pos)
        winners = cut_lineage(undecided.join(by_first, pos, "left_semi").join(by_second, pos, "left_semi"))
        kept = winners if kept is None else kept.unionByName(winners)
        rest = undecided.join(winners.select(first), first, "left_anti")
        undecided = cut_lineage(rest.join(winners.select(second), second, "left_anti"))
    return df.join(kept.select(pos), pos, "left_semi") if kept is not None else df


def append_history(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Old rows, then new rows whose key is not there yet."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, keys, ["_new", *order]).drop("_new")


def top_up(primary: DataFrame, broader: DataFrame, group: str, key: str, order: str, limit: int) -> DataFrame:
    """Primary rows per group, filled up from the broader result without repeats."""
    both = primary.withColumn("_second", F.lit(0)).unionByName(broader.withColumn("_second", F.lit(1)))
    unique = keep_first(both, [group, key], ["_second", order])
    return top_per_group(unique, [group], ["_second", order], limit).drop("_second")


def with_defaults(articles: DataFrame) -> DataFrame:
    """Insert defaults: unnamed authors, empty summaries, empty dates to null."""
    return articles.withColumns(
        {
            "author": F.coalesce(F.nullif("author", F.lit("")), F.lit("Unknown")),
            "summary": F.coalesce("summary", F.lit("")),
            "published_date": F.nullif("published_date", F.lit("")),
            "published_time": F.nullif("published_time", F.lit("")),
        }
    )


# Columns that a repeated url overwrites.
UPDATED = ["title", "author", "published_date", "published_time", "summary"]


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "url", order: str = "pos") -> DataFrame:
    """Insert new urls; on a known url overwrite the updated columns and keep the rest.

    With several incoming rows of one url the last one wins.
    """
    latest = with_defaults(keep_first(incoming, [key], [F.desc(order)])).withColumn("_in", F.lit(True))
    right = latest.select(key, "_in", *[F.col(c).alias(f"_{c}") for c in existing.columns if c != key])
    joined = existing.join(right, key, "full_outer")
    fresh = F.col("_in").isNotNull()

    def merged(name: str) -> Column:
        if name in UPDATED:
            return F.when(fresh, F.col(f"_{name}")).otherwise(F.col(name))
        return F.coalesce(F.col(name), F.col(f"_{name}"))

    return joined.select(*[F.col(c) if c == key else merged(c).alias(c) for c in existing.columns])


def unseen(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the finished set; a key that is finished often is one row of the join."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


def seen(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(done.select(*keys).distinct(), list(keys), "left_semi")
