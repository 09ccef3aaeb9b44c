"""URL filter rules applied by hashed host-suffix and path-prefix expressions.

Every url is expanded into (host suffix, path prefix) expressions, the expressions
meet the rules in an equi-join on the first 32 bits of a digest, full digests
confirm the hits, and the longest confirmed rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RULE_SCHEMA = "rule_host string, rule_path string, action string"
PREFIX_DIGITS = 8  # hex digits of the digest in the join key: 32 bits
MAX_LENGTHS = 65_536


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as (host, path, block or allow)."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def _digest(host: Column, path: Column) -> Column:
    # A host holds no slash, so the joined text is unambiguous when a path starts with one or is empty.
    return F.sha2(F.concat_ws("\u0000", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add `host`, `path`, `rule` (host and path joined; null if none) and `verdict`.

    A rule fits its host and every subdomain when the path starts with the rule's
    path. The longest rule wins; of equally long ones that with the longer host,
    then a block. Without a rule the verdict is `default`. Null urls and urls
    without `://` have an empty host and path, which only a rule with an empty
    host could fit. Rules with nulls are ignored. Columns of `pages` are kept; of
    those called host, path, rule or verdict the new ones take the place. Repeated
    rows are judged one by one.

    Path prefixes are cut at the lengths that occur among the rules, so any prefix
    rule is found and a long path costs no more than the rules ask for.
    """
    rules = rules.dropna().select("rule_host", "rule_path", "action").distinct()
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().limit(MAX_LENGTHS + 1).collect())
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} different rule path lengths")
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    row = F.struct(*[F.col(f"`{c}`") for c in own]) if own else F.struct(F.lit(None).cast("int").alias("_none"))
    split = pages.select(
        F.monotonically_increasing_id().alias("_uid"),
        row.alias("_row"),
        url_host(F.col(url)).alias("_host"),
        url_path(F.col(url)).alias("_path"),
    )
    labels = F.split("_host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    cuts = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    prefixes = F.transform(
        F.filter(cuts, lambda n: n <= F.length("_path")), lambda n: F.substring(F.col("_path"), F.lit(1), n)
    )
    expressions = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _digest(s, p)))
    )
    key = lambda digest: F.conv(F.substring(digest, 1, PREFIX_DIGITS), 16, 10).cast("bigint")
    asked = split.select("*", F.explode_outer(expressions).alias("_digest")).withColumn("_key", key(F.col("_digest")))
    listed = rules.select(
        _digest(F.col("rule_host"), F.col("rule_path")).alias("_full"),
        F.concat("rule_host", "rule_path").alias("_rule"),
        F.length("rule_host").alias("_host_length"),
        "action",
    ).withColumn("_key", key(F.col("_full")))
    met = asked.join(listed, "_key", "left")
    confirmed = F.col("_full") == F.col("_digest")
    rank = F.struct(
        F.length("_rule").alias("length"), "_host_length", (F.col("action") == "block").alias("blocks"), "_rule", "action"
    )
    best = met.groupBy("_uid").agg(
        F.first("_row").alias("_row"),
        F.first("_host").alias("host"),
        F.first("_path").alias("path"),
        F.max(F.when(confirmed, rank)).alias("_best"),
    )
    return best.select(
        *[F.col(f"_row.`{c}`") for c in own],
        "host",
        "path",
        F.col("_best._rule").alias("rule"),
        F.coalesce("_best.action", F.lit(default)).alias("verdict"),
    )
