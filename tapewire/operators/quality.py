"""Cleaning, profiles and data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from tapewire.functions import text as tx
from tapewire.functions import times as tm
from tapewire.functions import urls as ur
from tapewire.functions.numeric import row_mean
from tapewire.operators.dedup import keep_first, mark_repeats
from tapewire.operators.ordering import exact_quantiles

MIN_WORDS = 20
HISTOGRAM_BINS = 30


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def standard_names(df: DataFrame) -> DataFrame:
    """Trimmed lower-case column names with underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def clean_articles(raw: DataFrame, canonical_first: bool = False, min_words: int = MIN_WORDS) -> DataFrame:
    """Cleaned articles from (pos, url, source, title, content, author, published).

    Repeats of a url go before urls are made canonical, so canonical repeats
    stay unless `canonical_first` is set.
    """
    rows = tx.blank_if_null(raw, ["url", "title", "content", "author"])
    url = ur.canonical(F.col("url"))
    if canonical_first:
        rows = rows.withColumn("url", url)
    rows = keep_first(rows, ["url"], ["pos"])
    cleaned = rows.select(
        "pos",
        url.alias("url"),
        tx.source_name(F.col("source")).alias("source"),
        *[tx.squeeze(tx.fix_mojibake(F.col(c))).alias(c) for c in ("title", "content", "author")],
        tm.iso_timestamp(F.col("published")).alias("published_at"),
    )
    counted = cleaned.withColumns(
        {"word_count": tx.word_count(F.col("content")), "char_count": F.char_length("content")}
    )
    full = counted.where((F.col("url") != "") & (F.col("content") != "") & (F.col("word_count") >= min_words))
    return keep_first(full, ["title", "content"], ["pos"])


def cleaning_report(raw: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows before and after each rule: one pass with flags instead of a count per stage.

    The last rule counts each (title, content) once, told apart by digests, not by whole texts.
    """
    rows = mark_repeats(tx.blank_if_null(raw, ["url", "title", "content"]), "url", "pos")
    content = tx.squeeze(F.col("content"))
    flagged = rows.select(
        (~F.col("repeat")).alias("unique_url"),
        ((F.col("url") != "") & (content != "")).alias("filled"),
        (tx.word_count(content) >= min_words).alias("long_enough"),
        F.sha2(F.to_json(F.struct(tx.squeeze(F.col("title")).alias("t"), content.alias("c"))), 256).alias("_pair"),
    )
    kept = F.col("unique_url")
    stages = [("unique_url", kept), ("filled", kept & F.col("filled"))]
    stages.append(("long_enough", kept & F.col("filled") & F.col("long_enough")))
    last = F.count_distinct(F.when(stages[-1][1], F.col("_pair"))).alias("unique_text")
    totals = flagged.agg(F.count("*").alias("loaded"), *[F.count_if(c).alias(n) for n, c in stages], last)
    names = ["loaded", *[n for n, _ in stages], "unique_text"]
    pairs = [
        F.struct(F.lit(b).alias("stage"), F.col(a).alias("rows_before"), F.col(b).alias("rows_after"))
        for a, b in zip(names, names[1:])
    ]
    report = totals.select(F.explode(F.array(*pairs)).alias("s")).select("s.*")
    return report.withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null and blank counts per column, in one pass."""
    blank = {n: F.count_if(F.trim(F.col(n).cast("string")) == "") for n in df.columns}
    cells = [
        F.struct(F.lit(n).alias("column_name"), F.count_if(F.col(n).isNull()).alias("n_null"), blank[n].alias("n_blank"))
        for n in df.columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def duplicate_profile(df: DataFrame, keys: dict[str, Sequence[str]]) -> DataFrame:
    """Rows beyond the first per key; nulls count as equal."""
    parts = []
    for name, columns in keys.items():
        groups = df.groupBy(*columns).agg(F.count("*").alias("_n"))
        parts.append(groups.agg(F.lit(name).alias("key_name"), F.sum(F.col("_n") - 1).alias("n_duplicates")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) rows of the given numeric columns."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "value")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles (linear, exact) and max per column."""
    cells = long_form(df, columns)
    moments = cells.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(cells, ["column_name"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, "column_name", "left")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns: one aggregate, one row out per pair."""
    pairs = [(a, b) for a in columns for b in columns]
    cells = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.corr(a, b).alias("corr")) for a, b in pairs
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins 1..bins between min and max; the maximum falls in the last bin."""
    spans = df.agg(*[F.struct(F.min(c).cast("double"), F.max(c).cast("double")).alias(c) for c in columns]).first()
    bounds = {c: tuple(spans[c]) for c in columns}
    binned = []
    for c in columns:
        low, high = bounds[c]
        width = (high - low) / bins if high > low else 1.0
        at = F.when(F.col(c).isNotNull(), F.least(F.floor((F.col(c).cast("double") - low) / width) + 1, F.lit(bins)))
        binned.append(F.struct(F.lit(c).alias("column_name"), at.alias("bin")))
    cells = df.select(F.explode(F.array(*binned)).alias("c")).select("c.*").where("bin IS NOT NULL")
    return cells.groupBy("column_name", "bin").agg(F.count("*").alias("n"))


def imputed(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Nulls filled with the column's median or its most frequent value (smallest on ties).

    The fills are one value per column, read on the driver.
    """
    medians = exact_quantiles(long_form(df, numeric), ["column_name"], "value", {"median": 0.5})
    fills = {r["column_name"]: r["median"] for r in medians.collect()}
    for name in categorical:
        counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_n"))
        top = counts.orderBy(F.desc("_n"), name).limit(1).first()
        if top:
            fills[name] = top[name]
    return df.fillna(fills)


# Leakage and identifier columns dropped, and the feature list kept.
LEAKAGE = ["list_price", "listing_gain", "cmp(bse)", "cmp(nse)", "current_gains"]
IDENTIFIERS = ["date", "ipo_name"]
IPO_FEATURES = ["issue_size(crores)", "qib", "hni", "rii", "total", "offer_price", "avg_subscription"]


def with_target(df: DataFrame) -> DataFrame:
    """1 where the listing gain is positive; rows without a gain are dropped."""
    known = df.where(F.col("listing_gain").isNotNull())
    return known.withColumn("target", F.when(F.col("listing_gain") > 0, 1).otherwise(0))


def ipo_features(df: DataFrame) -> DataFrame:
    """Mean subscription, then the fixed features and the target without leaking columns."""
    require_columns(df, ["qib", "hni", "rii"])
    average = row_mean(F.col("qib"), F.col("hni"), F.col("rii"))
    kept = df.withColumn("avg_subscription", average).drop(*[c for c in [*LEAKAGE, *IDENTIFIERS] if c in df.columns])
    return require_columns(kept, IPO_FEATURES).select(*[f"`{c}`" for c in IPO_FEATURES], "target")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (k * n_c) per class, from counts per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    return counts.withColumn("weight", F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n")))


def assert_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Number of rows that break each rule, in one pass."""
    cells = [F.struct(F.lit(n).alias("rule"), F.count_if(~F.coalesce(c, F.lit(False))).alias("n_broken")) for n, c in rules.items()]
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
