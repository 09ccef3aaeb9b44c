"""Sainte-Lague mixing of sources to target weights.

Each source is a stream of words cut into equal blocks and dealt over shards. The
words of the mix go to sources by highest quotients, and those of a source to its
shards in the same way, so every shard knows its quota before any document is
looked at again. A cell then takes whole passes and one seeded run of consecutive
blocks, the last one cut to what is left of the quota.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import cycle

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tapewire.llm.common import WORD, stage
from tapewire.operators.ordering import running_total

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
BLOCKS = 1 << 20
SHARDS = 16
MAX_CELLS = 4_000_000
SEED = 11


def source_targets(sizes: Sequence[float], weights: Sequence[float], total: float, repeats: float) -> np.ndarray:
    """Words per source: `total` by weight, none above `repeats` times its size, the excess shared again."""
    limit, weight = np.asarray(sizes, float) * repeats, np.asarray(weights, float)
    target, free, left = np.zeros(len(limit)), np.ones(len(limit), bool), min(total, limit.sum())
    while free.any():
        at = np.flatnonzero(free)
        share = left * weight[at] / weight[at].sum()
        over = share >= limit[at]
        if not over.any():
            target[at] = share
            break
        target[at[over]] = limit[at[over]]
        left -= limit[at[over]].sum()
        free[at[over]] = False
    return target


def apportion(weights: Sequence[float], seats: int) -> np.ndarray:
    """Sainte-Lague: seats go one by one to the highest weight / (2 * held + 1), ties to the earlier cell.

    All quotients above a common divisor are seats of the result, so the divisor is
    found by bisection and only the seats tied at it are dealt singly.
    """
    weight = np.asarray(weights, float)
    held = np.zeros(len(weight), np.int64)
    if seats <= 0 or not weight.sum() > 0:
        return held
    above = lambda divisor: np.floor((weight / divisor + 1) / 2).astype(np.int64)
    low, high = weight.sum() / (4 * seats + 4 * len(weight)), 2 * weight.max()
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle).sum() > seats else (low, middle)
    held = above(high)
    for _ in range(seats - int(held.sum())):
        held[np.argmax(weight / (2 * held + 1))] += 1
    return held


def capped_seats(weights: np.ndarray, seats: int, limits: np.ndarray) -> np.ndarray:
    """Sainte-Lague seats with none above its limit; what a limit cuts off is dealt to the others."""
    held, free = np.zeros(len(weights), np.int64), np.ones(len(weights), bool)
    while free.any():
        held[free] = apportion(weights[free], seats - int(limits[~free].sum()))
        over = free & (held > limits)
        if not over.any():
            break
        held[over] = limits[over]
        free &= ~over
    return held


def _cell_quotas(cells: list, weights, share: float, repeats: int, blocks: int) -> tuple[list[tuple], int]:
    """Rows of (source, shard, source size, target, words, passes, words of the run), and the block length.

    `cells` lie in the order of their sources.
    """
    names = list(dict.fromkeys(c["source"] for c in cells))
    index = {name: i for i, name in enumerate(names)}
    at = np.array([index[c["source"]] for c in cells], int)
    words = np.array([c["words"] for c in cells], float)
    sizes = np.bincount(at, words, minlength=len(names))
    turn = cycle(weights)
    targets = source_targets(sizes, [next(turn) for _ in names], share * sizes.sum(), repeats)
    length = max(1, int(-(-targets.sum() // blocks)))
    whole = words.astype(np.int64)
    most = np.floor(sizes * repeats).astype(np.int64)
    taken = capped_seats(targets, min(round(targets.sum()), int(most.sum())), most)
    quotas = np.zeros(len(cells), np.int64)
    bounds = np.searchsorted(at, np.arange(len(names) + 1))
    for i, quota in enumerate(taken.tolist()):
        own = slice(bounds[i], bounds[i + 1])
        limits = np.floor(words[own] * repeats).astype(np.int64)
        quotas[own] = capped_seats(words[own], min(quota, int(limits.sum())), limits)
    rows = []
    for cell, i, size, quota in zip(cells, at.tolist(), whole.tolist(), quotas.tolist(), strict=True):
        passes, run = divmod(quota, size) if size else (0, 0)
        rows.append((cell["source"], cell["shard"], int(sizes[i]), float(targets[i]), size, passes, run))
    return rows, length


def mix_plan(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    blocks: int = BLOCKS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and what is taken.

    size: words of the text (null: 0). Sources in code point order, null last, get
    `weights` in turn, of `share` times all words; no target exceeds `repeats` times
    its source, the excess is shared again. taken: words the mix takes, repeats
    counted; those of a source sum to its target in whole words, whatever the length
    of a block. It is `passes` whole copies, and words [run_start, run_end) and
    [again_start, again_end) of one more; the second range is empty but for a
    document at which the run of blocks wraps around. `text_hash` and `copy` tell
    repeated ids apart.

    Empty tables give no rows, empty texts rows with nothing taken. Repeated rows are
    documents of their own. Only doc_id, source and text are read. The driver holds
    one row per (source, shard); past four million of them it raises ValueError.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    digest = F.xxhash64("source", "text")
    # An id that repeats is numbered within equal rows, so that copies differ too.
    sized = documents.select("doc_id", "source", words.alias("size"), digest.alias("text_hash"))
    copies = Window.partitionBy("doc_id", "text_hash", "source").orderBy("size")
    light = stage(
        sized.withColumn("copy", F.row_number().over(copies))
        .withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), "text_hash", "copy")))
        .withColumn("shard", F.conv(F.substring("key", 1, 4), 16, 10).cast("int") % shards),
        "mix-sizes",
    )
    cells = light.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    found = cells.limit(MAX_CELLS + 1).collect()
    if len(found) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source and shard")
    # Code point order is the order of the UTF-8 bytes.
    found.sort(key=lambda c: (c["source"] is None, (c["source"] or "").encode(), c["shard"]))
    rows, length = _cell_quotas(found, weights, share, repeats, blocks)
    schema = StructType(
        [light.schema["source"], StructField("shard", IntegerType())]
        + [StructField("source_size", LongType()), StructField("target", DoubleType())]
        + [StructField(c, LongType()) for c in ("cell_words", "passes", "run")]
    )
    quotas = documents.sparkSession.createDataFrame(rows, schema).withColumnRenamed("shard", "cell_shard")
    quotas = quotas.withColumnRenamed("source", "cell_source")
    # Null sources are a source too; the stream position does not need the group to be non-null.
    placed = running_total(
        light.withColumn("cell", F.md5(F.concat_ws(":", F.col("source").isNull().cast("int"), "source", "shard"))),
        ["cell"],
        ["key"],
        F.col("size"),
        "upto",
    )
    joined = placed.join(
        F.broadcast(quotas) if len(rows) <= 20_000 else quotas,
        F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("shard") == F.col("cell_shard")),
    )
    count = F.ceil(F.col("cell_words") / length)
    first = F.pmod(F.xxhash64(F.lit(seed), "cell"), F.greatest(count, F.lit(1)))
    start = first * length
    last = start + F.col("run")
    begin, end = F.col("upto") - F.col("size"), F.col("upto")
    within = lambda x: F.least(F.greatest(x - begin, F.lit(0)), F.col("size")).cast("bigint")
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "passes",
        within(start).alias("run_start"),
        within(F.least(last, F.col("cell_words"))).alias("run_end"),
        within(F.lit(0)).alias("again_start"),
        within(F.greatest(last - F.col("cell_words"), F.lit(0))).alias("again_end"),
        "text_hash",
        "copy",
    ).withColumn(
        "taken",
        F.col("passes") * F.col("size") + F.col("run_end") - F.col("run_start") + F.col("again_end") - F.col("again_start"),
    )


def apply_mix(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents of the mix: a row per whole pass, and one with the words of the partial pass.

    Columns are those of `documents`; the text of a partial pass is its words joined
    by single spaces. Documents of which nothing is taken, and those without a
    word, are left out. `n_chars`, where present, follows the new text.
    """
    own = documents.columns
    marked = documents.withColumn("_hash", F.xxhash64("source", "text"))
    rank = Window.partitionBy("doc_id", "_hash", "source").orderBy(F.length("text"))
    marked = marked.withColumn("_copy", F.row_number().over(rank))
    wanted = plan.where("taken > 0").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_of"), F.col("copy").alias("_at"), "size", "passes",
        "run_start", "run_end", "again_start", "again_end",
    )
    met = marked.join(
        wanted,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")) & (F.col("_copy") == F.col("_at")),
    )
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    piece = lambda a, b: F.slice(words, F.col(a).cast("int") + 1, (F.col(b) - F.col(a)).cast("int"))
    partial = F.array_join(F.concat(piece("again_start", "again_end"), piece("run_start", "run_end")), " ")
    length = F.col("run_end") - F.col("run_start") + F.col("again_end") - F.col("again_start")
    texts = F.array_repeat(F.col("text"), F.col("passes").cast("int"))
    texts = F.when(length == F.col("size"), F.array_append(texts, F.col("text"))).when(
        length > 0, F.array_append(texts, partial)
    ).otherwise(texts)
    taken = met.withColumn("_text", F.explode(texts))
    made = {"text": F.col("_text"), "n_chars": F.length("_text").cast("bigint")}
    return taken.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in own])
