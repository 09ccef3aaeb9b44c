"""Packing along a space-filling curve.

Token counts of a document are hashed into a short vector, projected to a few
dimensions and keyed by their place on a Hilbert curve. Documents are range-sorted
by that key and neighbours along the curve share sequences. Whole sequences of a
long document stand alone; what is left of it joins the curve, where it is cut only
at sequence ends, so all sequences but the last are full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tapewire.llm.common import shared_folder
from tapewire.llm.token_files import slices
from tapewire.llm.tokens import ENCODED_BYTES, encoder, end_task, text_chunks, with_end
from tapewire.operators.ordering import running_total

LENGTH = 1024
BUCKETS = 256  # width of the hashed vector
DIMENSIONS = 4
BITS = 14  # per dimension of the curve
SEED = 5


def projection(seed: int = SEED) -> np.ndarray:
    """Fixed orthonormal directions in the hashed space."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS)))[0]


def hashed_vectors(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A unit vector per text: signed square roots of the hashed token counts; zero without tokens."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(56)).astype(np.int64)
    sign = 1.0 - 2.0 * ((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    row = np.repeat(np.arange(len(counts)), counts)
    sums = np.bincount(row * BUCKETS + bucket, sign, len(counts) * BUCKETS).reshape(-1, BUCKETS)
    vectors = np.sign(sums) * np.sqrt(np.abs(sums))
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1.0)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows), by Skilling's transposed transform."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hilbert key per text. A coordinate of a unit vector lies in [-1, 1]."""
    places = hashed_vectors(ids, counts) @ projection()
    cells = np.clip((places + 1.0) / 2.0 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert_key(cells, BITS)


ENCODED = "uid long, doc_id long, doc_tokens long, curve long, rest_start long, rest binary, body_start long, body binary, body_number long"


def pack_documents(documents: DataFrame, vocabulary: str, end: int = 0, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document's tokens are its ids and `end`; a null text is empty and has `end`
    alone. Each token lies in one piece; `ids` are little-endian unsigned 32-bit.
    Whole sequences have odd numbers, shared ones even numbers in curve order.
    Documents with equal keys follow the row order; repeated rows are packed one by
    one; an empty table gives no piece. Only doc_id and text are read.
    """
    spark = documents.sparkSession
    rows = documents.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for chunk in text_chunks(batch, "text", ENCODED_BYTES):
                ids, counts = encoder(vocabulary).encode(chunk["text"])
                curve = curve_keys(ids, counts)
                ids, counts = with_end(ids, counts, end)
                # Pieces in order: per document its whole sequences, together, then the rest.
                body = counts // length * length
                parts = np.stack([body, counts - body], axis=1)
                cut = slices(ids, parts.reshape(-1))
                even, odd = cut.take(pa.array(np.arange(0, len(cut), 2))), cut.take(pa.array(np.arange(1, len(cut), 2)))
                whole = body // length
                first = number + np.cumsum(whole) - whole
                number += int(whole.sum())
                zero = np.zeros(len(counts), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [chunk["uid"], chunk["doc_id"], pa.array(counts), pa.array(curve), pa.array(body), odd, pa.array(zero), even, pa.array(first)],
                    [c.split()[0] for c in ENCODED.split(", ")],
                )
        end_task(encoder(vocabulary).cache)

    # Ids are 32-bit with empty high bytes: zstd halves what snappy would write.
    folder = shared_folder(spark, "packed-ids")
    rows.mapInArrow(encode, ENCODED).write.option("compression", "zstd").parquet(folder)
    staged = spark.read.schema(ENCODED).parquet(folder)
    wholes = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.floor(F.length("body") / (4 * length)) - 1),
        lambda i: F.struct(
            (i * length).alias("start"),
            F.lit(length).cast("bigint").alias("length"),
            F.substring(F.col("body"), (i * 4 * length + 1).cast("int"), F.lit(4 * length)).alias("ids"),
            ((F.col("body_number") + i) * 2 + 1).alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset"),
        ),
    )
    columns = ["doc_id", "doc_tokens", "piece.*"]
    alone = staged.where("rest_start > 0").select("doc_id", "doc_tokens", F.explode(wholes).alias("piece")).select(*columns)
    # From the numbers alone, so that the passes over this order leave the ids unread.
    left = F.col("doc_tokens") - F.col("rest_start")
    light = staged.where(left > 0).select("uid", "curve", left.alias("tokens"))
    placed = running_total(light, [], ["curve", "uid"], F.col("tokens"), "upto").select(
        "uid", "tokens", (F.col("upto") - F.col("tokens")).alias("at")
    )
    met = staged.select("uid", "doc_id", "doc_tokens", "rest_start", "rest").join(placed, "uid")
    room = F.least(F.col("tokens"), length - F.pmod(F.col("at"), F.lit(length)))

    def piece(skip, take):
        begin = F.col("at") + skip
        return F.when(
            take > 0,
            F.struct(
                (F.col("rest_start") + skip).alias("start"),
                take.cast("bigint").alias("length"),
                F.substring(F.col("rest"), (skip * 4 + 1).cast("int"), (take * 4).cast("int")).alias("ids"),
                (F.floor(begin / length) * 2).cast("bigint").alias("sequence_id"),
                F.pmod(begin, F.lit(length)).cast("bigint").alias("offset"),
            ),
        )

    cut = F.array_compact(F.array(piece(F.lit(0).cast("bigint"), room), piece(room, F.col("tokens") - room)))
    shared = met.select("doc_id", "doc_tokens", F.explode(cut).alias("piece")).select(*columns)
    return alone.unionByName(shared)
