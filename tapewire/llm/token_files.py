"""Token id files in Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector and as many ids of equal width as fit into the
other 60 bits. Ids of over 60 bits are escaped: the word holds their place in a
table of the block. A file is a row of blocks. A block holds whole documents: their
ids, the number of tokens of each, the words, and for every lane of 1,024 ids where
its words begin, so that lanes are coded and decoded as vectors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tapewire.llm.common import dealt, open_store, shared_folder, stage
from tapewire.llm.tokens import encoder, end_task, text_chunks, with_end
from tapewire.operators.ordering import running_total

COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])  # ids per word by selector
ESCAPE = 15
LANE = 1024
BLOCK_IDS = 1 << 20
READ_BYTES = 16 << 20  # of the files, per task
MAGIC = b"TWS8"
HEADER = "<4sIIIIQ"  # magic, crc32 of what follows, documents, lanes, escapes, words


def pack_words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, number of words per lane, and escaped values of unsigned 64-bit `values`."""
    values = np.asarray(values, np.uint64)
    n, lanes = len(values), -(-len(values) // LANE)
    width = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    escaped = np.flatnonzero(width > 60)
    table, small = values[escaped], values.copy()
    small[escaped] = np.arange(len(escaped), dtype=np.uint64)
    # Behind a lane's end nothing fits, so no word reaches over it.
    grid = np.full((lanes, LANE + 60), 255, np.uint8)
    filled = np.full(lanes * LANE, 255, np.uint8)
    filled[:n] = width
    grid[:, :LANE] = filled.reshape(lanes, LANE)
    flat, row = grid.reshape(-1), np.arange(lanes) * (LANE + 60)
    length = np.minimum(LANE, n - np.arange(lanes) * LANE)
    fits, wide = (60 // COUNTS[:8]).astype(np.uint8), (60 // COUNTS).astype(np.uint8)
    at, live = np.zeros(lanes, np.int64), np.arange(lanes)
    steps = []
    while len(live):
        window = flat[(row[live] + at[live])[:, None] + np.arange(8)]
        ok = np.maximum.accumulate(window, axis=1) <= fits
        pick = 7 - np.argmax(ok[:, ::-1], axis=1)
        pick[~ok.any(axis=1)] = ESCAPE
        if (long := np.flatnonzero(ok[:, 7])).size:
            window = flat[(row[live[long]] + at[live[long]])[:, None] + np.arange(60)]
            ok = np.maximum.accumulate(window, axis=1)[:, COUNTS - 1] <= wide
            pick[long] = len(COUNTS) - 1 - np.argmax(ok[:, ::-1], axis=1)
        steps.append((live, at[live], pick))
        at[live] += np.where(pick == ESCAPE, 1, COUNTS[np.minimum(pick, len(COUNTS) - 1)])
        live = live[at[live] < length[live]]
    if not steps:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16), table
    lane, place, pick = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.lexsort((place, lane))
    lane, place, pick = lane[order], place[order], pick[order]
    first, words = lane * LANE + place, pick.astype(np.uint64) << np.uint64(60)
    for s in np.unique(pick):
        count = 1 if s == ESCAPE else int(COUNTS[s])
        of = np.flatnonzero(pick == s)
        for j in range(count):
            words[of] |= small[first[of] + j] << np.uint64(60 // count * j)
    return words, np.bincount(lane, minlength=lanes).astype(np.uint16), table


def unpack_words(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The values of `words`, all words of one selector at a time."""
    pick = (words >> np.uint64(60)).astype(np.int64)
    counts = np.where(pick == ESCAPE, 1, COUNTS[np.minimum(pick, len(COUNTS) - 1)])
    ends = np.cumsum(counts)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint64)
    for s in np.unique(pick):
        of = np.flatnonzero(pick == s)
        first, load = ends[of] - counts[of], words[of] & np.uint64((1 << 60) - 1)
        if s == ESCAPE:
            out[first] = table[load.astype(np.int64)]
            continue
        width = 60 // int(COUNTS[s])
        for j in range(int(COUNTS[s])):
            out[first + j] = (load >> np.uint64(width * j)) & np.uint64((1 << width) - 1)
    return out


def block_bytes(keys: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, lanes, table = pack_words(ids)
    body = b"".join(
        [keys.astype("<i8").tobytes(), known.astype("u1").tobytes(), counts.astype("<i8").tobytes()]
        + [lanes.astype("<u2").tobytes(), table.astype("<u8").tobytes(), words.astype("<u8").tobytes()]
    )
    return struct.pack(HEADER, MAGIC, zlib.crc32(body), len(keys), len(lanes), len(table), len(words)) + body


def read_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, which of them are known, tokens of each, and all ids of a block."""
    magic, crc, docs, lanes, escapes, words = struct.unpack_from(HEADER, data)
    if magic != MAGIC or zlib.crc32(memoryview(data)[struct.calcsize(HEADER) :]) != crc:
        raise ValueError("not a whole block of token ids")
    at, parts = struct.calcsize(HEADER), []
    for kind, n in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<u2", lanes), ("<u8", escapes), ("<u8", words)):
        parts.append(np.frombuffer(data, kind, n, at))
        at += parts[-1].nbytes
    keys, known, counts, _, table, packed = parts
    return keys, known.astype(bool), counts, unpack_words(packed, table)


MANIFEST = "part int, block int, path string, offset long, bytes long, documents long, ids long"


def write_ids(documents: DataFrame, vocabulary: str, end: int, folder: str | None = None) -> DataFrame:
    """Write the ids of every document, `end` behind each, in ascending doc_id order; the staged list of blocks.

    `documents` needs doc_id and text; null texts are empty, a null doc_id comes
    first, rows that repeat an id are ordered by a digest of the text. An empty
    table writes no block. The order is a range partitioning by (doc_id, digest), so
    one id with many rows is cut over tasks too. A task writes under a name of its
    attempt and renames at the end: a lost or repeated task leaves no half file.
    """
    spark = documents.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    ordered = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("digest"))
        .repartitionByRange("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest")
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, store = TaskContext.get().partitionId(), None
        rows, held, size, out, at = [], [], 0, None, 0
        path = f"{folder}/part-{part:06d}.s8b"

        def flush():
            nonlocal held, size, at
            keys, known, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            data = block_bytes(keys, known, counts, ids)
            out.write(data)
            rows.append((part, len(rows), path, at, len(data), len(keys), len(ids)))
            at, held, size = at + len(data), [], 0

        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                if out is None:
                    store, final = open_store(path)
                    store.create_dir(final.rpartition("/")[0])
                    trial = f"{final}.{TaskContext.get().taskAttemptId()}"
                    out = store.open_output_stream(trial)
                ids, counts = with_end(*encoder(vocabulary).encode(chunk["text"]), end)
                key = chunk["doc_id"]
                keys = pc.fill_null(key, 0).to_numpy(zero_copy_only=False)
                held.append((keys, key.is_valid().to_numpy(zero_copy_only=False), counts, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    flush()
        if out is not None:
            if held:
                flush()
            out.close()
            store.move(trial, final)
        end_task(encoder(vocabulary).cache)
        if rows:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return stage(ordered.mapInArrow(write, MANIFEST), "token-blocks")


def read_ids(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) from the files.

    A row of `blocks` is one range of a file, so any number of tasks share the work.
    """
    placed = running_total(blocks, [], ["part", "block"], F.col("ids"), "upto")
    placed = placed.withColumn("first", F.col("upto") - F.col("ids"))
    spread = dealt(placed.select("part", "block", "path", "offset", "bytes", "first"), "bytes", ["part", "block"], READ_BYTES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["path"])
                with store.open_input_file(path) as source:
                    source.seek(row["offset"])
                    keys, known, counts, ids = read_block(source.read(row["bytes"]))
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64(), mask=~known),
                        pa.array(row["first"] + ends - counts),
                        pa.array(counts),
                        slices(ids.astype("<u4"), counts),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def slices(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary column whose rows are `counts` ids each of an unsigned 32-bit array."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * 4
    ids = np.ascontiguousarray(ids, "<u4")
    if offsets[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
