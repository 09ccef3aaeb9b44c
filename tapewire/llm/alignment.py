"""Alignment of two tokenizers' ids through the bytes they share.

Both tokenizers encode the whole text; the bytes of their tokens are laid beside each
other. Ends that both have ahead of tokens that begin with a space are anchors, which
split a document into windows of a few ids of each side. The groups of a window (what
lies between two shared ends) depend on its ids alone, so those of a chunk are worked
out once per pair of id tuples, all new tuples at a time, and looked up for the rest.

Counts of linked id pairs over all documents are a plain aggregation. They come back
to the documents by slices of a bounded number of pairs: every task looks up one
slice at a time, and a document's figures are summed over the slices.
"""

from __future__ import annotations

import hashlib
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tapewire.llm.common import open_store, shared_folder
from tapewire.llm.tokens import GenerationCache, PieceEncoder, encoder, end_task, piece_texts, text_chunks

CHUNK_BYTES = 1 << 20
SLICE_PAIRS = 1 << 21  # pairs a task holds at once: 48 MB
PARTIAL_PAIRS = 1 << 19  # distinct pairs a task adds up before it hands them on
SHORT_GROUP = 1024  # pairs of a group that are written out
MARK = "▁"  # fixed value: how the second vocabulary writes a space


class MarkedEncoder:
    """Ids of whole texts by a sentencepiece model that puts a space in front.

    If no piece of the vocabulary has a mark behind another character, no token
    reaches over a space that follows a visible character; there a text is cut and
    distinct pieces are encoded once. Otherwise every text is one piece.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.lone = np.array([self.model.piece_to_id(MARK)], "<u4").tobytes()
        self.cache = GenerationCache(self.code)

    def code(self, pieces: list[bytes]) -> list[bytes]:
        """The model adds the space itself, so the one a piece begins with is left out."""
        coded = self.model.encode([p[1:].decode() for p in pieces], num_threads=1)
        return [self.lone if p == b" " else array("I", ids).tobytes() for p, ids in zip(pieces, coded, strict=True)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each beginning with the space in front, and their number per text."""

        def starts(data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
            begin = np.zeros(len(data), bool)
            if self.cuts:
                begin[1:] = (data[1:] == 32) & (data[:-1] != 32)
                # The model reads a mark in the text as a space.
                written = np.flatnonzero((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81)) + 3
                begin[written] = False
            begin[firsts] = True
            return np.flatnonzero(begin)

        return piece_texts(texts, starts, self.cache)


@dataclass
class Pair:
    """Both encoders and the bytes of their ids."""

    a: PieceEncoder
    b: MarkedEncoder
    a_bytes: pa.Array
    b_bytes: pa.Array
    a_spaced: np.ndarray
    b_spaced: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    names: pa.Array

    @property
    def key_base(self) -> int:
        return len(self.b_bytes)


def encoders(a_path: str, b_path: str) -> Pair:
    """The worker's pair of encoders, loaded once per process."""
    kept = sys.modules.setdefault("tapewire_worker_state", ModuleType("tapewire_worker_state")).__dict__
    if ("pair", a_path, b_path) not in kept:
        a, b = encoder(a_path), MarkedEncoder(b_path)
        tables = [pa.array(side.bytes, pa.large_binary()) for side in (a, b)]
        spaced = [np.array([x[:1] == b" " for x in side.bytes]) for side in (a, b)]
        sizes = [np.array([len(x) for x in side.bytes]) for side in (a, b)]
        # Ids as text, each with the sign inside a group's side and the one at its end.
        signs = [(size, end) for size, end in zip(map(len, sizes), "|;", strict=True)]
        names = pa.array([f"{i}{sign}".encode() for n, end in signs for i in range(n) for sign in (",", end)], pa.large_binary())
        pair = Pair(a, b, *tables, *spaced, *sizes, names)
        kept["pair", a_path, b_path] = pair
    return kept["pair", a_path, b_path]


def spelled(ids: np.ndarray, counts: np.ndarray, table: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the ids, where each id ends in them, and where each text's begin and the last ends."""
    joined = table.take(pa.array(ids.astype(np.int64)))
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    data = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(ids) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    return data, offsets[1:], offsets[np.concatenate([[0], np.cumsum(counts)])]


def agreeing(chunk_texts: pa.Array, pair: Pair):
    """Ids of both sides for the rows whose bytes both equal the text with a space in front.

    Returns the rows, and per side the ids, their number per row and their ends in the
    bytes that both sides share.
    """
    filled = np.flatnonzero(pc.fill_null(pc.binary_length(chunk_texts), 0).to_numpy(zero_copy_only=False) > 0)
    texts = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), chunk_texts.take(pa.array(filled)).cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
    whole = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) else np.zeros(0, np.uint8)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    sides, good = [], np.ones(len(filled), bool)
    for side, table in ((pair.a, pair.a_bytes), (pair.b, pair.b_bytes)):
        ids, counts = side.encode(texts)
        data, ends, begins = spelled(ids, counts, table)
        same_size = np.diff(begins) == np.diff(bounds)
        if same_size.all() and np.array_equal(data, whole[bounds[0] : bounds[-1]]):
            equal = same_size
        else:
            equal = np.array([bool(s) and np.array_equal(data[b:e], whole[x:y]) for s, b, e, x, y in zip(same_size, begins[:-1], begins[1:], bounds[:-1], bounds[1:], strict=True)], bool)
        good &= equal
        sides.append((ids, counts, np.diff(np.concatenate([[0], ends]))))
    out = []
    for ids, counts, lengths in sides:
        of_good = np.repeat(good, counts)
        out.append((ids[of_good].astype(np.int64), counts[good], np.cumsum(lengths[of_good])))
    return filled[good], out[0], out[1]


@dataclass
class Alignments:
    """What distinct windows hold: text of their groups, number of groups, keys and occurrences of their pairs."""

    text: pa.Array
    groups: np.ndarray
    keys: np.ndarray
    times: np.ndarray
    sizes: np.ndarray


def align_windows(windows: pa.Array, pair: Pair) -> Alignments:
    """Groups of all windows: both sides' bytes run on from window to window, and shared ends part them."""
    offsets = np.frombuffer(windows.buffers()[1], np.int64)[windows.offset : windows.offset + len(windows) + 1] // 4
    raw = np.frombuffer(windows.buffers()[2], "<u4")[offsets[0] : offsets[-1]].astype(np.int64)
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], lengths)
    first_side = np.repeat(raw[offsets[:-1]], lengths)
    in_a, in_b = (place > 0) & (place <= first_side), place > first_side
    a, b = raw[in_a], raw[in_b]
    window = np.repeat(np.arange(len(windows)), lengths)[in_a]
    a_ends, b_ends = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    of_a, of_b = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
    n_a, n_b = np.bincount(of_a, minlength=len(shared)), np.bincount(of_b, minlength=len(shared))
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    first_a, first_b = last_a - n_a, last_b - n_b
    window = window[first_a]
    # Names in the order a1,a2|b1; with the sign that follows each.
    upto = np.cumsum(n_a + n_b)
    begin = upto - n_a - n_b
    names = np.empty(len(a) + len(b), np.int64)
    at_a, at_b = np.arange(len(a)), np.arange(len(b))
    names[begin[of_a] + at_a - first_a[of_a]] = 2 * a + (at_a + 1 == last_a[of_a])
    names[(begin + n_a)[of_b] + at_b - first_b[of_b]] = 2 * (len(pair.a_sizes) + b) + (at_b + 1 == last_b[of_b])
    text = pair.names.take(pa.array(names))
    groups = np.bincount(window, minlength=len(windows))
    token_bounds = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(groups)])]
    text_bounds = np.ascontiguousarray(np.frombuffer(text.buffers()[1], np.int64)[text.offset :][token_bounds])
    texts = pa.Array.from_buffers(pa.large_binary(), len(windows), [None, pa.py_buffer(text_bounds), text.buffers()[2]])
    # All pairs of short groups; equal ids of a long group are counted before they are paired.
    product = n_a * n_b
    short = np.flatnonzero(product <= SHORT_GROUP)
    per = product[short]
    of = np.repeat(short, per)
    step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    keys = [a[first_a[of] + step // n_b[of]] * pair.key_base + b[first_b[of] + step % n_b[of]]]
    times, owner = [np.ones(len(of), np.int64)], [window[of]]
    for g in np.flatnonzero(product > SHORT_GROUP).tolist():
        xs, x_times = np.unique(a[first_a[g] : last_a[g]], return_counts=True)
        ys, y_times = np.unique(b[first_b[g] : last_b[g]], return_counts=True)
        keys.append((xs[:, None] * pair.key_base + ys).reshape(-1))
        times.append((x_times[:, None] * y_times).reshape(-1))
        owner.append(np.full(len(keys[-1]), window[g]))
    all_keys, all_times, all_owners = np.concatenate(keys), np.concatenate(times), np.concatenate(owner)
    if len(keys) > 1:
        order = np.argsort(all_owners, kind="stable")
        all_keys, all_times = all_keys[order], all_times[order]
    return Alignments(texts, groups, all_keys, all_times, np.bincount(all_owners, minlength=len(windows)))


def align_chunk(texts: pa.Array, pair: Pair):
    """Per row: ids of each side, groups, links, digest; and (row, key, occurrences) of linked pairs."""
    n = len(texts)
    rows, (a, a_counts, a_ends), (b, b_counts, b_ends) = agreeing(texts, pair)
    figures = np.zeros((4, n), np.int64)
    digests = [""] * n
    if not len(rows):
        return figures, digests, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Starts that both sides share: of a text, or of tokens with a space on both sides.
    a_begins, b_begins = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    a_first, b_first = np.cumsum(a_counts) - a_counts, np.cumsum(b_counts) - b_counts
    a_mark, b_mark = pair.a_spaced[a].copy(), pair.b_spaced[b].copy()
    a_mark[a_first], b_mark[b_first] = True, True
    anchors, in_a, in_b = np.intersect1d(a_begins[a_mark], b_begins[b_mark], assume_unique=True, return_indices=True)
    at_a = np.append(np.flatnonzero(a_mark)[in_a], len(a))
    at_b = np.append(np.flatnonzero(b_mark)[in_b], len(b))
    # A window as bytes: how many ids of the first side, those, those of the other side.
    of_a, of_b = np.diff(at_a), np.diff(at_b)
    offsets = np.concatenate([[0], np.cumsum(of_a + of_b + 1)])
    flat = np.empty(offsets[-1], "<u4")
    flat[offsets[:-1]] = of_a
    flat[np.arange(len(a)) + np.repeat(offsets[:-1] + 1 - at_a[:-1], of_a)] = a
    flat[np.arange(len(b)) + np.repeat(offsets[:-1] + 1 + of_a - at_b[:-1], of_b)] = b
    windows = pa.Array.from_buffers(pa.large_binary(), len(of_a), [None, pa.py_buffer(offsets * 4), pa.py_buffer(flat)])
    coded = windows.dictionary_encode()
    known = align_windows(coded.dictionary, pair)
    which = coded.indices.to_numpy().astype(np.int64)
    first = np.searchsorted(anchors, a_begins[a_first])
    bounds = np.append(first, len(which))
    joined = known.text.take(coded.indices)
    ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][bounds]
    data = memoryview(joined.buffers()[2])
    for row, start, end in zip(rows.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        digests[row] = hashlib.sha256(data[start : end - 1]).hexdigest()
    # Pairs of every window, then of every row.
    begin = np.cumsum(known.sizes) - known.sizes
    per = known.sizes[which]
    place = np.repeat(begin[which] - (np.cumsum(per) - per), per) + np.arange(per.sum())
    of_row = np.repeat(np.repeat(np.arange(len(rows)), np.diff(bounds)), per)
    key, occ = known.keys[place], known.times[place]
    order = np.argsort(of_row * (pair.key_base * len(pair.a_sizes)) + key)
    key, owner, occ = key[order], of_row[order], occ[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    occ = np.add.reduceat(occ, heads)
    groups = known.groups[which]
    figures[0, rows], figures[1, rows] = a_counts, b_counts
    figures[2, rows] = np.add.reduceat(groups, bounds[:-1])
    figures[3, rows] = np.bincount(owner[heads], occ, len(rows)).astype(np.int64)
    return figures, digests, rows[owner[heads]], key[heads], occ


ALIGNED = "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def align_tokenizers(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text.

    The first vocabulary (byte level) reads the text behind a space, the second (a
    sentencepiece model) puts that space in front itself. Byte offsets where tokens of
    both end part a document into groups; tokens of a group are linked. An id pair's
    count is the number of documents that hold it linked, `n_best` the links whose count
    is the highest of their first id, `count_sum` the counts of all links.

    Needs doc_id and text. Texts that are null, empty or not spelled by both sides have
    no tokens: zeros and an empty digest. Repeated rows count as documents of their own;
    an empty table gives no row; a null doc_id stays null. Texts are encoded whole.
    """
    spark = documents.sparkSession
    rows = documents.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = encoders(a_path, b_path)
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES):
                figures, digests, row, key, times = align_chunk(chunk["text"], pair)
                sizes = np.bincount(row, minlength=len(chunk))
                columns = [chunk["uid"], chunk["doc_id"], *[pa.array(f) for f in figures], pa.array(digests, pa.string())]
                columns += [wide_slices(key.astype("<u8"), sizes), wide_slices(times.astype("<u4"), sizes)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])
        end_task(pair.a.cache, pair.b.cache)

    folder = shared_folder(spark, "aligned")
    rows.mapInArrow(align, ALIGNED).write.option("compression", "zstd").parquet(folder)
    aligned = spark.read.schema(ALIGNED).parquet(folder)
    slices, n = count_pairs(aligned, b_path)
    figures = reduce(DataFrame.union, [look_up(aligned, slices, s) for s in range(n)])
    summed = figures.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs", "times").join(summed, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")], "groups_sha256",
    )


def wide_slices(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary column whose rows are `counts` values each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def count_pairs(aligned: DataFrame, b_path: str) -> tuple[str, int]:
    """Folder of all pairs with their document counts, in slices of bounded size, and how many slices there are.

    A task adds up the pairs of its documents before they are shuffled, so a pair that
    every document has is one row per task.
    """
    spark = aligned.sparkSession

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], ["key", "docs"])

        for batch in batches:
            column = batch["pairs"].cast(pa.large_binary())
            for start in range(0, len(column), 256):
                met = np.frombuffer(b"".join(column[start : start + 256].to_pylist()), "<u8")
                keys, where = np.unique(np.concatenate([keys, met]), return_inverse=True)
                counts = np.bincount(where, np.concatenate([counts, np.ones(len(met), np.int64)]), len(keys)).astype(np.int64)
                if len(keys) >= PARTIAL_PAIRS:
                    yield out()
                    keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield out()

    base = vocabulary_size(b_path)
    pairs = aligned.select("pairs").mapInArrow(partial, "key long, docs long").groupBy("key").agg(F.sum("docs").alias("docs"))
    counted = shared_folder(spark, "pair-counts")
    pairs.write.parquet(counted)
    pairs = spark.read.schema("key long, docs long").parquet(counted)
    first = F.floor(F.col("key") / base)
    most = pairs.groupBy(first.alias("first")).agg(F.max("docs").alias("most"))
    n = max(1, -(-pairs.count() // SLICE_PAIRS))
    flagged = pairs.withColumn("first", first).join(most, "first").select(
        "key", "docs", (F.col("docs") == F.col("most")).alias("best"), F.pmod(F.xxhash64("key"), F.lit(n)).cast("int").alias("slice")
    )
    folder = shared_folder(spark, "pair-slices")
    flagged.repartition(n, "slice").sortWithinPartitions("slice", "key").write.partitionBy("slice").parquet(folder)
    return folder, n


def vocabulary_size(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()


def pair_slice(folder: str, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, their document counts and flags of one slice; the last one is held by the worker."""
    kept = sys.modules.setdefault("tapewire_worker_state", ModuleType("tapewire_worker_state")).__dict__
    if kept.get("slice", (None,))[0] != (folder, number):
        kept.pop("slice", None)
        store, path = open_store(f"{folder}/slice={number}")
        import pyarrow.dataset as ds

        found = ds.dataset(path, filesystem=store, format="parquet").to_table(columns=["key", "docs", "best"])
        keys = found["key"].to_numpy()
        order = np.argsort(keys)
        kept["slice"] = ((folder, number), keys[order], found["docs"].to_numpy()[order], found["best"].to_numpy()[order])
    return kept["slice"][1:]


def look_up(aligned: DataFrame, folder: str, number: int) -> DataFrame:
    """uid, n_best and count_sum of all documents as far as their pairs lie in one slice."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, best = pair_slice(folder, number)
            out = np.zeros((2, len(batch)), np.int64)
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                sizes = pc.binary_length(part["pairs"]).to_numpy() // 8
                met = np.frombuffer(b"".join(part["pairs"].to_pylist()), "<u8").astype(np.int64)
                times = np.frombuffer(b"".join(part["times"].to_pylist()), "<u4").astype(np.int64)
                row = np.repeat(np.arange(len(part)), sizes)
                at = np.minimum(np.searchsorted(keys, met), len(keys) - 1)
                here = keys[at] == met
                at, times, row = at[here], times[here], row[here]
                np.add.at(out[0], start + row, times * best[at])
                np.add.at(out[1], start + row, times * docs[at])
            yield pa.RecordBatch.from_arrays([batch["uid"], pa.array(out[0]), pa.array(out[1])], ["uid", "n_best", "count_sum"])

    return aligned.where("n_links > 0").select("uid", "pairs", "times").mapInArrow(find, "uid long, n_best long, count_sum long")
