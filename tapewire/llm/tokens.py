"""Token ids of Arrow text columns, each distinct piece of a batch encoded once.

A text is cut only where the tokenizer itself always cuts and what follows does not
change what comes before: ahead of a space and a visible character, ahead of a full
stop or comma behind a letter or digit, and around a single line feed. Pieces are
slices of the column's own buffer; distinct ones go to the tokenizer and the ids
are gathered back. Any text that has no such place is one piece.
"""

from __future__ import annotations

import ctypes
import os
import re
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
ENCODED_BYTES = 1 << 21  # of texts encoded together: a piece that repeats among them is looked up once
CACHED_PIECES = 1 << 17
CACHED_BYTES = 64  # of a piece that is remembered
TOGETHER = 2048  # pieces of one call
MARKS = "¶§†|"  # fixed values: candidates for a word of its own between pieces

# 1: visible ASCII, 2: letter or digit of it, 4: lead byte of Latin-1 letters.
PIECE_KINDS = np.zeros(256, np.uint8)
PIECE_KINDS[33:127] = 1
for _low, _high in (b"09", b"AZ", b"az"):
    PIECE_KINDS[_low : _high + 1] |= 2
PIECE_KINDS[0xC3] = 4

SEPARATE = re.compile(rb" [!-~\xC3]", re.DOTALL)  # what a text is always cut ahead of


def text_chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` of at most `most` bytes of text each, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
    upto, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(sizes):
        base = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, base + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def piece_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places in the UTF-8 bytes where a piece begins; `starts` holds those of the texts."""
    n = len(data)
    begin = np.zeros(n + 1, bool)
    begin[starts] = True
    padded = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(1, np.uint8)])
    before2, before, here, after = padded[:n], padded[1 : n + 1], padded[2 : n + 2], padded[3 : n + 3]
    kind = PIECE_KINDS
    follows = (kind[here] & 5).astype(bool)
    space = (here == 32) & (kind[after] & 5).astype(bool) & ~begin[1:]
    latin = (before2 == 0xC3) & (before != 0x97) & (before != 0xB7)
    stop = ((here == 46) | (here == 44)) & ((kind[before] & 2).astype(bool) | latin)
    line = (here == 10) & (kind[before] & 1).astype(bool)
    behind = (before == 10) & (kind[before2] & 1).astype(bool) & follows & ~np.concatenate([[False], begin[:-2]])[:n]
    return np.flatnonzero(begin[:n] | space | stop | line | behind)


class GenerationCache:
    """What `make` gives for byte keys; keys in use are remembered, others go with their generation.

    At most twice `most` keys of at most `longest` bytes are held.
    """

    def __init__(self, make: Callable[[list[bytes]], list], most: int = CACHED_PIECES, longest: int = CACHED_BYTES):
        self.make, self.most, self.longest = make, most, longest
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def __call__(self, keys: list[bytes]) -> list:
        """The values of distinct keys in their order."""
        out = list(map(self.young.get, keys))
        new = []
        for i in [i for i, v in enumerate(out) if v is None]:
            out[i] = self.old.get(keys[i])
            if out[i] is None:
                new.append(i)
            else:
                self.young[keys[i]] = out[i]
        for i, value in zip(new, self.make([keys[i] for i in new]) if new else [], strict=True):
            out[i] = value
            if len(keys[i]) <= self.longest:
                self.young[keys[i]] = value
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
        return out


def byte_list(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column without nulls; slices of one object cost less than a scalar each."""
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data, at = column.buffers()[2][ends[0] : ends[-1]].to_pybytes(), (ends - ends[0]).tolist()
    return [data[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def piece_texts(texts: pa.Array, cut: Callable[[np.ndarray, np.ndarray], np.ndarray], cache: GenerationCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and their number per text; null texts have none.

    `cut` gives the places where pieces begin from the UTF-8 bytes and the starts of
    the texts; `cache` gives the ids of pieces as little-endian unsigned 32-bit.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if texts.offset:
        texts = pa.concat_arrays([texts])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    counts = np.zeros(len(texts), np.int64)
    if not len(texts) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint32), counts
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    filled = np.flatnonzero(np.diff(bounds))
    starts = cut(data, bounds[filled] - bounds[0])
    offsets = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    spread = pa.array(cache(byte_list(coded.dictionary)), pa.large_binary()).take(coded.indices)
    ends = np.frombuffer(spread.buffers()[1], np.int64)[spread.offset : spread.offset + len(spread) + 1] // 4
    ids = np.frombuffer(spread.buffers()[2] or b"", np.uint32)[ends[0] : ends[-1]]
    of_text = np.searchsorted(starts, bounds[filled] - bounds[0])
    counts[filled] = np.diff(np.append(ends[of_text], ends[-1]))
    return ids, counts


def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable Latin-1 is itself, the other bytes follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PieceEncoder:
    """Encodes Arrow columns; remembers pieces of earlier batches up to a bound.

    A call of the tokenizer costs more than a short piece, so new pieces that begin
    with a space and a visible character are encoded behind each other. Where they
    end follows from the bytes of the ids, or, in vocabularies that drop white space,
    from a mark between them that is a word of its own. If the ends do not fit, the
    pieces are encoded one by one.
    """

    def __init__(self, path: str, most: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cache = GenerationCache(self.code, most)
        alphabet = byte_alphabet()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        # Special ids never come from a text; their names need not be in the alphabet.
        self.bytes = [bytes(alphabet.get(c, 0x3F) for c in name) for name in names]
        self.sizes = np.array([len(b) for b in self.bytes])
        sample = " Some words, 12 of them.\n  é"
        self.spells = b"".join(self.bytes[i] for i in self.one_by_one([sample.encode()])[0]) == sample.encode()
        marks = [(m, self.one_by_one([f" {m} ".encode()])[0]) for m in MARKS]
        self.mark = next(((m.encode(), ids[0]) for m, ids in marks if len(ids) == 1), None)

    def one_by_one(self, pieces: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

    def in_line(self, pieces: list[bytes]) -> list[bytes] | None:
        """Ids of pieces encoded behind each other, or None if their ends are not met."""
        between = b"" if self.spells else b" " + self.mark[0]
        ids = np.array(self.one_by_one([between.join(pieces)])[0], "<u4")
        if self.spells:
            want, ends = np.cumsum([len(p) for p in pieces]), np.cumsum(self.sizes[ids])
            after = np.searchsorted(ends, want) + 1
            if after[-1] != len(ids) or (ends[after - 1] != want).any():
                return None
            first = np.concatenate([[0], after[:-1]])
        else:
            marks = np.flatnonzero(ids == self.mark[1])
            if len(marks) != len(pieces) - 1:
                return None
            first, after = np.concatenate([[0], marks + 1]), np.append(marks, len(ids))
        data = ids.tobytes()
        return [data[i:j] for i, j in zip((first * 4).tolist(), (after * 4).tolist(), strict=True)]

    def code(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(pieces)
        joint = [] if not (self.spells or self.mark) else [i for i, p in enumerate(pieces) if SEPARATE.match(p)]
        if not self.spells and self.mark:
            joint = [i for i in joint if self.mark[0] not in pieces[i]]
        for start in range(0, len(joint), TOGETHER):
            group = joint[start : start + TOGETHER]
            for i, ids in zip(group, self.in_line([pieces[i] for i in group]) or [], strict=False):
                out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.one_by_one([pieces[i] for i in rest]) if rest else [], strict=True):
            out[i] = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their number per text; null texts have none."""
        return piece_texts(texts, piece_starts, self.cache)


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file, loaded once per process.

    Code of this package travels to workers by value, so what is to outlive a task
    hangs on a module of the worker's own.
    """
    kept = sys.modules.setdefault("tapewire_worker_state", ModuleType("tapewire_worker_state")).__dict__
    if ("encoder", path) not in kept:
        kept["encoder", path] = PieceEncoder(path)
    return kept["encoder", path]


def end_task(*caches: GenerationCache) -> None:
    """Give back what a task remembered: the worker goes on to other steps and keeps its memory."""
    for cache in caches:
        cache.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        return  # another C library than glibc


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end` behind those of each text, and the numbers with it."""
    return np.insert(ids, np.cumsum(counts), end).astype(np.uint32), counts + 1
