"""Words of Arrow text columns as numbers, cut on the column's own bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags of the 256 byte values inside the given inclusive ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


SPACES = byte_table((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """All words of a column in order: `numbers` into `distinct`, `bounds` of each row's words."""

    numbers: np.ndarray
    distinct: pa.Array
    bounds: np.ndarray
    values: pa.Array


def split_words(texts: pa.Array, gaps: np.ndarray, lower: bool = False) -> Words:
    """Maximal stretches of bytes outside `gaps` per row; null rows have none.

    Gaps are ASCII, so no character is cut. With `lower` A-Z are lower-cased first.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if texts.offset:
        texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    total = int(offsets[-1] - offsets[0]) if len(texts) else 0
    if not total:
        empty = pa.array([], pa.large_binary())
        return Words(np.zeros(0, np.int64), empty, np.zeros(len(texts) + 1, np.int64), empty)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    word = ~gaps[data]
    # A row's first byte begins a word even when the row before ends in one.
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    firsts = offsets[:-1][offsets[:-1] < np.minimum(offsets[1:], total)]
    begin[firsts] = word[firsts]
    starts = np.flatnonzero(begin)
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    lasts = firsts[1:] - 1
    stop[lasts] = word[lasts]
    ends = np.flatnonzero(stop) + 1
    # Words and gaps alternate in one binary array; every second entry is a word.
    cuts = np.stack([starts, ends], axis=1).reshape(-1)
    if not len(cuts):
        empty = pa.array([], pa.large_binary())
        return Words(np.zeros(0, np.int64), empty, np.zeros(len(texts) + 1, np.int64), empty)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
    values = pieces.take(pa.array(np.arange(0, len(cuts) - 1, 2)))
    coded = values.dictionary_encode()
    bounds = np.searchsorted(starts, offsets)
    return Words(coded.indices.to_numpy().astype(np.int64), coded.dictionary, bounds.astype(np.int64), values)
