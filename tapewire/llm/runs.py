"""Runs of periodic words, found by convolving blocks with the words that follow them.

Positions where a run of period q agrees with itself q words later form a stretch
of at least max(q, 12 - q) words, so a power of two L with 2L - 1 not above that
has a whole block at a multiple of L inside. For every such scale the block is
compared with all places at the distances of the scale at once: the sums of squared
differences come from an exact integer transform modulo a prime, and a zero sum is
an occurrence. Each distance found seeds a period that is extended to both sides.
A block is only convolved if each of its words comes again within the scale's
distances, which every block with an occurrence satisfies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tapewire.llm.tokens import text_chunks
from tapewire.llm.words import CHUNK_BYTES, SPACES, split_words

LEAST = 12  # words of the shortest run
PRIME = np.uint64(3 * 2**30 + 1)
GENERATOR = 5
BATCH_NUMBERS = 1 << 20  # transformed at once
FAR = np.iinfo(np.int64).max >> 1


def modulo(values: np.ndarray) -> np.ndarray:
    """Remainders modulo the prime; the division by a constant is the vectorised one."""
    return values - values // PRIME * PRIME


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row (a power of two long), without scaling."""
    n = rows.shape[1]
    size = n.bit_length() - 1
    place = np.arange(n)
    order = np.zeros(n, np.int64)
    for b in range(size):
        order |= ((place >> b) & 1) << (size - 1 - b)
    rows = rows[:, order]
    half = 1
    while half < n:
        root = pow(GENERATOR, (int(PRIME) - 1) // (2 * half), int(PRIME))
        if inverse:
            root = pow(root, -1, int(PRIME))
        powers = np.ones(half, np.uint64)
        filled, step = 1, root
        while filled < half:
            powers[filled : 2 * filled] = modulo(powers[:filled] * np.uint64(step))
            filled, step = 2 * filled, step * step % int(PRIME)
        parts = rows.reshape(len(rows), n // (2 * half), 2, half)
        low, high = parts[:, :, 0], modulo(parts[:, :, 1] * powers)
        total, less = low + high, low + (PRIME - high)
        rows = np.stack([np.where(total >= PRIME, total - PRIME, total), np.where(less >= PRIME, less - PRIME, less)], axis=2)
        rows = rows.reshape(len(parts), n)
        half *= 2
    return rows


def occurrences(words: np.ndarray, at: np.ndarray, length: int, nearest: int, farthest: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of places where the squared differences of a block sum up to zero modulo the prime.

    `words` holds numbers from 0 and reaches `farthest + length` beyond every block.
    """
    width = farthest - nearest + length
    n = 1 << (width - 1).bit_length()
    scale = np.uint64(pow(n, -1, int(PRIME)))
    found = []
    for start in range(0, len(at), max(1, BATCH_NUMBERS // n)):
        of = at[start : start + max(1, BATCH_NUMBERS // n)]
        block = np.zeros((len(of), n), np.uint64)
        block[:, :length] = words[of[:, None] + np.arange(length - 1, -1, -1)]  # reversed: a product is a correlation
        window = np.zeros((len(of), n), np.uint64)
        window[:, :width] = words[of[:, None] + nearest + np.arange(width)]
        product = modulo(transform(block) * transform(window))
        cross = modulo(transform(product, inverse=True) * scale)[:, length - 1 : length - 1 + farthest - nearest + 1]
        square = np.cumsum(np.pad(modulo(window[:, :width] ** 2), ((0, 0), (1, 0))), axis=1, dtype=np.uint64)
        ahead = square[:, length : length + cross.shape[1]] - square[:, : cross.shape[1]]
        own = modulo(block**2).sum(axis=1, dtype=np.uint64)[:, None]
        row, t = np.nonzero(modulo(own + ahead) == modulo(cross + cross))
        found.append((of[row], nearest + t))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class CommonLengths:
    """Lengths that two places have in common, from ranks of all stretches of 1, 2, 4, ... words."""

    def __init__(self, words: np.ndarray, longest: int):
        self.ranks = [words]
        while 2 << (len(self.ranks) - 1) <= longest:
            last, step = self.ranks[-1], 1 << (len(self.ranks) - 1)
            if len(last) <= step:
                break
            pair = last[: len(last) - step] * (last.max() + 1) + last[step:]
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from `a` on equal those from `b` on (a < b)."""
        a, b, start = a.copy(), b.copy(), a
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[k], 1 << k
            while True:  # more than once only at the top, where whole stretches may follow each other
                on = b < len(rank)
                on[on] = rank[a[on]] == rank[b[on]]
                a, b = a + on * step, b + on * step
                if k < len(self.ranks) - 1 or not on.any():
                    break
        return a - start

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words just before `a` equal those just before `b` (a < b)."""
        a, b, start = a.copy(), b.copy(), a
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[k], 1 << k
            while True:
                on = a >= step
                on[on] = rank[a[on] - step] == rank[b[on] - step]
                a, b = a - on * step, b - on * step
                if k < len(self.ranks) - 1 or not on.any():
                    break
        return start - a


def next_distance(words: np.ndarray) -> np.ndarray:
    """Words until the same one comes again."""
    order = np.argsort(words, kind="stable")
    out = np.full(len(words), FAR)
    same = words[order[1:]] == words[order[:-1]]
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """Block length, nearest and farthest distance of every scale for documents of up to `longest` words.

    A run of period q >= 2L - 1 agrees with itself at that many places; the first scale
    has the short periods too, whose runs of five words or more agree at three.
    """
    length, nearest = 2, 1
    while 2 * nearest <= longest:
        yield length, nearest, 4 * length - 2
        length, nearest = 2 * length, 4 * length - 1


@dataclass
class Line:
    """Documents behind each other, a number that no word has between them."""

    words: np.ndarray
    again: np.ndarray
    documents: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray

    def blocks(self, length: int, farthest: int) -> np.ndarray:
        """Blocks at multiples of `length` each of whose words comes again within `farthest` words."""
        n = len(self.again) // length * length
        return np.flatnonzero(self.again[:n].reshape(-1, length).max(axis=1) <= farthest) * length

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, at, side="right") - 1

    def only(self, keep: np.ndarray) -> Line:
        """The line of some of its documents, in order."""
        sizes = self.sizes[keep]
        ends = np.cumsum(sizes + 1)
        source = np.arange(sizes.sum() + len(keep)) + np.repeat(self.begins[keep] - (ends - sizes - 1), sizes + 1)
        return Line(self.words[source], self.again[source], self.documents[keep], ends - sizes - 1, sizes)


def lay(words: np.ndarray, bounds: np.ndarray) -> Line:
    sizes = np.diff(bounds)
    of = np.repeat(np.arange(len(sizes)), sizes)
    top = int(words.max(initial=0)) + 1
    again = next_distance(words + of * top)
    begins = bounds[:-1] + np.arange(len(sizes))
    line, gap = np.empty(len(words) + len(sizes), np.int64), np.full(len(words) + len(sizes), FAR)
    place = np.arange(len(words)) + of
    line[place], gap[place] = words, again
    line[begins + sizes] = top + np.arange(len(sizes))
    return Line(line, gap, np.arange(len(sizes)), begins, sizes)


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, ordered by document, start and period.

    `words` are the numbered words of all documents, `bounds` where each one's begin
    and end. A run is a stretch of smallest period q and of max(least, 2q) words or
    more that no neighbour extends. `least` is 5 at least.
    """
    none = np.zeros((0, 4), np.int64)
    if not len(words):
        return none
    line = lay(words, bounds)
    # A document with a run has such a block at the run's scale; most documents have none.
    hopeful = np.zeros(len(line.sizes), bool)
    for length, _, farthest in scales(int(line.sizes.max())):
        hopeful[line.owner(line.blocks(length, farthest))] = True
    hopeful &= line.sizes >= least
    if not hopeful.any():
        return none
    line = line.only(np.flatnonzero(hopeful))
    n, longest = len(line.words), int(line.sizes.max())
    numbers = np.unique(line.words, return_inverse=True)[1]
    common = CommonLengths(line.words, longest)
    runs = none[:, :3]  # start, end, period
    for length, nearest, farthest in scales(longest):
        cover = np.zeros(n, np.int64)
        known = runs[runs[:, 2] <= length]
        np.maximum.at(cover, known[:, 0], known[:, 1])
        cover = np.maximum.accumulate(cover)
        at = line.blocks(length, farthest)
        # What a run of a short period covers wholly has no other smallest period.
        at = at[cover[at] < at + length + farthest]
        if not len(at):
            continue
        beyond = max(0, int(at[-1]) + farthest + length - n)
        block, distance = occurrences(np.pad(numbers, (0, beyond)).astype(np.uint64), at, length, nearest, farthest)
        use = (block + distance + length <= n) & (cover[block] < block + length + distance)
        block, distance = block[use], distance[use]
        left = common.behind(block, block + distance)
        right = common.ahead(block, block + distance)
        found = np.stack([block - left, block + distance + right, distance], axis=1)
        found = found[(right >= length) & (found[:, 1] - found[:, 0] >= np.maximum(least, 2 * distance))]
        runs = np.unique(np.concatenate([runs, found]), axis=0)
    # Multiples of a run's period give the same stretch; the rows are sorted, the smallest comes first.
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    of = line.owner(runs[:, 0])
    out = np.stack([line.documents[of], runs[:, 0] - line.begins[of], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the text with every run cut to its first period.

    Words are stretches of anything but ASCII white space; `collapsed` joins the words
    kept by one space. Needs doc_id and text; other columns are not read. A null or
    blank text has no words, no runs and an empty collapsed text. Repeated rows are
    judged one by one, an empty table gives no row, a null doc_id stays null. Texts of
    any length are judged whole. There is no shuffle.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES):
                yield judge_chunk(chunk, least)

    return documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(judge, SCHEMA)


def judge_chunk(chunk: pa.RecordBatch, least: int) -> pa.RecordBatch:
    words = split_words(chunk["text"], SPACES)
    runs = find_runs(words.numbers, words.bounds, least)
    sizes = np.diff(words.bounds)
    kept = np.ones(len(words.numbers), bool)
    if len(runs):
        # Words behind a run's first period: marked by what begins and ends at each place.
        first = words.bounds[runs[:, 0]] + runs[:, 1]
        marks = np.zeros(len(kept) + 1, np.int64)
        np.add.at(marks, first + runs[:, 3], 1)
        np.add.at(marks, first + runs[:, 2], -1)
        kept = np.cumsum(marks[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[words.bounds]
    values = words.values if kept.all() else words.values.filter(pa.array(kept))
    lists = pa.LargeListArray.from_arrays(pa.array(left), values)
    text = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())
    per_row = np.concatenate([[0], np.cumsum(np.bincount(runs[:, 0], minlength=len(sizes)))]).astype(np.int32)
    structs = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
    columns = [chunk["doc_id"], pa.array(sizes), pa.ListArray.from_arrays(pa.array(per_row), structs), text.cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])
