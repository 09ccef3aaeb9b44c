"""Runs by block convolution against all periods tried one by one."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from conftest import SMALL
from tapewire.llm import runs
from tapewire.llm.queries import QUERIES
from tapewire.llm.words import SPACES, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(words, least=12):
    """(start, length, period) of every run, each period on its own."""
    words, found = np.asarray(words), {}
    for q in range(1, len(words) // 2 + 1):
        same = np.concatenate([[0], (words[:-q] == words[q:]).astype(int), [0]])
        edges = np.flatnonzero(np.diff(same))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
    return sorted((i, j - i, q) for (i, j), q in found.items())


def check(documents, least=12):
    bounds = np.cumsum([0] + [len(d) for d in documents])
    words = np.array([w for d in documents for w in d], np.int64)
    got = runs.find_runs(words, bounds, least).tolist()
    assert got == [[d, *r] for d, ws in enumerate(documents) for r in all_runs(ws, least)]


def test_transform_is_a_convolution():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 20, (2, 5, 64), dtype=np.uint64)
    back = runs.modulo(runs.transform(runs.modulo(runs.transform(a) * runs.transform(b)), inverse=True) * np.uint64(pow(64, -1, int(runs.PRIME))))
    for x, y, z in zip(a.tolist(), b.tolist(), back.tolist()):
        assert z == [sum(x[i] * y[(k - i) % 64] for i in range(64)) % int(runs.PRIME) for k in range(64)]


def test_occurrences_are_exact():
    words = np.random.default_rng(4).integers(0, 2, 400).astype(np.uint64)
    at = np.arange(0, 320, 4)
    got = set(zip(*(x.tolist() for x in runs.occurrences(words, at, 4, 7, 14))))
    assert got == {(i, d) for i in at.tolist() for d in range(7, 15) if (words[i : i + 4] == words[i + d : i + d + 4]).all()}


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=5), st.sampled_from([5, 12]))
def test_few_words(documents, least):
    check(documents, least)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.integers(1, 6), st.integers(0, 39)), max_size=6))
def test_planted_repeats(parts):
    check([[w for ws, times, more in parts for w in ws * times + ws[:more]]])


def test_long_periods_and_words():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1000, 3000).tolist()
    check([base + base + base[:100], [7] * 5000, [1, 2] * 2000 + [3] + [1, 2] * 2000, base[:11], [], list(range(40))])
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 2500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    check([fibonacci[-1]])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aé \t\x0b \n日", max_size=20)), max_size=8))
def test_words_of_texts(texts):
    words = split_words(pa.array(texts, pa.string()), SPACES)
    all_words = [w.decode() for w in words.values.to_pylist()]
    for i, text in enumerate(texts):
        assert all_words[words.bounds[i] : words.bounds[i + 1]] == WORD.findall(text or "")
    assert words.distinct.take(pa.array(words.numbers)).to_pylist() == words.values.to_pylist()


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = all_runs([numbers[w] for w in words])
    dropped = {k for i, length, q in found for k in range(i + q, i + length)}
    best = min(((-length, i, q) for i, length, q in found), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    lines = "".join(f"{i},{length},{q}\n" for i, length, q in found)
    return (doc_id, len(found), *top, digest(lines), digest(" ".join(w for k, w in enumerate(words) if k not in dropped)))


def test_query(spark, duck):
    rows = QUERIES["op12_periodic_runs"](spark, SMALL)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(*r) for r in duck.execute("SELECT doc_id, text FROM documents").fetchall()]
    assert sorted(map(tuple, rows.collect())) == sorted(want)
    assert sum(w[1] > 0 for w in want) > 10


def test_odd_rows(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate([None, "", " \n\t", "a " * 30_000, "b", "a b c " * 5, " ".join(map(str, range(50))) * 2])]
    rows += [(7, "x y " * 9, "r"), (7, "x y " * 9, "r"), *[(100 + i, "one two three four five", "y") for i in range(60)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    small = [r for r in rows if len(r[1] or "") < 20_000]
    assert all(tuple(by_id[r[0]]) == expected(*r[:2]) for r in small)
    assert (by_id[3]["n_runs"], by_id[3]["start"], by_id[3]["length"], by_id[3]["period"]) == (1, 0, 30_000, 1)
    assert by_id[3]["collapsed_sha256"] == digest("a")
    plain = runs.periodic_runs(df.where("doc_id = 7")).collect()
    assert len(plain) == 2 and plain[0]["runs"][0].asDict() == {"start": 0, "length": 18, "period": 2} and plain[0]["collapsed"] == "x y"
    assert runs.periodic_runs(df.limit(0)).count() == 0
    assert runs.periodic_runs(spark.createDataFrame([(None, "q")], "doc_id long, text string")).first()["doc_id"] is None
