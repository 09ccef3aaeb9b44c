"""Links and components against all pairs; star contraction against union-find."""

import numpy as np
import pytest

from tapewire.llm import near_dup as nd
from tapewire.llm.components import connected_components

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, n long"


def brute(rows, threshold=0.98):
    out = {}
    usable = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = {id(r): 0 for r in rows}
    parent = {id(r): r for r in rows}

    def find(r):
        while parent[id(r)] is not r:
            r = parent[id(r)]
        return r

    for key in {(r[2], len(r[1])) for r in usable}:
        group = [r for r in usable if (r[2], len(r[1])) == key]
        x = nd.unit_rows([r[1] for r in group])
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            links[id(group[i])] += 1
            links[id(group[j])] += 1
            a, b = sorted((find(group[i]), find(group[j])), key=lambda r: r[0])
            parent[id(b)] = a
    return sorted((r[0], links[id(r)], find(r)[0]) for r in rows)


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.standard_normal(24)
        for _ in range(int(rng.choice([1, 1, 1, 2, 3, 40]))):
            v = base + rng.standard_normal(24) * rng.choice([0, 0.08, 0.14])
            rows.append([len(rows), (v * rng.choice([1, 3])).tolist(), int(min(rng.integers(0, 6), 2)), "x", 1])
    return rows


def test_equals_all_pairs(spark):
    rows = corpus(1, 1500)
    odd = [[5000, None, 1, "", 1], [5001, [], 1, "", 1], [5002, [0.0] * 24, 1, "", 1], [5003, [None] * 24, 1, "", 1], [5004, [float("nan")] * 24, 1, "", 1], [5005, [float("inf")] * 24, 0, "", 1], [5006, rows[0][1], None, "", 1], [5007, [1e200, 1.0], 0, "", 1], [5008, [1e-200, 0.0], 0, "", 1], [5009, rows[3][1], rows[3][2], "", 1], [rows[4][0], rows[4][1], rows[4][2], "", 1]]
    rows += odd
    got = nd.link_vectors(spark.createDataFrame(rows, SCHEMA), leaf=40).collect()
    want = brute(rows)
    mine = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert [m[0] for m in mine] == [w[0] for w in want]
    assert all(m[1] <= w[1] for m, w in zip(mine, want))
    assert sum(m[1] for m in mine) >= 0.97 * sum(w[1] for w in want)
    assert np.mean([m[2] == w[2] for m, w in zip(mine, want)]) >= 0.99
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_whole_label_of_copies(spark):
    rows = [[i, [0.6, 0.8], 1, "", 1] for i in range(900)] + [[2000 + i, [0.6 + i * 1e-9, 0.8], 1, "", 1] for i in range(700)]
    got = nd.link_vectors(spark.createDataFrame(rows, SCHEMA), leaf=64).collect()
    assert {r["component_id"] for r in got} == {0} and min(r["n_links"] for r in got) >= 63


def test_empty_and_null(spark):
    df = spark.createDataFrame([[None, [1.0], 1, "", 1], [None, None, None, None, None]], SCHEMA)
    assert [(r["n_links"], r["component_id"]) for r in nd.link_vectors(df).collect()] == [(0, None)] * 2
    assert nd.link_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 2000 + i) for i in range(300)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: i for e in edges if e[0] != e[1] for i in e}
    for _ in range(len(want)):
        before = dict(want)
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
        if before == want:
            break
    assert got == want


def test_large_dense_group_keeps_every_link(spark):
    """More near-equal vectors than two leaves hold, among scattered ones and a chain at the threshold."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal(32)
    angles = np.arange(60) * np.arccos(0.9801)
    chain = [(np.eye(32)[0] * np.cos(a) + np.eye(32)[1] * np.sin(a)).tolist() for a in angles[:30]]
    dense = (base + rng.standard_normal((1500, 32)) * 0.1).tolist()
    rows = [[i, v, 0, "", 1] for i, v in enumerate(dense + chain + rng.standard_normal((600, 32)).tolist())]
    want = brute(rows)
    assert 0.9 < sum(w[1] for w in want) / 1500**2 < 1
    for leaf in (64, 200, 4096):
        got = nd.link_vectors(spark.createDataFrame(rows, SCHEMA), leaf=leaf).collect()
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
