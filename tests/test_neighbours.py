"""Exact neighbours, density clusters and Euclidean silhouettes against all pairs."""

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tapewire.operators import neighbours as nb


def clouds(n=600, d=8, seed=1):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, s, (n // 4, d)) for c, s in ((0, 0.3), (3, 0.3), (6, 0.6), (0, 4.0))])
    x[:40] = x[0]  # copies
    return x


def frame(spark, x):
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9_000, None), (9_001, [float("nan")] * x.shape[1]), (9_002, [None] * x.shape[1])]
    return spark.createDataFrame(rows, "key long, v array<double>")


def apart(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def plain_dbscan(x, eps, least):
    d = apart(x)
    core = (d <= eps).sum(1) >= least
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            label[i], stack = i, [i]
            while stack:
                for j in np.flatnonzero(core & (d[stack.pop()] <= eps)):
                    if label[j] < 0:
                        label[j] = i
                        stack.append(int(j))
    for i in np.flatnonzero(~core):
        near = np.where(core, np.round(d[i], 9), np.inf)
        if near.min() <= eps:
            label[i] = label[int(near.argmin())]
    return label


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(nb, "ROWS_PER_PIVOT", 60)
    monkeypatch.setattr(nb, "BLOCK_ROWS", 64)


def test_nearest_distances(spark, small_blocks):
    x = clouds()
    points, members = nb.distinct_vectors(frame(spark, x), "key", "v")
    assert points.count() == len(x) - 39 and members.count() == len(x)
    got = {r["key"]: r["distances"] for r in members.join(nb.nearest_distances(points, 10), "id").collect()}
    want = np.sort(apart(x), axis=1)[:, :10]
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-6)


def test_fewer_rows_than_neighbours_and_none(spark):
    points, members = nb.distinct_vectors(frame(spark, clouds()[:3]), "key", "v")
    assert [r["distance"] for r in nb.k_distances(points, members, 3).collect()] == [0.0] * 3
    assert [r["distance"] for r in nb.k_distances(points, members, 4).collect()] == [None] * 3
    empty = frame(spark, clouds()).limit(0)
    assert nb.k_distances(*nb.distinct_vectors(empty, "key", "v")).count() == 0
    assert nb.density_clusters(empty, "key", "v")[0].count() == 0


def test_density_labels(spark, small_blocks):
    x = clouds()
    points, members = nb.distinct_vectors(frame(spark, x), "key", "v")
    settings = [nb.Setting(e, k) for e in (0.5, 0.9, 1.4) for k in (3, 8)]
    rows = members.join(nb.density_labels(points, settings), "id").collect()
    for s, setting in enumerate(settings):
        got = {r["key"]: r["cluster"] for r in rows if r["setting"] == s}
        assert [got.get(i, -1) for i in range(len(x))] == plain_dbscan(x, setting.eps, setting.min_samples).tolist()


def plain_silhouettes(x, label):
    d, out = apart(x), {}
    for i in np.flatnonzero(label >= 0):
        means = {c: d[i][label == c].sum() / max(1, (label == c).sum() - (c == label[i])) for c in set(label[label >= 0].tolist())}
        a = means.pop(int(label[i]))
        b = min(means.values(), default=0.0)
        lone = (label == label[i]).sum() == 1 or not means
        out[int(i)] = 0.0 if lone or not max(a, b) else (b - a) / max(a, b)
    return out


def test_best_setting(spark, small_blocks):
    x = clouds(400)
    labels, best = nb.density_clusters(frame(spark, x), "key", "v", 1.0)
    trials = []
    for s, (eps, k) in enumerate((1.0 * step, k) for step in nb.EPS_STEPS for k in nb.MIN_SAMPLES):
        label = plain_dbscan(x, eps, k)
        if 2 <= len(set(label[label >= 0].tolist())) <= 60 and (label >= 0).sum() >= 0.5 * (len(x) + 3):
            trials.append((-round(float(np.mean(list(plain_silhouettes(x, label).values()))), 9), s, eps, k, label))
    want = min(trials, key=lambda t: t[:2])
    assert (round(best.eps, 9), best.min_samples) == (round(want[2], 9), want[3])
    names = {c: i for i, c in enumerate(sorted(set(want[4].tolist()) - {-1}))}
    got = {r["key"]: r["cluster"] for r in labels.collect()}
    assert [got[i] for i in range(len(x))] == [names.get(c, -1) for c in want[4].tolist()]
    assert [got[i] for i in (9_000, 9_001, 9_002)] == [-1] * 3


def test_no_setting_fits(spark):
    """One dense ball: never two clusters, so the given eps with the fewest samples stands."""
    x = np.random.default_rng(2).normal(0, 0.01, (60, 4))
    labels, best = nb.density_clusters(frame(spark, x), "key", "v", 5.0)
    assert best == nb.Setting(5.0, 3)
    assert {r["cluster"] for r in labels.where("key < 100").collect()} == {0}


def test_spanning_edges_hold_components_of_every_threshold():
    w = np.random.default_rng(3).random((12, 9))
    w[w > 0.6] = np.inf
    x, y, d = nb.spanning_edges(w)

    def parts(pairs):
        label = list(range(21))
        for a, b in pairs:
            old, new = label[a], label[12 + b]
            label = [new if z == old else z for z in label]
        return {tuple(i for i, z in enumerate(label) if z == c) for c in set(label)}

    for t in (0.05, 0.1, 0.2, 0.4, 0.6):
        assert parts(zip(*np.nonzero(w <= t))) == parts(zip(x[d <= t], y[d <= t]))


def test_query_on_given_vectors(spark):
    rows = entry.queries()["dbscan"](spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in table], float)
    want = plain_dbscan(x, rows[0]["eps"], rows[0]["min_samples"])
    names = {c: i for i, c in enumerate(sorted(set(want.tolist()) - {-1}))}
    got = {r["vec_id"]: r["cluster"] for r in rows}
    assert [got[r["vec_id"]] for r in table] == [names.get(c, -1) for c in want.tolist()]


def test_pairs_of_blocks_shuffle_no_vectors(spark, small_blocks):
    """Vectors without structure reach every block: blocks are read again, rows are not copied per region or block."""
    x = np.random.default_rng(5).normal(size=(500, 16))
    points, _ = nb.distinct_vectors(frame(spark, x), "key", "v")
    blocks = nb.blocks_of(nb.divide(points).homes)
    assert blocks.count() >= 500 // nb.BLOCK_ROWS

    def count(a, others):
        yield pd.DataFrame({"id": a.rows["id"], "n": sum(len(b.v) for b in others)})

    seen = nb.compare(blocks, blocks, None, count, "id long, n long")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    assert [r["n"] for r in seen.groupBy("id").sum("n").withColumnRenamed("sum(n)", "n").collect()] == [500] * 500
    want = np.sort(apart(x), axis=1)[:, :10]
    got = {r["id"]: r["distances"] for r in nb.nearest_distances(points, 10).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-6)
