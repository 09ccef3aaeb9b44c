"""Boosted trees side by side: growth against plain loops, staged scores, and the search over all settings."""

import json

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tapewire.operators import boosting as bo
from tapewire.operators import learn as ln


def plain_tree(x, r, depth, least):
    """Prediction per row of the tree that splits greedily by squared error, each cut tried in turn."""
    best = (1e-9, None)
    for f in range(x.shape[1]):
        for c in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= c
            if min(left.sum(), (~left).sum()) >= least:
                gain = r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum() - r.sum() ** 2 / len(r)
                if gain > best[0] + 1e-9:
                    best = (gain, left)
    if depth == 0 or best[1] is None:
        return np.full(len(r), r.mean())
    out, left = np.empty(len(r)), best[1]
    out[left], out[~left] = plain_tree(x[left], r[left], depth - 1, least), plain_tree(x[~left], r[~left], depth - 1, least)
    return out


@pytest.mark.parametrize("depth, least", [(1, 1), (3, 1), (3, 7)])
def test_squared_rounds_equal_plain_trees(depth, least):
    rng = np.random.default_rng(depth)
    x = np.round(rng.normal(size=(150, 3)), 1)
    x = x[:, [0, 1, 2]]
    y = np.sin(x[:, 0]) + x[:, 1] * x[:, 2] + rng.normal(0, 0.1, 150)
    model = bo.fit(x, y, np.ones(150), bo.Boost(4, 0.3, depth, least))
    margin, want = np.full(150, y.mean()), []
    for _ in range(4):
        margin = margin + 0.3 * plain_tree(x, y - margin, depth, least)
        want.append(margin)
    got = bo.staged(json.loads(json.dumps(model)), x, [1, 2, 3, 4])
    assert np.allclose(got, np.stack(want, axis=1), atol=1e-8)


def test_fewer_rounds_are_a_stage_of_more():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    long = bo.fit(x, y, np.ones(300), bo.Boost(30, 0.1, 3, 2, "logistic"))
    for rounds in (1, 10, 30):
        short = bo.fit(x, y, np.ones(300), bo.Boost(rounds, 0.1, 3, 2, "logistic"))
        assert np.array_equal(bo.staged(short, x, [rounds])[:, 0], bo.staged(long, x, [1, 10, 30])[:, [1, 10, 30].index(rounds)])
    prob = bo.staged(long, x, [30])[:, 0]
    assert ((prob > 0.5) == (y > 0.5)).mean() > 0.95 and 0 < prob.min() and prob.max() < 1


def test_constant_and_single_rows():
    model = bo.fit(np.zeros((5, 2)), np.arange(5.0), np.ones(5), bo.Boost(3))
    assert np.allclose(bo.staged(model, np.zeros((2, 2)), [3]), 2.0)
    one = bo.fit(np.array([[1.0]]), np.array([1.0]), np.ones(1), bo.Boost(2, loss="logistic"))
    assert np.isfinite(bo.staged(one, np.array([[5.0]]), [2])).all()


def test_models_of_groups_equal_single_fits(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 2)), 2)
    y = x[:, 0] * 2 + (x[:, 1] > 0) + rng.normal(0, 0.1, 400)
    rows = [(int(i), int(i % 3), float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows + [(999, 0, None, 1.0, 1.0)], "id long, g int, a double, b double, y double")
    settings = [bo.Boost(8, 0.2, 2, 3), bo.Boost(5, 0.1, 4, 1)]
    models = bo.fit_models(df, settings, "g", "id", ["a", "b"], "y")
    assert models.count() == 6 and {r["rows"] for r in models.collect()} == {133, 134}
    got = bo.score_rows(df, models, "g", ["a", "b"], {0: [3, 8], 1: [5]}, ["id"]).collect()
    assert len(got) == 400 * 3
    for s, setting, stages in ((0, settings[0], [3, 8]), (1, settings[1], [5])):
        for g in range(3):
            of = np.arange(400) % 3 == g
            want = bo.staged(bo.fit(x[of], y[of], np.ones(of.sum()), setting), x[of], stages)
            for i, r in enumerate(stages):
                mine = {q["id"]: q["score"] for q in got if q["setting"] == s and q["rounds"] == r}
                assert np.allclose([mine[int(j)] for j in np.flatnonzero(of)], want[:, i])
    few = bo.fit_models(df, settings[:1], "g", "id", ["a", "b"], "y", fit_rows=50)
    assert {r["rows"] for r in few.collect()} == {50}


def test_whole_grid_ends_and_is_ranked(spark):
    rows = entry.queries()["tune_grid"](spark, SMALL).orderBy("rank").collect()
    assert len(rows) == 81 and sorted(r["parameters"] for r in rows) == sorted(map(str, ln.grid(ln.GBT_GRID)))
    assert [r["rank"] for r in rows] == list(range(1, 82))
    means = [round(r["mean_test"], 9) for r in rows]
    assert means == sorted(means, reverse=True) and 0 < means[-1] and means[0] <= 1
