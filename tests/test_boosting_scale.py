"""Scoring and counting of many boosted models."""

import numpy as np
from pyspark.sql import functions as F

from tapewire.operators import boosting as bo


def walked(model, x):
    """Scores by a walk of every single row."""
    out = []
    for row in x:
        margin = model["base"]
        for feature, cut, value in model["trees"]:
            at = 0
            while feature[at] >= 0:
                at = 2 * at + 1 + (row[feature[at]] > cut[at])
            margin += value[at]
        out.append(margin)
    return np.array(out)


def test_whole_columns_follow_the_paths_of_single_rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)).round(1)
    y = x[:, 0] * x[:, 1] + rng.normal(size=300)
    for depth in (1, 3, 5):
        model = bo.fit(x, y, np.ones(300), bo.Boost(rounds=6, depth=depth, leaf_rows=7))
        assert np.array_equal(bo.staged(model, x, [6])[:, 0], walked(model, x))


def test_calls_are_counted_in_the_task(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, float(a), float(b), None if i == 9 else float(a + b > 0), 1.0) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    rows += [(400, 0, None, 1.0, 1.0, 1.0), (401, 7, 1.0, 1.0, 1.0, 1.0)]  # a missing feature, a group without a model
    df = spark.createDataFrame(rows, "id int, g int, a double, b double, y double, w double").coalesce(1)
    settings = [bo.Boost(4, 0.3, 2, 2, "logistic"), bo.Boost(2, 0.1, 1, 2, "logistic")]
    models = bo.fit_models(df.where("g < 2"), settings, "g", "id", ["a", "b"], "y", "w")
    stages = {0: [1, 4], 1: [2]}
    scored = bo.score_rows(df, models, "g", ["a", "b"], stages, ["g", "y"])
    call = (F.col("score") >= 0.5).cast("int")
    cells = [F.sum(((F.col("y") == a) & (call == b)).cast("int")).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)]
    want = {tuple(r) for r in scored.groupBy("g", "setting", "rounds").agg(*cells).collect()}
    counted = bo.count_calls(df, models, "g", ["a", "b"], stages, "y")
    assert {tuple(r) for r in counted.collect()} == want and len(want) == 6
    assert sum(r["n00"] + r["n01"] + r["n10"] + r["n11"] for r in counted.collect()) == 399 * 3


def test_models_are_fitted_on_all_rows_of_their_group(spark):
    """More rows than the 100,000 that once bounded a training set, in several pieces."""
    rows = spark.range(100_500).selectExpr("id", "id % 2 as g", "id * 7919 % 100003 / 1000.0 as a", "0.0 as y")
    rows = rows.unionByName(rows.where("g = 0")).withColumn("y", (F.col("a") > 50).cast("double"))
    models = bo.fit_models(rows, [bo.Boost(1, 0.5, 1)], "g", "id", ["a"], "y")
    assert {(r["g"], r["rows"]) for r in models.collect()} == {(0, 100_500), (1, 50_250)}


def test_pieces_and_chunks_do_not_show(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 3))
    y, w = (x[:, 0] * x[:, 1] > 0).astype(float), rng.integers(1, 4, 500).astype(float)
    setting = bo.Boost(5, 0.3, 3, 4, "logistic")
    whole = bo.fit(x, y, w, setting)
    monkeypatch.setattr(bo, "CHUNK_ROWS", 64)
    cut = bo.fit(x, y, w, setting)
    assert [t[:2] for t in cut["trees"]] == [t[:2] for t in whole["trees"]]
    assert np.allclose(bo.staged(cut, x, [5]), bo.staged(whole, x, [5]), atol=1e-12)
    df = spark.createDataFrame([(i, 0, *map(float, r), float(b), float(c)) for i, (r, b, c) in enumerate(zip(x, y, w))], "id int, g int, a double, b double, c double, y double, w double")
    got = bo.score_rows(df, bo.fit_models(df, [setting], "g", "id", ["a", "b", "c"], "y", "w"), "g", ["a", "b", "c"], {0: [5]}, ["id"])
    want = bo.staged(whole, x, [5])[:, 0]
    assert np.allclose([r["score"] for r in got.orderBy("id").collect()], want, atol=1e-12)
