"""Recall and exact scores against brute force, balanced parts, and the defined cases."""

import numpy as np

from tapewire.llm import learned_index as lx
from tapewire.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<double>, vector int, part string"


def test_recall(spark):
    """Fresh vectors of two kinds, more than the rows that one part holds."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 32))[rng.integers(0, 40, 4000)] + 0.7 * rng.standard_normal((4000, 32))
    x[:700] = x[0]
    rows = [(i, v.tolist(), 0, "") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = lx.nearest(df, df.where("vec_id % 20 = 0"), 20).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in range(0, 4000, 20):
        assert sorted(found[q]) == list(range(1, 21))
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        want = np.lexsort((np.arange(4000), -scores))[:20]
        mine = [found[q][r] for r in range(1, 21)]
        assert np.allclose([s for _, s in mine], scores[[i for i, _ in mine]], rtol=1e-12)
        assert mine == sorted(mine, key=lambda m: (-m[1], m[0]))
        hits += len(set(want) & {i for i, _ in mine})
    assert hits / 4000 >= 0.9


def test_query_on_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.stack(table["embedding"]).astype(np.float64)
    ids = table["vec_id"].to_numpy()
    got = QUERIES["op2_learned_partitions"](spark, SF).toPandas()
    near = x[ids % 20 == 0] @ x.T
    near[ids[ids % 20 == 0][:, None] == ids] = -np.inf
    best = ids[np.argsort(-near, axis=1)[:, :20]]
    found = got.groupby("query_id")["vec_id"].apply(set)
    assert np.mean([len(found[q] & set(b)) / 20 for q, b in zip(ids[ids % 20 == 0], best)]) >= 0.9


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(0)
    group = np.repeat(np.arange(8), 100)
    near = np.stack([rng.choice(np.flatnonzero(group == g), 6) for g in group])
    part = lx.balanced_parts(near, 8)
    assert np.bincount(part).tolist() == [100] * 8
    assert (part[near] == part[:, None]).mean() > 0.8


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1, ""), (1, [2.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (3, None, 1, ""), (4, [0.0, 0.0], 1, ""), (5, [float("nan"), 1.0], 1, ""), (6, [1.0], 1, ""), (None, [1.0, 1.0], 1, ""), (20, [-1.0, 0.0], None, None), (40, [None, 1.0], 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in lx.nearest(df, df.where("vec_id % 20 = 0"), 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 2, 2.0), (20, 1, 0, -1.0), (20, 2, 1, -2.0), (20, 3, 2, -2.0)]
    assert lx.nearest(df, df.where("vec_id % 20 = 0"), 9).count() == 8
    assert lx.nearest(df.limit(0), df.limit(0), 3).count() == 0
