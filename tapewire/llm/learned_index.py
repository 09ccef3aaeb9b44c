"""Nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts that cross few
edges, a small network learns the parts of a vector's neighbours from the vector,
and sends every row to its most probable part and every query to several. Inside
them the original vectors are compared in full.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tapewire.llm.common import stage
from tapewire.llm.near_dup import usable

SMALL = 2_000  # rows up to which one part holds all
ROWS_PER_PART = 256  # of the sample
MOST_PARTS = 512
GRAPH_NEIGHBOURS = 10
WIDTH = 128  # hidden units
EPOCHS = 20
COVER = 0.98  # share of held-out sample neighbours that the probed parts must hold
BLOCK_ROWS = 4_096
QUERY_ROWS = 2_048
SEED = 23


def sample_neighbours(spark, sample: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each sample row by inner product, found in tasks over blocks of rows."""
    shared = spark.sparkContext.broadcast(sample)
    blocks = spark.range(0, len(sample), 512, max(1, len(sample) // 2048))

    def search(batches):
        x = shared.value
        for batch in batches:
            for start in batch["id"]:
                near = x[start : start + 512] @ x.T
                near[np.arange(len(near)), start + np.arange(len(near))] = -np.inf
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                yield pd.DataFrame({"row": np.repeat(start + np.arange(len(near)), k), "near": best.reshape(-1)})

    found = blocks.mapInPandas(search, "row long, near long").toPandas().sort_values("row", kind="stable")
    return found["near"].to_numpy().reshape(len(sample), k)


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """Part of each row: the graph is halved again and again at the median of its slow eigenvector.

    All halves of a level are smoothed together: a few steps of averaging over the
    edges inside a half, with the half's mean taken off, leave the direction in
    which neighbours agree most.
    """
    n, k = near.shape
    row = np.concatenate([np.repeat(np.arange(n), k), near.reshape(-1)])
    other = np.concatenate([near.reshape(-1), np.repeat(np.arange(n), k)])
    part, rng = np.zeros(n, np.int64), np.random.default_rng(SEED)
    while part.max() + 1 < parts:
        value = rng.standard_normal(n)
        inside = part[row] == part[other]
        a, b = row[inside], other[inside]
        degree = np.bincount(a, minlength=n) + 1e-9
        size = np.bincount(part)
        for _ in range(40):
            value = value + np.bincount(a, value[b], n) / degree
            value -= (np.bincount(part, value) / size)[part]
            value /= np.sqrt(np.bincount(part, value**2) / size)[part] + 1e-12
        order = np.lexsort((value, part))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.concatenate([[0], np.cumsum(size)])[part[order]]
        part = part * 2 + (place * 2 >= size[part])
    return part


@dataclass
class Router:
    """One hidden layer over unit vectors; the most probable parts first."""

    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    shift: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(unit @ self.first + self.bias, 0) @ self.second + self.shift

    @classmethod
    def fit(cls, x: np.ndarray, wanted: np.ndarray, probes: int = 1) -> Router:
        """Cross entropy against `wanted`, the share of a row's neighbours in each part, by Adam."""
        rng = np.random.default_rng(SEED)
        d, parts = x.shape[1], wanted.shape[1]
        weights = [rng.standard_normal((d, WIDTH)) * np.sqrt(2 / d) * np.sqrt(d) / 2, np.zeros(WIDTH)]
        weights += [rng.standard_normal((WIDTH, parts)) / np.sqrt(WIDTH), np.zeros(parts)]
        mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for start in range(0, len(x), 256):
                at = order[start : start + 256]
                hidden = np.maximum(unit[at] @ weights[0] + weights[1], 0)
                logits = hidden @ weights[2] + weights[3]
                chance = np.exp(logits - logits.max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
                error = (chance - wanted[at]) / len(at)
                back = (error @ weights[2].T) * (hidden > 0)
                slopes = [unit[at].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
                step += 1
                rate = 0.01 * (1 - epoch / EPOCHS)
                for i, slope in enumerate(slopes):
                    mean[i] = 0.9 * mean[i] + 0.1 * slope
                    square[i] = 0.99 * square[i] + 0.01 * slope**2
                    weights[i] -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
        return cls(*weights, probes)


def learn_router(spark, sample: np.ndarray, parts: int, k: int) -> Router:
    """The router of a sample; how many parts a query asks is measured on a fifth that it was not fitted on."""
    near = sample_neighbours(spark, sample, min(max(k, GRAPH_NEIGHBOURS), len(sample) - 1))
    part = balanced_parts(near[:, :GRAPH_NEIGHBOURS], parts)
    wanted = np.zeros((len(sample), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(sample)), near.shape[1]), part[near].reshape(-1)), 1 / (near.shape[1] + 1))
    wanted[np.arange(len(sample)), part] += 1 / (near.shape[1] + 1)
    test = np.arange(len(sample)) % 5 == 0
    router = Router.fit(sample[~test], wanted[~test])
    scores = router.scores(sample)
    held = scores.argmax(axis=1)  # where the index would put each row
    rank = (-scores[test]).argsort(axis=1).argsort(axis=1)
    ranks = np.take_along_axis(rank, held[near[test]], axis=1)
    cover = np.bincount(ranks.reshape(-1), minlength=parts).cumsum() / ranks.size
    router.probes = int(np.searchsorted(cover, COVER) + 1)
    return router


def _route(shared, counts: np.ndarray | None, least: int):
    def route(batches):
        router = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["vector"]).astype(np.float64)
            order = np.argsort(-router.scores(x), axis=1, kind="stable")
            if counts is None:
                yield batch.assign(part=order[:, 0])
                continue
            # More parts where the probable ones hold too few rows to fill a result.
            enough = (np.cumsum(counts[order], axis=1) >= least).argmax(axis=1) + 1
            enough[counts.sum() < least] = len(counts)
            take = np.maximum(enough, router.probes)
            row = np.repeat(np.arange(len(batch)), take)
            column = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
            yield batch.iloc[row].assign(part=order[row, column])

    return route


def _search(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            ids, x = rows["vec_id"].to_numpy(), np.stack(rows["vector"]).astype(np.float64)
            asked, q = queries["vec_id"].to_numpy(), np.stack(queries["vector"]).astype(np.float64)
            size = np.abs(x).sum(axis=1).max() * np.abs(q).max()
            for start in range(0, len(q), 256):
                near = q[start : start + 256] @ x.T
                near[asked[start : start + 256, None] == ids[None, :]] = -np.inf
                if near.shape[1] > k:
                    edge = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k] - 1e-12 * size
                else:
                    edge = np.full((len(near), 1), -np.inf)
                for i, at in enumerate(near):
                    best = np.flatnonzero((at >= edge[i]) & (at > -np.inf))
                    # The same sum for equal vectors wherever they stand, so ties go by id.
                    exact = (x[best] * q[start + i]).sum(axis=1)
                    top = np.lexsort((ids[best], -exact))[:k]
                    out.append(pd.DataFrame({"query_id": asked[start + i], "vec_id": ids[best[top]], "score": exact[top]}))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return pd.concat(out)

    return search


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner product found for every query.

    Both inputs need vec_id and embedding. Rows with a query's own id are no
    candidates for it; ties go to the smaller id; a query has all candidates if
    there are fewer than k. Null or zero vectors, those with null or non-finite
    components, null ids, and vectors whose length is not the commonest one take no
    part. Repeated rows are candidates of their own. Empty tables give no rows.

    The index is fitted on a bounded sample of at most MOST_PARTS * ROWS_PER_PART
    rows, chosen by a hash of the id; every row is indexed. The number of parts
    grows with the root of the rows. Parts are searched in blocks of about
    BLOCK_ROWS rows against QUERY_ROWS queries, so a part with a third of all rows
    is many groups.
    """
    spark = embeddings.sparkSession
    clean = lambda df: df.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector")
    )
    rows, asked = clean(embeddings), clean(queries)
    widths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d, n = (widths["d"], widths["n"]) if widths else (0, 0)
    rows, asked = rows.where(F.size("vector") == d), asked.where(F.size("vector") == d)
    parts = 1 if n <= SMALL else min(MOST_PARTS, 1 << int(np.ceil(np.log2(np.sqrt(n) / 4))))
    router = Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    if parts > 1:
        share = min(1.0, parts * ROWS_PER_PART / n)
        drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        sample = np.stack(drawn.orderBy("vec_id").toPandas()["vector"]).astype(np.float64)
        router = learn_router(spark, sample, parts, k)
    shared = spark.sparkContext.broadcast(router)
    schema = "vec_id long, vector array<double>, part int"
    double = lambda df: df.select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    placed = stage(double(rows).mapInPandas(_route(shared, None, 0), schema), "index")
    counts = np.zeros(parts, np.int64)
    for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect():
        counts[r["part"]] = r["n"]
    routed = stage(double(asked).mapInPandas(_route(shared, counts, 4 * k), schema), "routed")
    sizes = placed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    chunks = routed.groupBy("part").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("chunks"))
    grid = stage(sizes.join(chunks, "part"), "grid")
    spread = lambda df, own, other: df.join(F.broadcast(grid), "part").select(  # noqa: E731  at most MOST_PARTS rows
        "vec_id",
        "vector",
        "part",
        F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int").alias(own[:-1]),
        F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1]),
    )
    left = spread(routed, "chunks", "blocks").groupBy("part", "block", "chunk")
    right = spread(placed, "blocks", "chunks").groupBy("part", "block", "chunk")
    found = left.cogroup(right).applyInPandas(_search(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
