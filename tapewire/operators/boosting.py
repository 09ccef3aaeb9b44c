"""Boosted trees for many training sets and settings side by side.

A training set (a fold left out, a window of history) is packed once as bin numbers of
one byte; one Spark task fits one model on them, so hundreds of fits are one job.
Models are small rows that come back as data. All rows are scored in parallel, and a
fit of many rounds also gives the models of fewer rounds on the way (staged scores).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapewire.operators.ordering import hashed_rank
from tapewire.session import cut_lineage

CHUNK_ROWS = 1 << 18  # rows whose figures are held at once; all rows have some 30 bytes each
MODELS = 4096  # most models of one call; they are held by the driver and by every scoring task
BINS = 64


@dataclass(frozen=True)
class Boost:
    """Settings of one fit; `loss` is "squared" or "logistic" (labels 0 and 1), `l2` shrinks leaves."""

    rounds: int = 300
    step: float = 0.05
    depth: int = 5
    leaf_rows: int = 1
    loss: str = "squared"
    l2: float = 0.0


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of every column between its distinct values, or between quantiles where it has many."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1), method="inverted_cdf"))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def grow(codes: np.ndarray, width: int, figures: Callable[[slice], tuple[np.ndarray, np.ndarray]], weight: np.ndarray, s: Boost):
    """One tree by levels: (feature, cut, value) of its nodes in heap order and the node of every row.

    `codes` are bin numbers (features, rows), `figures` gives residuals and hessians of a
    stretch of rows. A split is the best gain in squared residuals over all features and
    bins of a node; both sides keep `leaf_rows` rows. A feature of -1 marks a leaf.
    """
    p, n = codes.shape
    size = (2 << s.depth) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
    node = np.zeros(n, np.int32)
    chunks = [slice(start, start + CHUNK_ROWS) for start in range(0, n, CHUNK_ROWS)]
    for level in range(s.depth + 1):
        first, many = (1 << level) - 1, 1 << level
        last = level == s.depth  # leaves need no histograms, only the sums of one feature
        sums, down, empty = np.zeros((3, many, 1 if last else p, width)), np.zeros(many), True
        for rows in chunks:
            live = np.flatnonzero(node[rows] >= first)
            if not len(live):
                continue
            empty = False
            whole = len(live) == len(node[rows])
            part = (lambda values: values) if whole else (lambda values: values[live])
            residual, hessian = figures(rows)
            at = part(node[rows]).astype(np.int64) - first
            heavy = part(weight[rows])
            pulled = part(residual) * heavy
            down += np.bincount(at, part(hessian) * heavy, many)
            base = at * width
            for f in range(sums.shape[2]):  # one feature at a time: the rows' figures are not copied per feature
                place = base + part(codes[f, rows])
                for of, figure in enumerate((pulled,) if last else (pulled, heavy, None)):
                    sums[of, :, f] += np.bincount(place, figure, many * width).reshape(many, width)
        if empty:
            break
        g, w, counts = (c.cumsum(axis=2) for c in sums)
        total_g, total_w, total_n = g[:, :1, -1:], w[:, :1, -1:], counts[:, :1, -1:]
        up = total_g[:, 0, 0]
        value[first : first + many] = np.divide(up, down + s.l2, out=np.zeros(many), where=down > 1e-12)
        if last:
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g**2 / (w + s.l2) + (total_g - g) ** 2 / (total_w - w + s.l2) - total_g**2 / (total_w + s.l2)
        gain[(counts < s.leaf_rows) | (total_n - counts < s.leaf_rows) | (counts == 0) | (counts == total_n) | ~np.isfinite(gain)] = 0.0
        best = gain.reshape(many, -1).argmax(axis=1)
        split = gain.reshape(many, -1)[np.arange(many), best] > 1e-12
        feature[first : first + many] = np.where(split, best // width, -1)
        cut[first : first + many] = best % width
        for rows in chunks:
            here = node[rows]  # a view: the nodes are moved in place
            goes = np.flatnonzero(here >= first)
            goes = goes[split[here[goes] - first]]
            at = here[goes]
            here[goes] = 2 * at + 1 + (codes[:, rows][feature[at], goes] > cut[at])
    return feature, cut, value, node


def coded(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin numbers of a column; a value on a cut lies below it."""
    return np.searchsorted(edges, x, side="left").astype(np.uint8)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, s: Boost) -> dict:
    """A boosted model as plain lists: base score, cuts, and per tree the feature, cut and value of its nodes."""
    edges = bin_edges(x)
    return fit_codes(np.stack([coded(c, e) for e, c in zip(edges, x.T, strict=True)]), edges, y, weight, s)


def fit_codes(codes: np.ndarray, edges: Sequence[np.ndarray], y: np.ndarray, weight: np.ndarray, s: Boost) -> dict:
    """`fit` of bin numbers (features, rows) with the cuts between them."""
    width = max(len(e) for e in edges) + 1
    mean = float(np.average(y, weights=weight))
    mean = min(max(mean, 1e-6), 1 - 1e-6) if s.loss == "logistic" else mean
    base = float(np.log(mean / (1 - mean))) if s.loss == "logistic" else mean
    margin, trees = np.full(len(y), base), []

    def figures(rows: slice) -> tuple[np.ndarray, np.ndarray]:
        if s.loss == "logistic":
            prob = 1 / (1 + np.exp(-margin[rows]))
            return y[rows] - prob, prob * (1 - prob)
        return y[rows] - margin[rows], np.ones(len(margin[rows]))

    for _ in range(s.rounds):
        feature, cut, value, node = grow(codes, width, figures, weight, s)
        margin += s.step * value[node]
        trees.append((feature.tolist(), [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(feature, cut)], (s.step * value).tolist()))
    return {"base": base, "loss": s.loss, "depth": s.depth, "trees": trees}


def tree_values(columns: Sequence[np.ndarray], tree: tuple, at: int = 0) -> np.ndarray | float:
    """Value of every row in a shallow tree: whole columns are compared with the cut of a node."""
    feature, cut, value = tree
    if feature[at] < 0:
        return value[at]
    right = columns[feature[at]] > cut[at]
    return np.where(right, tree_values(columns, tree, 2 * at + 2), tree_values(columns, tree, 2 * at + 1))


def staged(model: dict, x: np.ndarray, stages: Sequence[int]) -> np.ndarray:
    """Scores after the given numbers of rounds (rows, stages); logistic models give the probability of 1."""
    margin, out = np.full(len(x), model["base"]), {}
    columns = np.ascontiguousarray(x.T)
    for r, tree in enumerate(model["trees"], 1):
        margin = margin + tree_values(columns, tree)
        if r in stages:
            out[r] = margin
    found = np.stack([out[r] for r in stages], axis=1)
    return 1 / (1 + np.exp(-found)) if model["loss"] == "logistic" else found


def packed_sets(rows: DataFrame, group: str, columns: Sequence[str], label: str, weight: str | None) -> DataFrame:
    """Training sets as pieces of CHUNK_ROWS rows: bin numbers by feature, labels and weights, with the cuts of the whole set.

    `rows` lie together by group within their partitions, in the order that models take them.
    """
    names = ["rows", "edges", "codes", "y", "w"]
    kinds = [pa.int64(), pa.list_(pa.list_(pa.float64())), pa.binary(), pa.binary(), pa.binary()]

    def close(name: pa.Scalar, held: dict) -> Iterator[pa.RecordBatch]:
        y, w = (np.concatenate(held.pop(c)) for c in ("_y", "_w"))
        edges, codes = [], np.zeros((len(columns), len(y)), np.uint8)
        for f, c in enumerate(columns):  # column by column, so the numbers of one are held twice
            x = np.concatenate(held.pop(c))
            edges += bin_edges(x[:, None])
            codes[f] = coded(x, edges[f])
        for start in range(0, len(y), CHUNK_ROWS):
            at = slice(start, start + CHUNK_ROWS)
            cells = [len(y[at]), [e.tolist() for e in edges], codes[:, at].tobytes(), y[at].tobytes(), w[at].tobytes()]
            yield pa.record_batch([pa.array([name.as_py()], name.type), *[pa.array([v], k) for v, k in zip(cells, kinds, strict=True)]], names=[group, *names])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, {}
        for batch in batches:
            runs = batch[group].to_pylist()
            starts = [0, *[i for i in range(1, len(runs)) if runs[i] != runs[i - 1]]] if runs else []
            for start, end in zip(starts, [*starts[1:], len(runs)]):
                if held and runs[start] != name.as_py():
                    yield from close(name, held)
                    held = {}
                name, part = batch[group][start], batch.slice(start, end - start)
                found = {c: part[c].to_numpy(zero_copy_only=False).astype(float) for c in (label, *columns, *([weight] if weight else []))}
                found |= {"_y": found[label], "_w": found[weight] if weight else np.ones(len(part))}
                for c in ("_y", "_w", *columns):
                    held.setdefault(c, []).append(found[c])
        if held:
            yield from close(name, held)

    kind = rows.schema[group].dataType.simpleString()
    return rows.mapInArrow(pack, f"`{group}` {kind}, rows long, edges array<array<double>>, codes binary, y binary, w binary")


def fit_models(rows: DataFrame, settings: Sequence[Boost], group: str, key: str, columns: Sequence[str], label: str, weight: str | None = None, fit_rows: int | None = None) -> DataFrame:
    """(group, setting, model, rows) for every group of training rows and every setting.

    `rows` has one row per group that trains on it (a row of four folds comes four
    times). Models are fitted on all rows of their group; a caller that gives `fit_rows`
    has those of the smallest md5 of `key` only. Rows with a null in a feature or the
    label train nothing. Every group is packed once, by one task; a task then reads the
    pieces of a group and fits one setting, so rows are not shuffled per setting.
    """
    use = [group, key, label, *columns, *([weight] if weight else [])]
    sample = rows.select(*use).dropna(subset=[label, *columns])
    if fit_rows is not None:
        ranked = hashed_rank(sample, [group], key, "_rank")
        sample = cut_lineage(ranked.where(F.col("_rank") <= fit_rows).drop("_rank", "group_size"))
    groups = sample.select(group).distinct().count()
    if groups * len(settings) > MODELS:
        raise ValueError(f"more than {MODELS} models")
    together = sample.repartition(max(1, 4 * groups), group).sortWithinPartitions(group, F.col(key).asc_nulls_last())
    packed = cut_lineage(packed_sets(together, group, columns, label, weight))
    numbers = rows.sparkSession.range(0, len(settings), 1, len(settings)).select(F.col("id").cast("int").alias("setting"))
    tasks = packed.hint("shuffle_replicate_nl").crossJoin(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces, schema = None, [], None

        def model() -> pa.RecordBatch:
            y, w = (np.concatenate([np.frombuffer(piece[c]) for piece in pieces]) for c in ("y", "w"))
            codes = np.concatenate([np.frombuffer(piece["codes"], np.uint8).reshape(len(columns), -1) for piece in pieces], axis=1)
            edges = [np.array(e, float) for e in pieces[0]["edges"]]
            pieces.clear()
            found = json.dumps(fit_codes(codes, edges, y, w, settings[at[1]]))
            cells = [pa.array([at[0]], schema.field(group).type), pa.array([at[1]], pa.int32()), pa.array([found]), pa.array([len(y)], pa.int64())]
            return pa.record_batch(cells, names=[group, "setting", "model", "rows"])

        for batch in batches:
            schema = batch.schema
            for i in range(batch.num_rows):
                name, setting = batch[group][i].as_py(), batch["setting"][i].as_py()
                if pieces and (name, setting) != at:
                    yield model()
                at = name, setting
                pieces.append({c: batch[c][i].as_py() for c in ("codes", "y", "w", "edges")})
        if pieces:
            yield model()

    kind = rows.schema[group].dataType.simpleString()
    return cut_lineage(tasks.mapInArrow(run, f"`{group}` {kind}, setting int, model string, rows long"))


def sent_models(models: DataFrame, group: str):
    """The models of every group, (setting, model) each, where every task can read them; at most MODELS rows."""
    held = {}
    for r in models.collect():
        held.setdefault(r[group], []).append((r["setting"], json.loads(r["model"])))
    return models.sparkSession.sparkContext.broadcast(held)


def score_rows(rows: DataFrame, models: DataFrame, group: str, columns: Sequence[str], stages: dict[int, Sequence[int]], keep: Sequence[str]) -> DataFrame:
    """(keep, setting, rounds, score) of all rows by the models of their group; rows with a null feature are left out.

    Models are at most MODELS rows; a task reads them once for each batch of rows.
    """
    shared = sent_models(models, group)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby(group):
                x = part[list(columns)].to_numpy(float)
                for setting, model in shared.value.get(name, ()):
                    score = staged(model, x, stages[setting])
                    for i, r in enumerate(stages[setting]):
                        yield part[list(keep)].assign(setting=np.int32(setting), rounds=np.int32(r), score=score[:, i])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep]
    wanted = rows.select(*dict.fromkeys([group, *keep, *columns])).dropna(subset=list(columns))
    return wanted.mapInPandas(run, ", ".join([*kinds, "setting int", "rounds int", "score double"]))


def count_calls(rows: DataFrame, models: DataFrame, group: str, columns: Sequence[str], stages: dict[int, Sequence[int]], label: str) -> DataFrame:
    """(group, setting, rounds, n00, n01, n10, n11) of all rows, label then call at 0.5, by the models of their group.

    Every row is scored by every model; a task hands on counts of its batches instead of a
    row per row, setting and stage.
    """
    shared = sent_models(models, group)
    names = [f"n{a}{b}" for a in (0, 1) for b in (0, 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby(group):
                x, y = part[list(columns)].to_numpy(float), part[label].to_numpy(float)
                found = []
                for setting, model in shared.value.get(name, ()):
                    call = staged(model, x, stages[setting]) >= 0.5
                    cells = [((y == a)[:, None] & (call == b)).sum(axis=0) for a in (0, 1) for b in (0, 1)]
                    found += [(name, setting, r, *(int(c[i]) for c in cells)) for i, r in enumerate(stages[setting])]
                if found:
                    yield pd.DataFrame(found, columns=[group, "setting", "rounds", *names])

    kind = rows.schema[group].dataType.simpleString()
    wanted = rows.select(*dict.fromkeys([group, label, *columns])).dropna(subset=list(columns))
    counted = wanted.mapInPandas(run, f"{group} {kind}, setting int, rounds int, " + ", ".join(f"{n} long" for n in names))
    return counted.groupBy(group, "setting", "rounds").agg(*[F.sum(n).alias(n) for n in names])


def staged_search(folded: DataFrame, space: dict[str, Sequence], key: str, columns: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """Mean and deviation over the folds of the macro F1 at 0.5 for every setting of the grid, ranked.

    Settings that differ in the number of rounds alone share a fit of the most rounds.
    """
    from tapewire.operators.learn import grid

    every = grid(space)
    stages = sorted(space["maxIter"])

    def boost(p: dict) -> Boost:
        return Boost(max(stages), p["stepSize"], p["maxDepth"], p["minInstancesPerNode"], "logistic")

    settings = list(dict.fromkeys(boost(p) for p in every))
    folds = cut_lineage(folded.select("fold").distinct())
    out = folds.withColumnRenamed("fold", "left_out")
    train = folded.join(F.broadcast(out), F.col("fold") != F.col("left_out"))
    models = fit_models(train, settings, "left_out", key, columns, label, weight)
    counted = count_calls(folded.withColumn("left_out", F.col("fold")), models, "left_out", columns, {s: stages for s in range(len(settings))}, label)

    def f1(hit: str, *miss: str):
        whole = 2 * F.col(hit) + sum((F.col(m) for m in miss[1:]), F.col(miss[0]))
        return F.coalesce(2 * F.col(hit) / F.nullif(whole, F.lit(0)), F.lit(0.0))

    macro = (f1("n00", "n01", "n10") + f1("n11", "n01", "n10")) / 2
    judged = counted.select("setting", "rounds", macro.alias("f")).groupBy("setting", "rounds").agg(
        F.avg("f").alias("mean_test"), F.stddev_pop("f").alias("std_test")
    )
    place = [(at, str(p), settings.index(boost(p)), p["maxIter"]) for at, p in enumerate(every)]
    names = folded.sparkSession.createDataFrame(place, "at int, parameters string, setting int, rounds int")
    table = names.join(judged, ["setting", "rounds"]).select(F.col("at").alias("setting"), "parameters", "mean_test", "std_test")
    return table.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("mean_test", 9)), "setting")))
