"""Near-duplicate vectors by a random-projection tree with exact comparison of its leaves.

Exactly equal vectors are one row first. A tree splits the vectors of a label by
random projections at the median until a leaf is small; leaves do not overlap. Two
leaves are compared whole, row by row, unless their centres are further apart than
their radii and the threshold allow, so no link is missed. A comparison hands on
one row per vector and no pairs. Links are then united to components.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.llm.common import open_store, shared_folder, stage
from tapewire.llm.components import connected_components

THRESHOLD = 0.98
LEAF = 2048
ROUNDING = 1e-6  # by which two leaves count as nearer than their centres and radii say
STRIP = 512  # rows of a leaf that meet the other leaf at once
STRETCH = 16  # leaves that a task compares with one
SAMPLE = 2048  # rows of a node that its splits are fitted on
LEAST_PER_LEAF = 32  # of the sample
SEED = 17


def usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that squares neither vanish nor overflow."""
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _direction(cell: int, node: int, width: int) -> np.ndarray:
    return np.random.default_rng([SEED, cell & (2**63 - 1), node]).standard_normal(width)


def _places(rows: np.ndarray, gids: np.ndarray, cell: int, node: int) -> np.ndarray:
    """Projections, with a tiny step by id that parts equal ones."""
    mixed = (gids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return rows @ _direction(cell, node, rows.shape[1]) + mixed.astype(np.float64) * 1e-18


def _fit(leaf: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        cell, size = int(rows["cell"].iloc[0]), int(rows["size"].iloc[0])
        x, gids = unit_rows(rows["vector"]), rows["gid"].to_numpy()
        depth = min(int(np.ceil(np.log2(size / leaf))), max(1, int(np.log2(len(x) / LEAST_PER_LEAF))))
        cuts = []
        level = [np.arange(len(x))]
        for d in range(depth):
            below = []
            for i, at in enumerate(level):
                place = _places(x[at], gids[at], cell, (1 << d) + i)
                cut = np.median(place) if len(at) else 0.0
                cuts.append(cut)
                below += [at[place <= cut], at[place > cut]]
            level = below
        return pd.DataFrame({"cell": [cell], "cuts": [cuts]})

    return fit


def _route(batches):
    for batch in batches:
        out = []
        plain = batch["cuts"].isna()
        if plain.any():
            out.append(batch.loc[plain, ["gid", "cell"]])
        for cell, rows in batch[~plain].groupby("cell"):
            x, gids = unit_rows(rows["vector"]), rows["gid"].to_numpy()
            cuts = np.asarray(rows["cuts"].iloc[0])
            level, first = [np.arange(len(x))], 1
            while first <= len(cuts):
                below = []
                for i, at in enumerate(level):
                    place = _places(x[at], gids[at], cell, first + i)
                    below += [at[place <= cuts[first + i - 1]], at[place > cuts[first + i - 1]]]
                level, first = below, first * 2
            for i, at in enumerate(level):
                child = (np.uint64(cell & (2**64 - 1)) + np.uint64(i + 1)) * np.uint64(0xD6E8FEB86659FD93)
                child = int((child ^ (child >> np.uint64(32))).view(np.int64))
                out.append(pd.DataFrame({"gid": gids[at], "cell": child}))
        if out:
            yield pd.concat(out)


def grow_tree(vectors: DataFrame, leaf: int = LEAF) -> DataFrame:
    """gid, cell: the leaf of every vector, none of over 2 * leaf rows.

    `vectors` needs gid, grp (only equal ones are compared), vector. A round splits
    all cells that are too large at once: splits come from at most SAMPLE rows of the
    cell, chosen by hash, and every row is sent down by them. A label with a third
    of all rows is just a cell that needs another round.
    """
    cells = stage(vectors.select("gid", F.xxhash64("grp").alias("cell")), "cells")
    vectors = vectors.select("gid", "vector")
    while True:
        sizes = cells.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > 2 * leaf)
        large = stage(sizes, "large-cells")
        if large.isEmpty():
            return cells
        first = Window.partitionBy("cell").orderBy(F.xxhash64("gid", "cell"))
        # Small keys are ranked; vectors join only what is kept.
        drawn = cells.join(large, "cell").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SAMPLE)
        rules = drawn.select("cell", "size", "gid").join(vectors, "gid").groupBy("cell")
        rules = stage(rules.applyInPandas(_fit(leaf), "cell long, cuts array<double>"), "splits")
        met = cells.join(rules, "cell", "left").join(vectors, "gid")
        cells = stage(met.mapInPandas(_route, "gid long, cell long"), "cells")


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    out = np.empty((len(x), len(y)), bool)
    for at in range(0, len(x), STRIP):
        out[at : at + STRIP] = x[at : at + STRIP] @ y.T >= threshold
    return out


def _roots(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id reachable from every row and column; each is visited once."""
    row_root, column_root = rows.copy(), columns.copy()
    new_row, new_column = linked.any(axis=1), linked.any(axis=0)
    for start in range(len(rows)):
        if not new_row[start]:
            continue
        reached, found, front = [], [], np.array([start])
        new_row[start] = False
        while len(front):
            reached.append(front)
            across = np.flatnonzero(linked[front].any(axis=0) & new_column)
            new_column[across] = False
            found.append(across)
            front = np.flatnonzero(linked[:, across].any(axis=1) & new_row)
            new_row[front] = False
        reached, found = np.concatenate(reached), np.concatenate(found)
        row_root[reached] = column_root[found] = min(rows[reached].min(), columns[found].min())
    return row_root, column_root


def _side(gids: np.ndarray, links: np.ndarray, root: np.ndarray) -> pd.DataFrame:
    some = links > 0
    return pd.DataFrame({"gid": gids[some], "links": links[some].astype("int64"), "root": root[some]})


LEAVES = "gid long, links long, root long, path string, centre array<double>, radius double"


def _within(threshold: float, folder: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links inside a leaf; a leaf of several of its group is also written, with its centre and radius."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        x, gids, n = unit_rows(rows["vector"]), rows["gid"].to_numpy(), rows["n"].to_numpy()
        linked = _linked(x, x, threshold)
        linked |= linked.T  # products of one pair may be rounded in two ways
        np.fill_diagonal(linked, False)
        out = _side(gids, linked @ n, _roots(linked, gids, gids)[0]).assign(path=None, centre=None, radius=None)
        if rows["several"].iloc[0]:
            store, path = open_store(f"{folder}/{gids.min()}-{TaskContext.get().taskAttemptId()}.npz")
            store.create_dir(path.rpartition("/")[0])
            data = io.BytesIO()
            np.savez(data, gids=gids, n=n, vectors=np.stack(rows["vector"]))
            with store.open_output_stream(path) as file:
                file.write(data.getvalue())
            centre = x.mean(axis=0)
            radius = float(np.linalg.norm(x - centre, axis=1).max())
            uri = f"{folder}/{path.rpartition('/')[2]}"
            own = pd.DataFrame({"gid": [gids.min()], "links": None, "root": None, "path": uri, "centre": [centre.tolist()], "radius": radius})
            out = pd.concat([own, out]) if len(out) else own
        return out.astype({"links": "Int64", "root": "Int64"})

    return compare


def _load(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        held = np.load(io.BytesIO(file.read()))
    return held["gids"], held["n"], unit_rows(held["vectors"])


def _across(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Links between the two leaves of each row."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for one, other in zip(batch["path"], batch["other"], strict=True):
                if held is None or held[0] != one:
                    held = (one, *_load(one))
                _, gids, n, x = held
                gids_too, n_too, y = _load(other)
                linked = _linked(x, y, threshold)
                if linked.any():
                    root, root_too = _roots(linked, gids, gids_too)
                    yield _side(gids, linked @ n_too, root)
                    yield _side(gids_too, n @ linked, root_too)

    return compare


def leaf_links(distinct: DataFrame, cells: DataFrame, threshold: float, leaf: int) -> DataFrame:
    """gid, links, root: rows that sum to the links of every vector and connect it with all that it links to.

    `distinct` needs gid, grp, vector, n. Leaves of a group that has several are
    files of at most 2 * leaf vectors; a task reads the two that it compares, so
    vectors are written once however many leaves they meet.
    """
    spark = distinct.sparkSession
    split = distinct.groupBy("grp").agg((F.count("*") > 2 * leaf).alias("several"))
    rows = cells.join(distinct, "gid").join(split, "grp")
    within = rows.groupBy("grp", "cell").applyInPandas(_within(threshold, shared_folder(spark, "leaves")), LEAVES)
    # The group of a leaf is that of any of its vectors.
    found = stage(within, "leaf-links")
    leaves = found.where("path IS NOT NULL").join(distinct.select("gid", "grp"), "gid").select("grp", "gid", "path", "centre", "radius")
    leaves = stage(leaves.withColumn("at", F.row_number().over(Window.partitionBy("grp").orderBy("gid"))), "leaves-listed")
    others = leaves.select("grp", F.col("at").alias("at_too"), F.col("path").alias("other"), F.col("centre").alias("c"), F.col("radius").alias("r"))
    apart = F.sqrt(F.aggregate(F.zip_with("centre", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, a: s + a))
    reach = F.col("radius") + F.col("r") + float(np.sqrt(max(2 - 2 * threshold, 0)) + ROUNDING)
    near = leaves.join(others, "grp").where((F.col("at") < F.col("at_too")) & (apart <= reach))
    pairs = stage(near.select("path", "other", F.floor(F.col("at_too") / STRETCH).alias("stretch")), "leaf-pairs")
    # Pairs are small rows and long work, so the number of tasks is given.
    tasks = max(4 * spark.sparkContext.defaultParallelism, pairs.count() // STRETCH)
    dealt = pairs.repartition(tasks, "path", "stretch").sortWithinPartitions("path").select("path", "other")
    across = stage(dealt.mapInPandas(_across(threshold), "gid long, links long, root long"), "cross-links")
    return found.where("path IS NULL").select("gid", "links", "root").union(across)


def link_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """Rows of vec_id, n_links, component_id and kept, one per row of `embeddings`.

    Vectors with equal, not null labels and equal lengths link when their cosine in
    double precision reaches `threshold`. Null or zero vectors, those with null or
    non-finite components, and rows with a null id or label link with nothing.
    n_links counts linked rows other than itself, equal vectors included; no link is
    left out. Vectors of one label without any structure are all compared. Repeated
    rows are rows of their own. An empty table gives no rows. Only vec_id, embedding
    and label are read.
    """
    rows = stage(
        embeddings.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("embedding").alias("vector"),
            F.when(
                usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(),
                F.concat_ws(":", F.col("label").cast("string"), F.size("embedding")),
            ).alias("grp"),
        ),
        "vectors",
    )
    valid = rows.where("grp IS NOT NULL")
    distinct = stage(valid.groupBy("grp", "vector").agg(F.min("uid").alias("gid"), F.count("*").alias("n")), "distinct-vectors")
    cells = grow_tree(distinct.select("gid", "grp", "vector"), leaf)
    found = leaf_links(distinct, cells, threshold, leaf)
    united = connected_components(found.select(F.col("gid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    groups = (
        distinct.select("gid", "n")
        .join(links, "gid", "left")
        .join(united.withColumnRenamed("id", "gid"), "gid", "left")
        .select("gid", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "gid").alias("part"))
    )
    # Copies find their group by the vector; single ones are their own group.
    copies = stage(distinct.where("n > 1").select("grp", "vector", F.col("gid").alias("of")), "copied-vectors")
    members = rows.join(copies, ["grp", "vector"], "left").select(
        "uid", "vec_id", F.when(F.col("grp").isNotNull(), F.coalesce("of", "uid")).alias("gid")
    )
    placed = stage(members.join(groups, "gid", "left").select("vec_id", "n_links", "part"), "placed-vectors")
    smallest = stage(placed.where("part IS NOT NULL").groupBy("part").agg(F.min("vec_id").alias("smallest")), "smallest")
    done = placed.join(smallest, "part", "left")
    component = F.coalesce("smallest", "vec_id")
    return done.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
