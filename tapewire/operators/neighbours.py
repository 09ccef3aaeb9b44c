"""Exact neighbours of dense vectors: pivot regions, bounds of the triangle inequality, blocks.

Every vector lies in the region of its nearest pivot, and regions are cut into blocks of
about 2,048 rows, each one written row. Two blocks can hold neighbours within b only if
their centres are at most both radii and b apart; all such pairs come from a cartesian
product of the written blocks, so no vector is shuffled per pair. A task hands on figures
per row of a block and partition of blocks, never pairs of rows.

Vectors are arrays of finite doubles of one length. Distances are Euclidean and exact
up to the rounding of a matrix product; bounds are widened by more than that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tapewire.operators.cluster import knee
from tapewire.operators.graph import grouped_components
from tapewire.operators.ordering import sequential_id
from tapewire.session import cut_lineage

ROWS_PER_PIVOT = 1024
MOST_PIVOTS = 4096  # rows of the table of pivots, which every task and the driver hold
BLOCK_ROWS = 2048
BLOCKS_TOGETHER = 16
PARTITIONS = 8  # of blocks, at least; the tasks of a comparison are its square
MATRIX_CELLS = 1 << 22
MATRIX_ROWS = 512
SLACK = 1e-6


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Different vectors (id, v, w: how many rows have it) and the members (key, id); id is the smallest key.

    Rows whose vector is null or holds a null or non-finite number are left out.
    """
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(key).alias("key"), v.alias("v")).where("v IS NOT NULL").where(fine)
    points = cut_lineage(rows.groupBy("v").agg(F.min("key").alias("id"), F.count("*").alias("w")).select("id", "v", "w"))
    return points, rows.join(points.select("id", "v"), "v").select("key", "id")


@dataclass
class Regions:
    """Vectors with their region and the distance to its pivot; pivots and radii of the regions."""

    homes: DataFrame
    pivots: np.ndarray
    radii: np.ndarray
    slack: float


def divide(points: DataFrame, seed: int = 7) -> Regions:
    """Regions of points (id, v and any more columns). Pivots are rows with the smallest hashes of their id."""
    n = points.count()
    wanted = max(1, min(MOST_PIVOTS, math.ceil(n / ROWS_PER_PIVOT)))
    rows = points.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(wanted).select("v").collect()
    pivots = np.array([r["v"] for r in rows], np.float64) if rows else np.zeros((0, 1))
    schema = StructType([*points.schema.fields, StructField("region", IntegerType()), StructField("apart", DoubleType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in parts_of(batch, len(pivots)):
                apart = distances(stacked(part["v"]), pivots)
                region = apart.argmin(axis=1)
                yield part.assign(region=region.astype(np.int32), apart=apart[np.arange(len(part)), region])

    homes = cut_lineage(points.mapInPandas(assign, schema))
    radii = np.zeros(max(1, len(pivots)))
    for r in homes.groupBy("region").agg(F.max("apart").alias("radius")).collect():
        radii[r["region"]] = r["radius"]
    return Regions(homes, pivots, radii, SLACK * (1.0 + float(np.abs(pivots).max(initial=0.0))) * 10)


def parts_of(batch: pd.DataFrame, width: int) -> Iterator[pd.DataFrame]:
    step = max(1, MATRIX_CELLS // max(1, width))
    for start in range(0, len(batch), step):
        yield batch.iloc[start : start + step]


@dataclass
class Block:
    """Rows of one block without their vectors, and those as a matrix."""

    key: int
    rows: pd.DataFrame
    v: np.ndarray


def dealt(rows: DataFrame) -> DataFrame:
    """Rows (id, region and any more columns) with their `block`: about BLOCK_ROWS rows of one region, by a hash of the id.

    The table of regions that is broadcast has at most MOST_PIVOTS rows.
    """
    parts = rows.groupBy("region").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("_parts"))
    block = F.shiftleft(F.col("region").cast("long"), 32) + F.pmod(F.xxhash64("id"), F.col("_parts"))
    return rows.join(F.broadcast(parts), "region").withColumn("block", block).drop("_parts")


def blocks_of(rows: DataFrame, reach: str | None = None, centred: bool = True) -> DataFrame:
    """(block, centre, radius, reach, body): one row per block of `rows`, which are its Arrow table `body`.

    `reach` names the column whose largest value is the block's. A partition holds about
    BLOCKS_TOGETHER blocks, fewer where there are few blocks.
    """

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop_columns(["region", "block"])
        with pa.BufferOutputStream() as sink:
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            body = sink.getvalue().to_pybytes()
        centre, radius = np.zeros(0), 0.0
        if centred:
            v = stacked(table["v"].to_pandas())
            centre = v.mean(axis=0)
            radius = float(np.sqrt(((v - centre) ** 2).sum(axis=1)).max())
        farthest = 0.0 if reach is None else float(table[reach].to_pandas().max())
        return pa.table([[key[0].as_py()], [centre.tolist()], [radius], [farthest], [body]], schema=fields)

    fields = pa.schema([("block", pa.int64()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64()), ("reach", pa.float64()), ("body", pa.binary())])
    schema = "block long, centre array<double>, radius double, reach double, body binary"
    packed = cut_lineage(dealt(rows).groupBy("block").applyInArrow(pack, schema))
    n = packed.count()
    return cut_lineage(packed.repartition(max(1, min(n, max(PARTITIONS, math.ceil(n / BLOCKS_TOGETHER))))))


def opened(key: int, body: bytes) -> Block:
    rows = pa.ipc.open_stream(pa.py_buffer(body)).read_all().to_pandas()
    return Block(key, rows.drop(columns="v"), stacked(rows["v"]))


def apart_within(reach: Column, slack: float) -> Column:
    """Blocks a and b of which rows may lie within `reach` of each other."""
    square = F.aggregate(F.zip_with("a_centre", "b_centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)
    return F.sqrt(square) <= F.col("a_radius") + F.col("b_radius") + reach + slack


def compare(left: DataFrame, right: DataFrame, meets: Column | None, fn: Callable[[Block, Iterator[Block]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """`fn` of every block of `left` and the blocks of a partition of `right` that it meets.

    The pairs of blocks are formed by a cartesian product, which reads the written
    blocks again and shuffles nothing; a task holds one block of `left`, one partition
    of `right` and what `fn` keeps.
    """
    a = left.select([F.col(c).alias(f"a_{c}") for c in left.columns]).hint("shuffle_replicate_nl")
    b = right.select([F.col(c).alias(f"b_{c}") for c in right.columns])
    pairs = (a.crossJoin(b) if meets is None else a.join(b, meets)).select("a_block", "a_body", "b_block", "b_body")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, Block] = {}

        def block(key: int, body: bytes) -> Block:
            if key not in held:
                if len(held) >= 2 * BLOCKS_TOGETHER:
                    held.clear()
                held[key] = opened(key, body)
            return held[key]

        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for _, group in groupby(rows, key=lambda row: row[0]):
            first = next(group)
            yield from fn(opened(first[0], first[1]), (block(row[2], row[3]) for row in chain([first], group)))

    return pairs.mapInPandas(run, schema)


def nearest_distances(points: DataFrame, k: int, regions: Regions | None = None) -> DataFrame:
    """id and the distances of the k nearest rows, itself among them, in ascending order.

    A vector that w rows share counts w times. The own block gives a first bound for
    every row; only blocks that the largest bound of a block reaches are searched after it.
    """
    regions = regions or divide(points)

    def within(own: pd.DataFrame) -> pd.DataFrame:
        v, ids = stacked(own["v"]), own["id"].to_numpy()
        times = np.minimum(own["w"].to_numpy(), k)
        take, out = min(k, len(own)), []
        for start in range(0, len(own), MATRIX_ROWS):
            apart = distances(v[start : start + MATRIX_ROWS], v)
            apart[ids[start : start + MATRIX_ROWS, None] == ids] = 0.0
            near = np.argpartition(apart, take - 1, axis=1)[:, :take]
            near_apart = np.take_along_axis(apart, near, axis=1)
            out += [np.sort(np.repeat(d, times[at]))[:k].tolist() for d, at in zip(near_apart, near, strict=True)]
        return pd.DataFrame({"id": ids, "found": out})

    def search(a: Block, others: Iterator[Block]) -> Iterator[pd.DataFrame]:
        mine, bound = np.full((len(a.v), k), np.inf), a.rows["bound"].to_numpy()
        for b in others:
            times = np.minimum(b.rows["w"].to_numpy(), k)
            for start in range(0, len(a.v), MATRIX_ROWS):
                rows = slice(start, start + MATRIX_ROWS)
                limit = np.minimum(bound[rows], mine[rows, -1])
                apart = distances(a.v[rows], b.v)
                row, column = np.nonzero(apart < limit[:, None])
                if len(row):
                    d, of = np.repeat(apart[row, column], times[column]), np.repeat(row, times[column])
                    order = np.lexsort((d, of))
                    d, of = d[order], of[order]
                    place = np.arange(len(of)) - np.searchsorted(of, of)
                    use = place < k
                    fresh = np.full((len(limit), k), np.inf)
                    fresh[of[use], place[use]] = d[use]
                    changed = np.unique(row)
                    mine[start + changed] = np.sort(np.concatenate([mine[start + changed], fresh[changed]], axis=1), axis=1)[:, :k]
        found = np.flatnonzero(mine[:, 0] < np.inf)
        yield pd.DataFrame({"id": a.rows["id"].to_numpy()[found], "found": pd.Series([x[x < np.inf] for x in mine[found]], dtype=object)})

    def merged(found: DataFrame) -> DataFrame:
        return found.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))

    schema = "id long, found array<double>"
    homes = regions.homes.select("id", "v", "w", "region")
    first = cut_lineage(merged(dealt(homes).groupBy("block").applyInPandas(within, schema)))
    kth = F.when(F.size("found") >= k, F.element_at("found", k)).otherwise(F.lit(float("inf")))
    blocks = blocks_of(homes.join(first, "id", "left").select(*homes.columns, kth.alias("bound")), reach="bound")
    abroad = (F.col("a_block") != F.col("b_block")) & apart_within(F.col("a_reach"), regions.slack)
    rest = compare(blocks, blocks, abroad, search, schema)
    return merged(first.unionByName(rest)).withColumnRenamed("found", "distances")


def spanning_edges(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forest (row, column, weight) of a two-sided graph; infinite weights are no edges."""
    n, m = weights.shape
    best, source = np.full(n + m, np.inf), np.full(n + m, -1)
    left = np.ones(n + m, bool)
    edges = []
    for _ in range(n + m):
        at = int(np.where(left, best, np.inf).argmin())
        if not left[at] or best[at] == np.inf:
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            at = int(rest[0])
        elif source[at] >= 0:
            edges.append((at, int(source[at]), best[at]))
        left[at] = False
        if at < n:
            others, line = slice(n, n + m), weights[at]
        else:
            others, line = slice(0, n), weights[:, at - n]
        closer = (line < best[others]) & left[others]
        best[others] = np.where(closer, line, best[others])
        source[others] = np.where(closer, at, source[others])
    if not edges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    x, y, d = (np.array(c) for c in zip(*edges, strict=True))
    return np.minimum(x, y), np.maximum(x, y) - n, d


@dataclass(frozen=True)
class Setting:
    eps: float
    min_samples: int


def density_labels(points: DataFrame, settings: Sequence[Setting], cores: DataFrame | None = None) -> DataFrame:
    """(setting, id, cluster) of every clustered vector under each setting; noise has no row.

    A row is a core if min_samples rows, itself among them, lie within eps. Cores within
    eps of each other are one cluster, named by its smallest core id; another row joins
    the cluster of its nearest core within eps, ties to the smaller id.

    All settings share one radius join at the largest eps. A pair of cores is linked at
    eps if their distance and both distances to the min_samples-th neighbour are within
    it, so the minimum spanning forest of the largest of the three holds the components
    of every eps; a pair of blocks hands on its own forest, one edge per row at most.
    """
    counts = sorted({s.min_samples for s in settings})
    widest = max(s.eps for s in settings)
    regions = divide(points)
    cores = cores if cores is not None else nearest_distances(points, max(counts), regions)
    of_core = [F.when(F.size("distances") >= k, F.element_at("distances", k)).otherwise(F.lit(float("inf"))) for k in counts]
    homes = cut_lineage(regions.homes.select("id", "v", "region").join(cores, "id").withColumn("core", F.array(*of_core)).drop("distances"))
    blocks = blocks_of(homes)

    def links(a: Block, others: Iterator[Block]) -> Iterator[pd.DataFrame]:
        for b in others:
            yield from link(a, b)

    def link(a: Block, b: Block) -> Iterator[pd.DataFrame]:
        ids_a, ids_b = a.rows["id"].to_numpy(), b.rows["id"].to_numpy()
        core_a, core_b = stacked(a.rows["core"]), stacked(b.rows["core"])
        apart = distances(a.v, b.v)
        if a.key == b.key:
            apart[ids_a[:, None] == ids_b] = 0.0
        close = apart <= widest
        row, column = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
        if not len(row):
            return
        if len(row) < len(ids_a) or len(column) < len(ids_b):
            apart = apart[np.ix_(row, column)]
            ids_a, core_a, ids_b, core_b = ids_a[row], core_a[row], ids_b[column], core_b[column]
        order = np.argsort(ids_b)
        for c in range(len(counts) if a.key <= b.key else 0):  # a pair of blocks comes in both orders
            x, y = np.flatnonzero(core_a[:, c] <= widest), np.flatnonzero(core_b[:, c] <= widest)
            weight = np.maximum(np.maximum(apart[np.ix_(x, y)], core_a[x, c, None]), core_b[None, y, c])
            i, j, d = spanning_edges(np.where(weight <= widest, weight, np.inf))
            i, j = ids_a[x[i]], ids_b[y[j]]
            use = i != j
            yield pd.DataFrame({"core": True, "at": c, "a": i[use], "b": j[use], "d": d[use]})
        for s, setting in enumerate(settings):
            c = counts.index(setting.min_samples)
            edge, inner = np.flatnonzero(core_a[:, c] > setting.eps), order[core_b[order, c] <= setting.eps]
            if len(edge) and len(inner):
                seen = apart[np.ix_(edge, inner)]
                first = seen.argmin(axis=1)  # columns are in order of the id
                d = seen[np.arange(len(edge)), first]
                use = d <= setting.eps
                yield pd.DataFrame({"core": False, "at": s, "a": ids_a[edge[use]], "b": ids_b[inner[first[use]]], "d": d[use]})

    near = apart_within(F.lit(widest), regions.slack)
    met = cut_lineage(compare(blocks, blocks, near, links, "core boolean, at int, a long, b long, d double"))
    table = points.sparkSession.createDataFrame(
        [(s, counts.index(x.min_samples), float(x.eps)) for s, x in enumerate(settings)], "setting int, at int, eps double"
    )
    edges = met.where("core").join(F.broadcast(table), "at").where("d <= eps").select("setting", "a", "b")
    joined = grouped_components(edges, "setting")
    inner = homes.select("id", F.posexplode("core").alias("at", "c")).join(F.broadcast(table), "at").where("c <= eps").select("setting", "id")
    named = inner.join(joined, ["setting", "id"], "left").select("setting", "id", F.coalesce("component", "id").alias("cluster"))
    named = cut_lineage(named)
    nearest = met.where("NOT core").groupBy(F.col("at").alias("setting"), F.col("a").alias("id")).agg(F.min(F.struct("d", "b"))["b"].alias("b"))
    borders = nearest.join(named.select("setting", F.col("id").alias("b"), "cluster"), ["setting", "b"]).select("setting", "id", "cluster")
    return named.unionByName(borders)


def exact_silhouettes(points: DataFrame, labels: DataFrame) -> DataFrame:
    """(setting, id, silhouette) by Euclidean distances; labels are (setting, id, cluster), noise has no row.

    `points` are (id, v, w). A task adds up the distances of the rows of a block to every
    cluster over a partition of blocks before anything is shuffled. A cluster of one row
    has silhouette 0.
    """
    packed = labels.groupBy("id").agg(F.collect_list(F.struct("setting", "cluster")).alias("l"))
    parts = [F.col(f"l.{c}").alias(f"{c}s") for c in ("setting", "cluster")]
    rows = cut_lineage(points.join(packed, "id").select("id", "v", "w", *parts, F.lit(0).alias("region")))

    def flat(frame: pd.DataFrame) -> pd.DataFrame:
        row = np.repeat(np.arange(len(frame)), frame["settings"].str.len())
        return pd.DataFrame({"row": row, "setting": np.concatenate(frame["settings"].to_list()), "cluster": np.concatenate(frame["clusters"].to_list())})

    def add_up(a: Block, others: Iterator[Block]) -> Iterator[pd.DataFrame]:
        ids, mine = a.rows["id"].to_numpy(), flat(a.rows)
        own = {setting: rows["row"].to_numpy() for setting, rows in mine.groupby("setting")}
        totals: dict[int, dict[int, np.ndarray]] = {setting: {} for setting in own}
        for b in others:
            apart = distances(a.v, b.v)
            if a.key == b.key:
                apart[ids[:, None] == ids] = 0.0
            apart *= b.rows["w"].to_numpy()
            for setting, held in flat(b.rows).dropna(subset="cluster").groupby("setting"):
                if setting in own:
                    names, column = np.unique(held["cluster"].to_numpy(), return_inverse=True)
                    one_hot = np.zeros((len(b.v), len(names)))
                    one_hot[held["row"].to_numpy(), column] = 1.0
                    sums = (apart @ one_hot)[own[setting]]
                    for name, total in zip(names, sums.T, strict=True):
                        totals[setting][name] = totals[setting].get(name, 0.0) + total
        for setting, of in totals.items():
            if of:
                yield pd.DataFrame({
                    "setting": np.int32(setting), "id": np.tile(ids[own[setting]], len(of)),
                    "other": np.repeat(list(of), len(own[setting])), "total": np.concatenate(list(of.values())),
                })

    blocks = blocks_of(rows, centred=False)
    sums = compare(blocks, blocks, None, add_up, "setting int, id long, other long, total double")
    sums = sums.groupBy("setting", "id", "other").agg(F.sum("total").alias("total"))
    weights = labels.join(points.select("id", "w"), "id")
    sizes = weights.groupBy("setting", "cluster").agg(F.sum("w").alias("n"))
    sized = sums.join(sizes.withColumnRenamed("cluster", "other"), ["setting", "other"]).join(labels, ["setting", "id"])
    own = F.col("other") == F.col("cluster")
    figures = sized.groupBy("setting", "id").agg(
        F.max(F.when(own, F.col("total") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    value = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    return figures.select("setting", "id", F.coalesce(value, F.lit(0.0)).alias("silhouette"))


# The settings that the method tries around the knee of the k-distance curve.
EPS_STEPS = (0.7, 0.85, 1.0, 1.15, 1.3)
MIN_SAMPLES = tuple(range(3, 11))
CLUSTERS = (2, 60)
MOST_NOISE = 0.5


def k_distances(points: DataFrame, members: DataFrame, k: int = max(MIN_SAMPLES)) -> DataFrame:
    """(key, distance) to the k-th nearest row, itself counted; null with fewer rows than that."""
    found = nearest_distances(points, k)
    return members.join(found, "id").select("key", F.get("distances", F.lit(k - 1)).alias("distance"))


def curve(k_distance: DataFrame) -> DataFrame:
    """(key, distance, position): positions from 1 in ascending distance, ties by key; rows without a distance are left out."""
    ordered = k_distance.where("distance IS NOT NULL").withColumn("distance", F.round("distance", 6))
    return sequential_id(ordered, ["distance", "key"], "position")


def knee_of(points: DataFrame) -> float:
    """Distance at the knee of a curve; 0 for an empty one."""
    points = cut_lineage(points)
    if points.isEmpty():
        return 0.0
    at = knee(points, "position", "distance").first()["position"]
    return float(points.where(F.col("position") == at).first()["distance"])


def density_clusters(rows: DataFrame, key: str, vector: str, eps: float | None = None) -> tuple[DataFrame, Setting]:
    """(key, cluster) for the best setting around `eps`, and that setting; `key` is unique.

    Without `eps` it is the knee of the k-distance curve. Kept are settings with 2 to 60 clusters and at most half of the rows noise; the best
    has the highest mean silhouette of the rows that are no noise, ties to the smaller
    eps and min_samples. If none is kept it is `eps` with the fewest samples. Clusters
    are numbered from 0 by their smallest core, noise is -1. Every row whose vector is
    missing or not finite is noise.
    """
    points, members = distinct_vectors(rows, key, vector)
    cores = cut_lineage(nearest_distances(points, max(MIN_SAMPLES)))
    if eps is None:
        eps = knee_of(curve(members.join(cores, "id").select("key", F.get("distances", F.lit(max(MIN_SAMPLES) - 1)).alias("distance"))))
    settings = [Setting(eps * step, k) for step in EPS_STEPS for k in MIN_SAMPLES]
    labels = cut_lineage(density_labels(points, settings, cores))
    n = rows.count()
    weighed = labels.join(points.select("id", "w"), "id")
    found = weighed.groupBy("setting").agg(F.countDistinct("cluster").alias("n"), F.sum("w").alias("held"))
    kept = found.where(F.col("n").between(*CLUSTERS)).where(F.col("held") >= F.lit(n * (1 - MOST_NOISE))).select("setting")
    kept = cut_lineage(kept)
    scores = exact_silhouettes(points, labels.join(F.broadcast(kept), "setting")).join(points.select("id", "w"), "id")
    mean = F.round(F.sum(F.col("silhouette") * F.col("w")) / F.sum("w"), 9)
    ranked = scores.groupBy("setting").agg(mean.alias("score")).orderBy(F.desc("score"), "setting").first()
    best = settings.index(Setting(eps, min(MIN_SAMPLES))) if ranked is None else ranked["setting"]
    own = labels.where(F.col("setting") == best).select("id", "cluster")
    return numbered(rows, key, members.join(own, "id").select(F.col("key").alias(key), "cluster")), settings[best]


def numbered(rows: DataFrame, key: str, labels: DataFrame) -> DataFrame:
    """All rows with their cluster numbered from 0 in the order of the names, or -1."""
    names = sequential_id(labels.select("cluster").distinct(), ["cluster"], "number")
    return rows.select(key).join(labels.join(names, "cluster"), key, "left").select(key, F.coalesce(F.col("number") - 1, F.lit(-1)).cast("int").alias("cluster"))
