"""Clusterings, and figures over a clustering.

No step forms pairs of points. The silhouette uses squared distances, for which
the mean distance of a point to a cluster follows from the cluster's sums.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.operators import shared_clusters as sc
from tapewire.session import side_by_side

KS = range(2, 16)  # fixed value: numbers of clusters that the method tries


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def silhouette(points: DataFrame, key: str) -> DataFrame:
    """Silhouette per point of (key, cluster, v) under squared Euclidean distance.

    Mean distance from x to cluster C is |x|^2 - 2 x.mean(C) + mean(|c|^2); within
    its own cluster a point is left out by the factor n / (n - 1). The table of
    clusters has k rows, one array of means each, and is read as one array.
    """
    squared = points.withColumn("q", dot(F.col("v"), F.col("v")))
    cells = squared.select("cluster", F.posexplode("v").alias("i", "x"))
    means = cells.groupBy("cluster", "i").agg(F.avg("x").alias("m"))
    packed = means.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))
    sizes = squared.groupBy("cluster").agg(F.count("*").alias("n"), F.avg("q").alias("mq"))
    table = packed.join(sizes, "cluster").agg(F.collect_list(F.struct("cluster", "mean", "n", "mq")).alias("table"), F.lit(1).alias("_k"))
    spread = squared.withColumn("_k", F.lit(1)).join(F.broadcast(table), "_k")
    distances = F.transform(
        "table",
        lambda c: F.struct(
            c["cluster"].alias("cluster"),
            c["n"].alias("n"),
            (F.col("q") - 2 * dot(F.col("v"), c["mean"]) + c["mq"]).alias("d"),
        ),
    )
    own = F.get(F.filter(distances, lambda c: c["cluster"] == F.col("cluster")), F.lit(0))
    others = F.array_min(F.transform(F.filter(distances, lambda c: c["cluster"] != F.col("cluster")), lambda c: c["d"]))
    near = own["d"] * own["n"] / F.nullif(own["n"] - 1, F.lit(0))
    scored = spread.select(key, "cluster", near.alias("a"), others.alias("b"))
    value = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    return scored.select(key, F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def sizes(labels: DataFrame) -> DataFrame:
    counts = labels.groupBy("cluster").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def knee(curve: DataFrame, x: str, y: str) -> DataFrame:
    """Point of a curve farthest from the chord between its ends, both axes scaled to [0, 1]."""
    edges = curve.agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("lo"), F.max(y).alias("hi"),
        F.min_by(y, x).alias("first"), F.max_by(y, x).alias("last"),
    ).first()
    width, height = float(edges["x1"] - edges["x0"]) or 1.0, float(edges["hi"] - edges["lo"]) or 1.0
    u, v = (F.col(x) - edges["x0"]) / width, (F.col(y) - edges["lo"]) / height
    v0, v1 = (edges["first"] - edges["lo"]) / height, (edges["last"] - edges["lo"]) / height
    gap = F.abs((v - v0) - (v1 - v0) * u) / (1 + (v1 - v0) ** 2) ** 0.5
    return curve.select(x, gap.alias("distance")).orderBy(F.desc(F.round("distance", 6)), x).limit(1)


def with_features(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def kmeans_sweep(points: DataFrame, ks: Sequence[int], restarts: int = 10, seed: int = 42) -> DataFrame:
    """Inertia (best of the restarts) and silhouette per k. Each fit is distributed; a few run side by side."""
    points = points.persist()
    scorer = ClusteringEvaluator(predictionCol="cluster")

    def fit(setting: tuple[int, int]):
        model = KMeans(k=setting[0], seed=seed + setting[1], predictionCol="cluster").fit(points)
        return model, float(model.summary.trainingCost)

    fits = side_by_side(fit, [(k, r) for k in ks for r in range(restarts)])
    best = [min(fits[i * restarts : (i + 1) * restarts], key=lambda f: f[1]) for i in range(len(ks))]
    scores = side_by_side(lambda f: float(scorer.evaluate(f[0].transform(points))), best)
    rows = [(k, cost, score) for k, (_, cost), score in zip(ks, best, scores)]
    points.unpersist()
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def kmeans_labels(points: DataFrame, k: int, restarts: int = 10, seed: int = 42) -> DataFrame:
    """Labels of the fit of the least inertia among the restarts."""
    return sc.kmeans(points, [k], restarts, seed, judge=False)[0][0]


def hierarchical_labels(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Divisive hierarchy in place of pairwise linkage, which needs all distances at once."""
    return sc.bisecting(points, [k], seed, judge=False)[0][0]


TOGETHER = {kmeans_labels: sc.kmeans, hierarchical_labels: sc.bisecting}  # fits of all k in the same passes


def best_labels(points: DataFrame, label: Callable[[DataFrame, int], DataFrame], ks: Sequence[int] = KS) -> tuple[DataFrame, int, float]:
    """Labels by `label(points, k)` for the k of the highest silhouette, with that k and value; ties to the smaller k."""
    if label in TOGETHER:
        return max(TOGETHER[label](points, list(ks)), key=lambda j: (j[2], -j[1]))
    points = points.persist()
    scorer = ClusteringEvaluator(predictionCol="cluster")

    def judge(k: int):
        labels = label(points, k)
        return labels, k, float(scorer.evaluate(labels))

    found = max(side_by_side(judge, list(ks)), key=lambda j: (j[2], -j[1]))
    points.unpersist()
    return found


def pca(points: DataFrame, k: int, fit_on: DataFrame | None = None):
    """Fitted PCA model and the projected points; the driver holds one d x d matrix."""
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(points if fit_on is None else fit_on)
    return model, model.transform(points).withColumn("pca", vector_to_array("pca"))


def explained(model, spark) -> DataFrame:
    """Variance share per component and its running sum."""
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    upto = Window.orderBy("component")
    return spark.createDataFrame(rows, "component int, share double").withColumn("cumulative", F.sum("share").over(upto))
