"""Queries over labelled tables: profiles, splits, vectors, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewire.functions.numeric import rounded
from tapewire.operators import cluster as cl
from tapewire.operators import evaluate as ev
from tapewire.operators import neighbours as nb
from tapewire.operators import quality as ql
from tapewire.operators import vectors as vc
from tapewire.plans.registry import query
from tapewire.session import cut_lineage
from tapewire.sources.tables import table
from tapewire.sources.tabular import IPO_SQL, SCORED_SQL, ipo_raw, scored

NUMERIC = ["issue_size(crores)", "qib", "hni", "rii", "total", "offer_price", "list_price", "listing_gain"]
PLAIN = ["issue_size", "qib", "hni", "rii", "total", "offer_price", "list_price", "listing_gain"]


def ipo(spark, sf):
    return ql.standard_names(ipo_raw(spark, sf))


def numbers(spark, sf):
    return ipo(spark, sf).withColumnRenamed("issue_size(crores)", "issue_size").select(*PLAIN)


NUMBERS_SQL = f'{IPO_SQL}, numbers AS (SELECT "issue_size(crores)" AS issue_size, qib, hni, rii, total, offer_price, list_price, listing_gain FROM ipo)'
LONG_SQL = f"{NUMBERS_SQL}, long AS (UNPIVOT numbers ON {', '.join(PLAIN)} INTO NAME column_name VALUE value)"


@query(
    "standardize_names",
    f"""WITH {IPO_SQL} SELECT "date", ipo_name, round("issue_size(crores)", 6) AS "issue_size(crores)",
{", ".join(f"round({c}, 6) AS {c}" for c in PLAIN[1:])}, segment FROM ipo""",
)
def standardize_names(spark, sf):
    rows = ipo(spark, sf)
    return rows.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c in NUMERIC else F.col(c) for c in rows.columns])


@query(
    "binary_target",
    f"""WITH {IPO_SQL} SELECT ipo_name, CASE WHEN listing_gain > 0 THEN 1 ELSE 0 END AS target FROM ipo WHERE listing_gain IS NOT NULL""",
)
def binary_target(spark, sf):
    return ql.with_target(ipo(spark, sf)).select("ipo_name", "target")


@query(
    "ipo_features",
    f"""WITH {IPO_SQL} SELECT {", ".join(f'round("{c}", 6) AS "{c}"' for c in ql.IPO_FEATURES[:-1])},
  round((coalesce(qib, 0) + coalesce(hni, 0) + coalesce(rii, 0)) / nullif((qib IS NOT NULL)::INT + (hni IS NOT NULL)::INT + (rii IS NOT NULL)::INT, 0), 6)
    AS avg_subscription, CASE WHEN listing_gain > 0 THEN 1 ELSE 0 END AS target FROM ipo WHERE listing_gain IS NOT NULL""",
)
def ipo_features(spark, sf):
    rows = ql.ipo_features(ql.with_target(ipo(spark, sf)))
    return rows.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) for c in ql.IPO_FEATURES], "target")


@query(
    "describe",
    f"""WITH {LONG_SQL} SELECT column_name, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max FROM long GROUP BY column_name""",
)
def describe(spark, sf):
    return rounded(ql.describe(numbers(spark, sf), PLAIN), "mean", "std", "min", "p25", "p50", "p75", "max")


@query(
    "corr_matrix",
    f"WITH {NUMBERS_SQL} " + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM numbers" for a in PLAIN for b in PLAIN
    ),
)
def corr_matrix(spark, sf):
    return rounded(ql.correlation(numbers(spark, sf), PLAIN), "corr")


@query(
    "histogram",
    f"""WITH {LONG_SQL}, span AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long GROUP BY column_name)
SELECT column_name, least(CAST(floor((value - lo) / ((hi - lo) / 30)) AS BIGINT) + 1, 30) AS bin, count(*) AS n
FROM long JOIN span USING (column_name) GROUP BY ALL""",
)
def histogram(spark, sf):
    return ql.histogram(numbers(spark, sf), PLAIN)


@query(
    "impute_median_mode",
    f"""WITH {IPO_SQL}, m AS (SELECT median("issue_size(crores)") AS i, median(hni) AS h FROM ipo),
top AS (SELECT segment AS s FROM ipo WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)
SELECT ipo_name, round(coalesce("issue_size(crores)", i), 6) AS issue_size, round(coalesce(hni, h), 6) AS hni, coalesce(segment, s) AS segment FROM ipo, m, top""",
)
def impute_median_mode(spark, sf):
    rows = ipo(spark, sf).withColumnRenamed("issue_size(crores)", "issue_size")
    filled = ql.imputed(rows.select("ipo_name", "issue_size", "hni", "segment"), ["issue_size", "hni"], ["segment"])
    return rounded(filled, "issue_size", "hni")


@query(
    "class_weights",
    """SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / (count(DISTINCT quality) * 0 + (SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight
FROM labels GROUP BY quality""",
)
def class_weights(spark, sf):
    return rounded(ql.class_weights(table(spark, sf, "labels"), "quality"), "weight")


# ---- splits ---------------------------------------------------------------

HASHED = """ranked AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r,
  count(*) OVER (PARTITION BY lang) AS n FROM documents)"""


def classed(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang")


@query("stratified_split", f"WITH {HASHED} SELECT doc_id, lang, CASE WHEN r <= round(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM ranked")
def stratified_split(spark, sf):
    return ev.stratified_parts(classed(spark, sf), "lang", "doc_id", {"train": 0.8, "test": 1.0})


@query(
    "stratified_split3",
    f"""WITH {HASHED} SELECT doc_id, lang, CASE WHEN r <= round(n * 0.8) THEN 'train' WHEN r <= round(n * 0.9) THEN 'validation' ELSE 'test' END AS part
FROM ranked""",
)
def stratified_split3(spark, sf):
    return ev.stratified_parts(classed(spark, sf), "lang", "doc_id", {"train": 0.8, "validation": 0.9, "test": 1.0})


@query("kfold_assign", f"WITH {HASHED} SELECT doc_id, lang, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ranked")
def kfold_assign(spark, sf):
    return ev.stratified_folds(classed(spark, sf), "lang", "doc_id")


@query(
    "tail_holdout",
    """SELECT vec_id, label, CASE WHEN row_number() OVER (ORDER BY vec_id) > floor((SELECT count(*) FROM embeddings) * 0.9) THEN 'validation' ELSE 'train' END AS part
FROM embeddings""",
)
def tail_holdout(spark, sf):
    return ev.tail_holdout(table(spark, sf, "embeddings").select("vec_id", "label"), ["vec_id"])


# ---- vectors --------------------------------------------------------------


@query("one_hot", "SELECT vec_id, list_transform(range(10), lambda i: CAST(i = label AS INTEGER)) AS encoded FROM embeddings")
def one_hot(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", vc.one_hot(F.col("label"), 10).alias("encoded"))


@query("vector_scale", "SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) / 255, 9)) AS scaled FROM embeddings")
def vector_scale(spark, sf):
    scaled = F.transform(vc.scaled(F.col("embedding"), 255.0), lambda x: F.round(x, 9))
    return table(spark, sf, "embeddings").select("vec_id", scaled.alias("scaled"))


@query("vector_reshape", "SELECT vec_id, list_transform(range(8), lambda i: embedding[i * 8 + 1:i * 8 + 8]) AS grid FROM embeddings")
def vector_reshape(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", vc.reshaped(F.col("embedding"), 8, 8).alias("grid"))


@query(
    "standard_scale",
    """WITH c AS (SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
z AS (SELECT vec_id, i, (x - avg(x) OVER (PARTITION BY i)) / nullif(stddev_pop(x) OVER (PARTITION BY i), 0) AS z FROM c)
SELECT vec_id, list(round(coalesce(z, 0), 6) ORDER BY i) AS scaled FROM z GROUP BY vec_id""",
)
def standard_scale(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    scaled = vc.standardised(rows, "embedding", vc.dimension_stats(rows, "embedding"))
    return scaled.select("vec_id", F.transform("embedding", lambda x: F.round(x, 6)).alias("scaled"))


@query(
    "argmax_confidence",
    """SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS predicted, round(CAST(list_max(embedding) AS DOUBLE) * 100, 4) AS confidence FROM embeddings""",
)
def argmax_confidence(spark, sf):
    best, confidence = ev.argmax_confidence(F.col("embedding"))
    rows = table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return rows.select("vec_id", best.alias("predicted"), F.round(confidence, 4).alias("confidence"))


# ---- metrics --------------------------------------------------------------

TALLY = """tally AS (SELECT c AS class, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS support,
  count(*) FILTER (prediction = c) AS called FROM scored, (VALUES (0), (1)) v(c) GROUP BY c),
report AS (SELECT class, coalesce(tp / nullif(called, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
  coalesce(2 * tp / nullif(called + support, 0), 0) AS f1, support, tp FROM tally)"""


@query(
    "eval_metrics",
    f"""WITH {SCORED_SQL}, {TALLY} SELECT round(sum(tp) / sum(support), 6) AS accuracy, {", ".join(f"round(avg({m}), 6) AS macro_{m}" for m in ("precision", "recall", "f1"))},
  {", ".join(f"round(sum({m} * support) / sum(support), 6) AS weighted_{m}" for m in ("precision", "recall", "f1"))},
  {", ".join(f"round(max({m}) FILTER (class = 1), 6) AS positive_{m}" for m in ("precision", "recall", "f1"))} FROM report""",
)
def eval_metrics(spark, sf):
    out = ev.metrics(scored(spark, sf), positive=1)
    return rounded(out, *out.columns)


@query(
    "class_report",
    f"""WITH {SCORED_SQL}, {TALLY}, r AS (SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM report
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM report
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM report)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r""",
)
def class_report(spark, sf):
    return rounded(ev.full_report(scored(spark, sf)), "precision", "recall", "f1")


@query(
    "confusion_matrix",
    f"""WITH {SCORED_SQL} SELECT a.c AS actual, p.c AS predicted, count(doc_id) AS n FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) p(c)
LEFT JOIN scored ON label = a.c AND prediction = p.c GROUP BY ALL""",
)
def confusion_matrix(spark, sf):
    return ev.confusion(scored(spark, sf))


@query(
    "threshold_sweep",
    f"""WITH {SCORED_SQL}, t AS (SELECT unnest(range(30, 71)) / 100 AS threshold),
c AS (SELECT threshold, count(*) FILTER (prob >= threshold AND label = 1) AS tp, count(*) FILTER (prob >= threshold AND label = 0) AS fp,
  count(*) FILTER (prob < threshold AND label = 1) AS fn, count(*) FILTER (prob < threshold AND label = 0) AS tn FROM scored, t GROUP BY threshold)
SELECT round(threshold, 6) AS threshold, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
  round((coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2, 6) AS macro_f1 FROM c""",
)
def threshold_sweep(spark, sf):
    return rounded(ev.threshold_sweep(scored(spark, sf)), "threshold", "accuracy", "macro_f1")


BOTH_SQL = f"""{SCORED_SQL}, two AS (SELECT doc_id, label, 'length' AS model, prediction, prob AS confidence FROM scored
  UNION ALL SELECT doc_id, label, 'parity', other, 1 - prob FROM scored)"""


def two_models(spark, sf):
    rows = scored(spark, sf)
    first = rows.select("doc_id", "label", F.lit("length").alias("model"), "prediction", F.col("prob").alias("confidence"))
    second = rows.select("doc_id", "label", F.lit("parity"), F.col("other"), 1 - F.col("prob"))
    return first.union(second)


@query(
    "prediction_compare",
    f"WITH {BOTH_SQL} SELECT doc_id, label, model, prediction, round(confidence, 6) AS confidence, prediction = label AS correct FROM two",
)
def prediction_compare(spark, sf):
    return rounded(ev.compare_predictions(two_models(spark, sf), "doc_id", "label"), "confidence")


ACCURACY_SQL = f"{BOTH_SQL}, acc AS (SELECT model, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0 END) AS accuracy FROM two GROUP BY model)"


def accuracies(spark, sf):
    hit = (F.col("prediction") == F.col("label")).cast("int")
    return two_models(spark, sf).groupBy("model").agg(F.avg(hit).alias("accuracy"))


@query("best_model", f"WITH {ACCURACY_SQL} SELECT model, round(accuracy, 6) AS accuracy FROM acc ORDER BY acc.accuracy DESC, model LIMIT 1")
def best_model(spark, sf):
    return rounded(ev.best_model(accuracies(spark, sf), "accuracy"), "accuracy")


@query("model_comparison", f"WITH {ACCURACY_SQL} SELECT model, round(accuracy, 6) AS accuracy FROM acc ORDER BY acc.accuracy DESC, model")
def model_comparison(spark, sf):
    return rounded(accuracies(spark, sf).orderBy(F.desc("accuracy"), "model"), "accuracy")


# ---- cluster figures over given labels ------------------------------------

SILHOUETTE_SQL = """
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT a.vec_id, a.label AS own, b.label AS other, avg(CASE WHEN a.vec_id <> b.vec_id THEN list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) END) AS m
  FROM v a, v b GROUP BY ALL),
s AS (SELECT vec_id, max(m) FILTER (own = other) AS a, min(m) FILTER (own <> other) AS b FROM d GROUP BY vec_id)
"""


@query(
    "silhouette",
    f"""WITH {SILHOUETTE_SQL} SELECT vec_id, round((b - a) / greatest(a, b), 6) AS silhouette FROM s""",
)
def silhouette(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("v"))
    return rounded(cl.silhouette(rows, "vec_id"), "silhouette")


@query(
    "silhouette_exact",
    f"""WITH {SILHOUETTE_SQL.replace("list_sum(", "sqrt(list_sum(").replace("(p[1] - p[2])))", "(p[1] - p[2]))))")} SELECT vec_id, round((b - a) / greatest(a, b), 6) AS silhouette FROM s""",
)
def silhouette_exact(spark, sf):
    """Euclidean silhouettes of the labelled vectors, from sums of blocks."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.lit(1).cast("bigint").alias("w"), "label")
    labels = rows.select(F.lit(0).alias("setting"), "id", F.col("label").cast("bigint").alias("cluster"))
    return rounded(nb.exact_silhouettes(cut_lineage(rows.drop("label")), labels).select(F.col("id").alias("vec_id"), "silhouette"), "silhouette")


@query(
    "kdist",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT a.vec_id, sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS x FROM v a, v b),
r AS (SELECT vec_id, round(x, 6) AS distance, row_number() OVER (PARTITION BY vec_id ORDER BY x) AS n FROM d)
SELECT vec_id, distance, row_number() OVER (ORDER BY distance, vec_id) AS position FROM r WHERE n = 10""",
)
def kdist(spark, sf):
    """Distance of every vector to the tenth nearest, itself counted, in ascending order."""
    points, members = nb.distinct_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding")
    found = nb.curve(nb.k_distances(points, members))
    return found.select(F.col("key").alias("vec_id"), "distance", "position")


@query("cluster_sizes", "SELECT label AS cluster, count(*) AS n, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS share FROM embeddings GROUP BY label")
def cluster_sizes(spark, sf):
    return rounded(cl.sizes(table(spark, sf, "embeddings").select(F.col("label").alias("cluster"))), "share")


@query(
    "knee_point",
    """WITH c AS (SELECT row_number() OVER (ORDER BY n DESC, source) AS x, CAST(n AS DOUBLE) AS y FROM (SELECT source, sum(n_chars) AS n FROM documents GROUP BY source)),
b AS (SELECT x, (x - min(x) OVER ()) / nullif(max(x) OVER () - min(x) OVER (), 0) AS u, (y - min(y) OVER ()) / nullif(max(y) OVER () - min(y) OVER (), 0) AS v FROM c),
e AS (SELECT arg_min(u, x) AS u0, arg_min(v, x) AS v0, arg_max(u, x) AS u1, arg_max(v, x) AS v1 FROM b)
SELECT x, round(abs((u1 - u0) * (v - v0) - (v1 - v0) * (u - u0)) / sqrt((u1 - u0) ** 2 + (v1 - v0) ** 2), 6) AS distance FROM b, e
ORDER BY distance DESC, x LIMIT 1""",
)
def knee_point(spark, sf):
    """Knee of the curve of text volume per source, from the largest source down."""
    from pyspark.sql import Window

    volume = table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").cast("double").alias("y"))
    curve = volume.select(F.row_number().over(Window.orderBy(F.desc("y"), "source")).cast("bigint").alias("x"), "y")
    return rounded(cl.knee(curve, "x", "y"), "distance")
