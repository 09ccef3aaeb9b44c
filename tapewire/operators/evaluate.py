"""Splits, classification metrics and threshold sweeps.

Metrics are algebra over a confusion table: rows are counted once per
(label, prediction), and everything after has a row per class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.functions.numeric import safe_div
from tapewire.operators.ordering import hashed_rank, sequential_id


def stratified_parts(df: DataFrame, label: str, key: str, cuts: dict[str, float]) -> DataFrame:
    """Name a part per row: `cuts` maps part names to cumulative shares of each class."""
    ranked = hashed_rank(df, [label], key)
    position = F.col("rank")
    parts = [F.when(position <= F.round(F.col("group_size") * share), name) for name, share in cuts.items()]
    return ranked.withColumn("part", F.coalesce(*parts)).drop("rank", "group_size")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5) -> DataFrame:
    ranked = hashed_rank(df, [label], key)
    return ranked.withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(folds)).cast("int")).drop("rank", "group_size")


def tail_holdout(df: DataFrame, order: Sequence[str], share: float = 0.1) -> DataFrame:
    """Last rows in order as validation."""
    numbered = sequential_id(df, order, "_nth")
    n = df.count()
    part = F.when(F.col("_nth") > int(n * (1 - share)), "validation").otherwise("train")
    return numbered.withColumn("part", part).drop("_nth")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts of every pair of classes, zeros included; the class list is one row per class."""
    counts = df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(F.count("*").alias("n"))
    classes = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).agg(F.collect_set("c").alias("c"))
    cells = classes.select(F.explode("c").alias("actual"), "c").select("actual", F.explode("c").alias("predicted"))
    return cells.join(counts, ["actual", "predicted"], "left").fillna({"n": 0})


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, 0 where undefined."""
    counts = df.groupBy(F.col(label).alias("a"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    sides = counts.select("n", F.explode(F.array(
        F.struct(F.col("a").alias("class"), F.lit(True).alias("real"), (F.col("a") == F.col("p")).alias("hit")),
        F.struct(F.col("p").alias("class"), F.lit(False).alias("real"), F.lit(False).alias("hit")),
    )).alias("s")).select("n", "s.*")
    totals = sides.groupBy("class").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("real"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("real"), F.col("n")).otherwise(0)).alias("called"),
    )
    zero = F.lit(0.0)
    precision = F.coalesce(safe_div(F.col("tp"), F.col("called")), zero)
    recall = F.coalesce(safe_div(F.col("tp"), F.col("support")), zero)
    f1 = F.coalesce(2 * F.col("tp") / F.nullif(F.col("called") + F.col("support"), F.lit(0)), zero)
    return totals.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "tp")


def full_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class rows plus their macro and support-weighted means."""
    report = class_report(df, label, prediction)
    names = ["precision", "recall", "f1"]
    rows = report.select(F.col("class").cast("string").alias("class"), *names, "support")
    macro = rows.agg(F.lit("macro avg").alias("class"), *[F.avg(n).alias(n) for n in names], F.sum("support").alias("support"))
    weighted = rows.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(n) * F.col("support")) / F.sum("support")).alias(n) for n in names],
        F.sum("support").alias("support"),
    )
    return rows.unionByName(macro).unionByName(weighted)


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", positive=None) -> DataFrame:
    """Accuracy with macro and weighted precision, recall and F1; with `positive` also that class."""
    report = class_report(df, label, prediction)
    names = ["precision", "recall", "f1"]
    n = F.sum("support")
    cells = [(F.sum("tp") / n).alias("accuracy"), *[F.avg(c).alias(f"macro_{c}") for c in names]]
    cells += [(F.sum(F.col(c) * F.col("support")) / n).alias(f"weighted_{c}") for c in names]
    if positive is not None:
        cells += [F.max(F.when(F.col("class") == positive, F.col(c))).alias(f"positive_{c}") for c in names]
    return report.agg(*cells)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), F.lit(0.0))


def threshold_sweep(df: DataFrame, prob: str = "prob", label: str = "label", low: int = 30, high: int = 70) -> DataFrame:
    """Accuracy and macro F1 at thresholds low/100 .. high/100.

    A row is positive at every threshold up to its probability, so it is counted
    once under the last threshold it passes; counts are then summed from the top.
    """
    steps = list(range(low, high + 1))
    passed = F.coalesce(*[F.when(F.col(prob) >= t / 100, t) for t in reversed(steps)], F.lit(low - 1))
    buckets = df.groupBy(passed.alias("t")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"), F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg")
    )
    grid = df.sparkSession.range(low - 1, high + 1).select(F.col("id").alias("t")).join(buckets, "t", "left")
    above = Window.orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    zero = F.lit(0)
    summed = grid.select(
        "t",
        F.sum(F.coalesce("pos", zero)).over(above).alias("tp"),
        F.sum(F.coalesce("neg", zero)).over(above).alias("fp"),
        F.sum(F.coalesce("pos", zero)).over(whole).alias("p"),
        F.sum(F.coalesce("neg", zero)).over(whole).alias("q"),
    ).where(F.col("t") >= low)
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("p") - tp, F.col("q") - fp
    return summed.select(
        (F.col("t") / 100).alias("threshold"),
        ((tp + tn) / (F.col("p") + F.col("q"))).alias("accuracy"),
        ((_f1(tp, fp, fn) + _f1(tn, fn, fp)) / 2).alias("macro_f1"),
    )


def best_threshold(sweep: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """Row of the best metric, the smallest threshold on ties."""
    return sweep.orderBy(F.desc(metric), "threshold").limit(1)


def argmax_confidence(probabilities: Column) -> tuple[Column, Column]:
    """Index of the largest probability and its percentage."""
    best = F.array_max(probabilities)
    return (F.array_position(probabilities, best) - 1).cast("int"), best * 100


def compare_predictions(predictions: DataFrame, key: str, label: str) -> DataFrame:
    """Long (key, model, prediction, confidence) rows with a correct flag."""
    return predictions.withColumn("correct", F.col("prediction") == F.col(label))


def best_model(scores: DataFrame, metric: str) -> DataFrame:
    return scores.orderBy(F.desc(metric), "model").limit(1)
