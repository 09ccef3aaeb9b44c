"""Dense vectors as arrays: scaling, reshaping, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def scaled(vector: Column, divisor: float) -> Column:
    return F.transform(vector, lambda x: x.cast("double") / divisor)


def reshaped(vector: Column, rows: int, columns: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(vector, i * columns + 1, F.lit(columns)))


def dimension_stats(df: DataFrame, vector: str) -> tuple[list[float], list[float]]:
    """Mean and population deviation per dimension: one small row per dimension on the driver."""
    cells = df.select(F.posexplode(F.col(vector).cast("array<double>")).alias("i", "x"))
    rows = cells.groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("i").collect()
    return [r["m"] for r in rows], [r["s"] for r in rows]


def standardised(df: DataFrame, vector: str, stats: tuple[list[float], list[float]]) -> DataFrame:
    """(x - mean) / deviation with fitted figures; a constant dimension gives 0."""
    means, deviations = (F.array(*[F.lit(float(v)) for v in part]) for part in stats)
    centred = F.zip_with(F.col(vector).cast("array<double>"), means, lambda x, m: x - m)
    return df.withColumn(
        vector, F.zip_with(centred, deviations, lambda x, s: F.when(s == 0, F.lit(0.0)).otherwise(x / F.nullif(s, F.lit(0.0))))
    )
