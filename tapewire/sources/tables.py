"""The given tables and the inputs derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(rows, TEXT_TABLES[name]) if name in TEXT_TABLES else rows


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Hash rows over the cores when the files give fewer splits than that.

    Text work costs CPU, and a table in one row group would run on one core.
    A large table has more splits than cores and is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars per ticker: one trade per order line, the part's brand as ticker.

    min_by and max_by combine on the map side, so a ticker or day with a third of
    the trades shuffles one partial row per task.
    """
    trades = spread(table(spark, sf, "lineitem"), "l_orderkey")
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ticker"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    turn = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return (
        trades.join(brands, "l_partkey")
        .groupBy("ticker", F.to_date("l_shipdate").alias("dt"))
        .agg(
            F.min_by(price, turn).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, turn).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
    )


BARS_SQL = """
trades AS (
  SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS dt, l_extendedprice / l_quantity AS price, l_quantity,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem JOIN part ON p_partkey = l_partkey),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY ticker, dt ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                               l_extendedprice, l_quantity) AS a,
         row_number() OVER (PARTITION BY ticker, dt ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
                            l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS z
  FROM trades),
bars AS (
  SELECT ticker, dt, max(CASE WHEN a = 1 THEN price END) AS open, max(price) AS high, min(price) AS low,
         max(CASE WHEN z = 1 THEN price END) AS close, sum(l_quantity) AS volume
  FROM turns GROUP BY ticker, dt)
"""
