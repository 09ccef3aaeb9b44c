"""Labelled tables derived from customers, orders, labels and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire.sources.tables import table

RAW_COLUMNS = [
    "Date", "IPO Name", "Issue_Size(crores)", "QIB", "HNI", "RII", "Total", "Offer Price", "List Price",
    "Listing Gain", "Segment",
]

IPO_SQL = """
per AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s, avg(o_totalprice) AS a, max(o_totalprice) AS hi, min(o_totalprice) AS lo,
               min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY o_custkey),
ipo AS (SELECT d AS "date", c_name AS ipo_name, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS "issue_size(crores)",
  a / 997 AS qib, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE hi / 997 END AS hni, lo / 997 AS rii, s / 997 AS total,
  CAST(n AS DOUBLE) AS offer_price, c_acctbal + a / 997 AS list_price,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE a - (hi + lo) / 2 + c_acctbal END AS listing_gain,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer JOIN per ON o_custkey = c_custkey)
"""


def ipo_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as issues; the orders are summed per customer before the join."""
    key = F.col("c_custkey")
    price = F.col("o_totalprice")
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum(price).alias("s"), F.avg(price).alias("a"), F.max(price).alias("hi"),
        F.min(price).alias("lo"), F.min(F.to_date("o_orderdate")).alias("d"),
    )
    a, hi, lo, balance = (F.col(c) for c in ("a", "hi", "lo", "c_acctbal"))
    columns = [
        F.col("d"), F.col("c_name"), F.when(key % 17 != 0, balance), a / 997, F.when(key % 13 != 0, hi / 997), lo / 997,
        F.col("s") / 997, F.col("n").cast("double"), balance + a / 997,
        F.when(key % 29 != 0, a - (hi + lo) / 2 + balance), F.when(key % 11 != 0, F.col("c_mktsegment")),
    ]
    joined = table(spark, sf, "customer").join(per, "c_custkey")
    return joined.select(*[c.alias(n) for c, n in zip(columns, RAW_COLUMNS)])


SCORED_SQL = """scored AS (SELECT doc_id, quality AS label, (n_chars % 101) / 100.0::DOUBLE AS prob, source,
  CASE WHEN (n_chars % 101) >= 50 THEN 1 ELSE 0 END AS prediction, CASE WHEN (n_chars % 7) >= 2 THEN 1 ELSE 0 END AS other
  FROM labels JOIN documents USING (doc_id))"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a probability and two models' predictions."""
    n = F.col("n_chars")
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    return rows.select(
        "doc_id", F.col("quality").alias("label"), (n % 101 / 100).alias("prob"), "source",
        F.when(n % 101 >= 50, 1).otherwise(0).alias("prediction"), F.when(n % 7 >= 2, 1).otherwise(0).alias("other"),
    )
