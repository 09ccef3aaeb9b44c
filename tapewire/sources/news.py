"""News inputs derived from documents and pages.

The derived columns are SQL expressions that Spark and DuckDB read alike, so both
sides of a check start from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire.sources.tables import table

TITLE = "split_part(text, chr(10), 1)"
AUTHOR = """CASE doc_id % 10 WHEN 0 THEN 'By Jane  Doe' WHEN 1 THEN 'staff' WHEN 2 THEN 'https://x.com/a' WHEN 3 THEN '   '
 WHEN 4 THEN 'Written by: Max Roe' WHEN 5 THEN '12345' WHEN 6 THEN NULL WHEN 7 THEN 'A' WHEN 8 THEN 'Ann &amp; Bob Fox'
 ELSE 'posted by desk@paper' END"""
DAY = "lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0')"
PUBLISHED = f"""CASE doc_id % 9 WHEN 0 THEN '2024-01-' || {DAY} || 'T03:04:05Z' WHEN 1 THEN '2024-07-' || {DAY} || 'T12:00:00+0200'
 WHEN 2 THEN 'Jan ' || CAST(1 + doc_id % 28 AS STRING) || ', 2024 at 3:04 PM' WHEN 3 THEN 'junk' WHEN 4 THEN '2024-03-10 08:09:10'
 WHEN 5 THEN '2024-02-' || {DAY} WHEN 6 THEN '2024-05-' || {DAY} || ' 01:02:03 PM EDT' WHEN 7 THEN '' ELSE NULL END"""
BRANDED = f"""{TITLE} || CASE doc_id % 6 WHEN 0 THEN ' - Reuters' WHEN 1 THEN ' | BBC' WHEN 2 THEN ' – The Guardian'
 WHEN 3 THEN ' - Daily Wire 24' WHEN 4 THEN ' &amp; more' ELSE '' END"""
MOOD = """CASE doc_id % 8 WHEN 0 THEN ' Apple shares surge on record growth' WHEN 1 THEN ' tesla stock falls on recall probe'
 WHEN 2 THEN ' $NVDA beats but warns of delays' WHEN 3 THEN ' pineapple markets drift' WHEN 4 THEN ' amazon.com wins deal, AAPL slumps'
 WHEN 5 THEN ' Microsoft Corp layoffs, fraud risk' WHEN 6 THEN ' MSFT and GOOGL rally' ELSE ' no company here' END"""
SUMMARY = """'<p>' || text || '</p> see https://t.co/' || CAST(doc_id AS STRING) || ' &lt;b&gt;now&lt;/b&gt; &amp;&nbsp;then'"""
STATUS = """CASE page_id % 7 WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 404 WHEN 3 THEN 429 WHEN 4 THEN 500 WHEN 5 THEN NULL
 ELSE 200 END"""
RSS_DATE = f"""CASE doc_id % 4 WHEN 0 THEN 'Tue, ' || {DAY} || ' Oct 2024 23:30:00 GMT'
 WHEN 1 THEN 'Wed, ' || {DAY} || ' Oct 2024 23:30:00 +0000' WHEN 2 THEN 'Fri, ' || {DAY} || ' Oct 2024 23:30:00 -0500' ELSE 'soon' END"""
EPOCH_OR_ISO = f"""CASE doc_id % 4 WHEN 0 THEN CAST(1700000000 + doc_id * 977 AS STRING) WHEN 1 THEN '2024-06-' || {DAY} || 'T12:30:00Z'
 WHEN 2 THEN NULL ELSE 'unknown' END"""

DOCS_SQL = f"""docs AS (
  SELECT doc_id AS pos, doc_id, source, lang, text, {TITLE} AS title, {AUTHOR} AS author, {PUBLISHED} AS published,
         {BRANDED} AS branded, text || {MOOD} AS headline, {SUMMARY} AS summary FROM documents)"""
ARTICLES_SQL = f"""{DOCS_SQL},
articles AS (SELECT docs.*, url, html, page_id FROM docs JOIN pages ON page_id = doc_id % (SELECT count(*) FROM pages))"""
CRAWL_SQL = f"""crawl AS (SELECT page_id, url, {STATUS} AS status_code, (page_id % 50) / 10.0 AS response_time FROM pages)"""
LINKS_SQL = """links AS (
  SELECT page_id * 4 + 0 AS pos, url FROM pages UNION ALL
  SELECT page_id * 4 + 1, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'ftp://x.org/' || page_id WHEN 2 THEN ''
    WHEN 3 THEN '  ' || url || ' ' ELSE 'HTTPS://A.com/B//?q=1#f' END FROM pages UNION ALL
  SELECT page_id * 4 + 2, CASE page_id % 4 WHEN 0 THEN 'http://' WHEN 1 THEN 'https://wsj.com/x/' || page_id || '/'
    WHEN 2 THEN 'https://www.bbc.com/news/articles/c' || page_id || '?at=x' ELSE 'https://edition.cnn.com/2024/01/02/world/a' || page_id END
  FROM pages)"""


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """One article per document; the title is its first line, the text stays whole."""
    columns = {
        "title": TITLE, "author": AUTHOR, "published": PUBLISHED, "branded": BRANDED,
        "headline": f"text || {MOOD}", "summary": SUMMARY,
    }
    rows = table(spark, sf, "documents")
    return rows.select(
        F.col("doc_id").alias("pos"), "doc_id", "source", "lang", "text",
        *[F.expr(e).alias(n) for n, e in columns.items()],
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with the url and page they were found on."""
    pages = table(spark, sf, "pages")
    n_pages = pages.count()
    return docs(spark, sf).withColumn("page_id", F.col("doc_id") % n_pages).join(pages, "page_id")


def crawl_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", "url", F.expr(STATUS).alias("status_code"), ((F.col("page_id") % 50) / 10.0).alias("response_time")
    )


def links(spark: SparkSession, sf: str) -> DataFrame:
    """A url list with repeats, blanks and bad schemes: three entries per page."""
    rows = table(spark, sf, "pages").select("page_id", "url")
    rows.createOrReplaceTempView("_pages_for_links")
    return spark.sql("WITH " + LINKS_SQL.replace("pages", "_pages_for_links") + " SELECT * FROM links")


NEWS_SQL = f"""{DOCS_SQL},
dates AS (SELECT dt, row_number() OVER (ORDER BY dt) - 1 AS nth, count(*) OVER () AS n
          FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem)),
news AS (SELECT doc_id, 'Brand#' || CAST(11 + (doc_id % 5) * 10 + (doc_id // 5) % 5 AS STRING) AS ticker, dt, headline
         FROM docs JOIN dates ON nth = (doc_id * 37) % n)"""


def news_history(spark: SparkSession, sf: str) -> DataFrame:
    """Headlines with a ticker and a trading date.

    The numbered dates are one row per trading day, small by the calendar.
    """
    from pyspark.sql import Window

    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("dt")).distinct()
    numbered = days.select("dt", (F.row_number().over(Window.orderBy("dt")) - 1).cast("bigint").alias("nth"))
    n = days.count()
    ticker = F.concat(F.lit("Brand#"), (11 + (F.col("doc_id") % 5) * 10 + F.floor(F.col("doc_id") / 5) % 5).cast("string"))
    rows = docs(spark, sf).select("doc_id", ticker.alias("ticker"), "headline", ((F.col("doc_id") * 37) % n).alias("nth"))
    return rows.join(numbered, "nth").drop("nth")
