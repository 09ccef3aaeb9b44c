"""Queries over raw pages: extraction, JSON-LD, links; and file sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewire.functions import lexicon as lx
from tapewire.functions import pages as pg
from tapewire.functions.numeric import rounded
from tapewire.operators import extract as ex
from tapewire.plans.news import HOST, LINK, basic, shown, sq
from tapewire.plans.registry import query
from tapewire.sources import files as fl
from tapewire.sources import news as nw
from tapewire.sources.tables import BARS_SQL, bars, table

# A head block per page, so that every page carries structured data or lacks it in a known way.
ID = "CAST(page_id AS STRING)"
Q = "' || chr(39) || '"  # a single quote inside a literal of either dialect
LD_OPEN = '<script type="application/ld+json">'
BLOCK = f"""CASE page_id % 6
 WHEN 0 THEN '{LD_OPEN}{{"@type":"NewsArticle","headline":"Story ' || {ID} || '","datePublished":"2024-01-05T10:00:00Z","dateModified":"2024-01-06T00:00:00Z","author":{{"@type":"Person","name":"Ann Lee"}},"description":"About ' || {ID} || '","articleBody":"Body ' || {ID} || '"}}</script>'
 WHEN 1 THEN '{LD_OPEN}[{{"@type":"WebSite","name":"x"}},{{"@type":"Article","headline":"Item ' || {ID} || '","dateCreated":"2024-07-05T10:00:00Z","author":[{{"name":"Bo Ray"}},{{"name":"Cy Fox"}}],"articleBody":"Long body ' || {ID} || '"}}]</script>'
 WHEN 2 THEN '{LD_OPEN}{{"@context":"x","@graph":[{{"@type":"ReportageNewsArticle","headline":"Graph ' || {ID} || '","uploadDate":"2024-03-01","author":"Dee Hill"}}]}}</script>'
 WHEN 3 THEN '{LD_OPEN}{{"headline":"cut off</script><meta name="date" content="2024-02-02">'
 WHEN 4 THEN '<meta property="og:title" content="Meta ' || {ID} || '"><meta property="article:published_time" content="2024-06-01T08:00:00+02:00"><meta name=author content="Fay Gold"><meta content={Q}Told ' || {ID} || '{Q} name={Q}description{Q}>'
 ELSE '{LD_OPEN}{{bad</script>{LD_OPEN}{{"@type":"NewsArticle","headline":"Second ' || {ID} || '","datePublished":"junk","author":["Eve Moss","Gil Park"]}}</script>' END"""
MARKED = f"replace(html, '<head>', '<head>' || {BLOCK})"
TIMED = "replace(html, '<article>', '<article><p class=\"byline\">Hal <b>Ives</b>' || CASE page_id % 2 WHEN 0 THEN '</p>' ELSE '<p>' END || '<time datetime=\"2024-04-0' || CAST(1 + page_id % 9 AS STRING) || '\">soon</time>')"


def marked_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", F.expr(MARKED).alias("html"))


def plain_sql(expr: str) -> str:
    return sq(basic(f"regexp_replace({expr}, '<[^>]*>', ' ', 'g')"))


def unscripted(expr: str) -> str:
    for tag in ("script", "style", "noscript"):
        expr = f"regexp_replace({expr}, '(?is)<{tag}[^>]*>.*?</{tag}>', '', 'g')"
    return expr


def paragraphs_sql(expr: str) -> str:
    body = plain_sql("regexp_replace(b, '(?is)</(p|article|div|body|html)>.*$', '')")
    return f"""list_filter(list_transform(regexp_split_to_array({expr}, '(?i)<p(?:\\s[^>]*)?>')[2:], lambda b: {body}), lambda t: t <> '')"""


TITLE = plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
ARTICLE = f"regexp_extract({unscripted('html')}, '(?is)<article[^>]*>(.*?)</article>', 1)"


@query("page_title", f"SELECT page_id, {TITLE} AS title FROM pages")
def page_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", pg.title(F.col("html")).alias("title"))


@query("page_text", f"SELECT page_id, array_to_string({paragraphs_sql(unscripted('html'))}, ' ') AS content FROM pages")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", pg.body_text(F.col("html")).alias("content"))


@query("page_article_text", f"SELECT page_id, array_to_string({paragraphs_sql(ARTICLE)}, chr(10)) AS content FROM pages")
def page_article_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", pg.article_text(F.col("html")).alias("content"))


@query(
    "page_meta",
    f"""SELECT page_id, CASE page_id % 6 WHEN 4 THEN 'Meta ' || {ID} END AS og_title, CASE page_id % 6 WHEN 4 THEN '2024-06-01T08:00:00+02:00'
  WHEN 3 THEN '2024-02-02' END AS published, CASE page_id % 6 WHEN 4 THEN 'Fay Gold' END AS author,
  CASE page_id % 6 WHEN 4 THEN 'Told ' || {ID} END AS description FROM pages""",
)
def page_meta(spark, sf):
    tagged = marked_pages(spark, sf).select("page_id", pg.meta_tags(F.col("html")).alias("tags"))
    keys = {"og_title": ["og:title"], "published": pg.DATE_KEYS, "author": pg.AUTHOR_KEYS, "description": pg.DESCRIPTION_KEYS}
    return tagged.select("page_id", *[pg.meta_value(F.col("tags"), k).alias(n) for n, k in keys.items()])


@query(
    "jsonld_extract",
    f"""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'Story ' || {ID} WHEN 1 THEN 'Item ' || {ID} WHEN 2 THEN 'Graph ' || {ID} WHEN 5 THEN 'Second ' || {ID} END AS title,
  CASE page_id % 6 WHEN 0 THEN '2024-01-05 10:00:00' WHEN 1 THEN '2024-07-05 10:00:00' WHEN 2 THEN '2024-03-01 00:00:00' END AS published,
  CASE page_id % 6 WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Bo Ray' WHEN 2 THEN 'Dee Hill' WHEN 5 THEN 'Eve Moss' END AS author,
  CASE page_id % 6 WHEN 0 THEN 'About ' || {ID} WHEN 1 THEN 'Long body ' || {ID} END AS description FROM pages""",
)
def jsonld_extract(spark, sf):
    found = ex.jsonld_record(marked_pages(spark, sf))
    return found.select(
        "page_id", F.col("ld_title").alias("title"),
        F.date_format("ld_published", "yyyy-MM-dd HH:mm:ss").alias("published"),
        F.col("ld_author").alias("author"), F.col("ld_description").alias("description"),
    )


@query(
    "jsonld_article",
    f"""SELECT page_id, url, CASE page_id % 6 WHEN 0 THEN 'Story ' || {ID} WHEN 1 THEN 'Item ' || {ID} WHEN 5 THEN 'Second ' || {ID} END AS title,
  CASE page_id % 6 WHEN 0 THEN 'About ' || {ID} END AS description,
  CASE page_id % 6 WHEN 0 THEN '2024-01-05T10:00:00Z' WHEN 5 THEN 'junk' END AS published_time,
  CASE page_id % 6 WHEN 0 THEN '2024-01-06T00:00:00Z' END AS updated_time,
  CASE page_id % 6 WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Bo Ray, Cy Fox' WHEN 5 THEN 'Eve Moss, Gil Park' END AS author,
  CASE page_id % 6 WHEN 0 THEN 'Body ' || {ID} WHEN 1 THEN 'Long body ' || {ID} ELSE nullif(array_to_string({paragraphs_sql(ARTICLE)}, chr(10)), '') END AS content
FROM pages""",
)
def jsonld_article(spark, sf):
    return ex.jsonld_article(marked_pages(spark, sf))


@query(
    "page_fallbacks",
    "SELECT page_id, 'HalIves' AS byline, '2024-04-0' || CAST(1 + page_id % 9 AS STRING) AS published FROM pages",
)
def page_fallbacks(spark, sf):
    walked = table(spark, sf, "pages").select("page_id", pg.fallbacks(F.expr(TIMED)).alias("w"))
    return walked.select("page_id", F.col("w.byline").alias("byline"), F.get("w.times", F.lit(0)).alias("published"))


RECORDS_SQL = f"""records AS (
  SELECT page_id, url, coalesce(CASE page_id % 6 WHEN 0 THEN 'Story ' || {ID} WHEN 1 THEN 'Item ' || {ID} WHEN 2 THEN 'Graph ' || {ID}
      WHEN 5 THEN 'Second ' || {ID} WHEN 4 THEN 'Meta ' || {ID} END, {TITLE}) AS title,
    CASE page_id % 6 WHEN 0 THEN TIMESTAMP '2024-01-05 10:00:00' WHEN 1 THEN TIMESTAMP '2024-07-05 10:00:00' WHEN 2 THEN TIMESTAMP '2024-03-01 00:00:00'
      WHEN 3 THEN TIMESTAMP '2024-02-02 00:00:00' WHEN 4 THEN TIMESTAMP '2024-06-01 06:00:00' END AS ts,
    CASE page_id % 6 WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Bo Ray' WHEN 2 THEN 'Dee Hill' WHEN 5 THEN 'Eve Moss' WHEN 4 THEN 'Fay Gold' END AS author,
    CASE page_id % 6 WHEN 0 THEN 'About ' || {ID} WHEN 1 THEN 'Long body ' || {ID} WHEN 4 THEN 'Told ' || {ID}
      ELSE nullif(left(array_to_string({paragraphs_sql(ARTICLE)}[1:5], ' '), 800), '') END AS description,
    array_to_string({paragraphs_sql(unscripted("html"))}, ' ') AS content FROM pages)"""


@query(
    "page_record",
    f"""WITH {RECORDS_SQL} SELECT page_id, url, title, strftime(ts, '%Y-%m-%d %H:%M:%S') AS published_at, author, description, content,
  CASE WHEN ts IS NULL THEN 'no date' WHEN content = '' THEN 'no title or content' END AS error,
  CASE WHEN ts IS NULL OR content = '' THEN 'failed' ELSE 'ok' END AS status FROM records""",
)
def page_record(spark, sf):
    records = ex.page_records(marked_pages(spark, sf))
    return records.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "enrich_articles",
    f"""WITH {RECORDS_SQL}, {nw.ARTICLES_SQL},
good AS (SELECT page_id, title AS t, author AS a, description AS d, {shown("timezone('UTC', ts)")} AS p FROM records WHERE ts IS NOT NULL AND content <> '')
SELECT pos, page_id, source, coalesce(t, title) AS title, coalesce(p, nullif(published, ''), '2024-12-31 10:30:00 AM EST') AS published_at,
  CASE WHEN p IS NULL THEN 'Unknown' ELSE coalesce(a, '') END AS author, CASE WHEN p IS NULL THEN title ELSE coalesce(d, '') END AS description,
  CASE WHEN p IS NULL THEN 'fast_fallback' ELSE 'tier1_http' END AS time_tier FROM articles LEFT JOIN good USING (page_id)""",
)
def enrich_articles(spark, sf):
    feed = nw.articles(spark, sf).select("pos", "page_id", "source", "title", "published")
    return ex.enrich(feed, ex.page_records(marked_pages(spark, sf)), "2024-12-31 10:30:00 AM EST")


LINKED = f"""replace(html, '</nav>', '<a href="/news/articles/c' || CAST(page_id AS STRING) || '">a</a><a class="x" href={Q}//www.bbc.com/news/articles/d1?at=1{Q}>b</a><a href="https://www.cnn.com/2024/01/02/world/s' || CAST(page_id AS STRING) || '">c</a><a href=more>d</a><a name="top">e</a></nav>')"""


LINKS_SQL = f"""WITH h AS (SELECT page_id, url, unnest(list_distinct(list_transform(
  regexp_extract_all({LINKED}, '(?i)<a(?:\\s[^>]*?)?\\shref=("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), lambda h: trim(h, chr(34) || chr(39))))) AS href FROM pages),
l AS (SELECT DISTINCT page_id, CASE WHEN href LIKE 'http%:%' THEN href WHEN href LIKE '//%' THEN split_part(url, ':', 1) || ':' || href
  WHEN href LIKE '/%' THEN split_part(url, ':', 1) || '://' || {HOST} || href
  WHEN href = '' OR href LIKE '#%' OR href LIKE '?%' THEN regexp_replace(url, '[?#].*$', '') || href
  ELSE split_part(url, ':', 1) || '://' || {HOST} || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') || href END AS link FROM h)
SELECT page_id, link, contains(link, 'bbc.com') AND contains(link, '/news/') AND contains(link, '/articles/') AS section_article,
  regexp_matches(link, '^https://www\\.cnn\\.com/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/[^/]+/[^/?#]+') AS dated_article FROM l"""


@query("page_links", LINKS_SQL)
def page_links(spark, sf):
    return ex.page_links(table(spark, sf, "pages").select("page_id", "url", F.expr(LINKED).alias("html")))


@query("first_links", f"SELECT DISTINCT link FROM ({LINKS_SQL}) ORDER BY link LIMIT 50")
def first_links(spark, sf):
    """The first 50 of the sorted distinct links: the report is the limit."""
    return ex.first_links(page_links(spark, sf), 50)


@query(
    "feed_fields",
    f"""WITH {nw.ARTICLES_SQL} SELECT pos, title, CASE WHEN pos % 3 = 1 THEN '17' ELSE published END AS published,
  CASE pos % 3 WHEN 0 THEN url WHEN 1 THEN '' ELSE url || '/f' END AS link FROM articles WHERE title <> '' AND published <> ''""",
)
def feed_fields(spark, sf):
    """Items in three shapes: nested with a canonical url, nested without one, flat."""
    nested = F.to_json(F.struct(F.struct("title", F.col("published").alias("pubDate"), F.struct("url").alias("canonicalUrl")).alias("content")))
    bare = F.to_json(F.struct(F.struct("title").alias("content"), F.lit(17).alias("providerPublishTime")))
    flat = F.to_json(F.struct("title", F.col("published").alias("pubDate"), F.concat("url", F.lit("/f")).alias("link")))
    third = F.col("pos") % 3
    body = F.when(third == 0, nested).when(third == 1, bare).otherwise(flat)
    items = nw.articles(spark, sf).where("title <> '' AND published <> ''").select("pos", body.alias("body"))
    return ex.feed_fields(items, "body")


# ---- sources and sinks ----------------------------------------------------


@query("scan_csv_roundtrip", f"WITH {nw.DOCS_SQL} SELECT pos, source, title, author, text FROM docs")
def scan_csv_roundtrip(spark, sf):
    """Articles with quotes, commas and line breaks through a CSV folder and back."""
    columns = ["pos", "source", "title", "author", "text"]
    folder = fl.write_csv(nw.docs(spark, sf), fl.scratch_folder(spark, "csv"), columns)
    return fl.read_csv(spark, folder, "pos bigint, source string, title string, author string, text string")


@query(
    "scan_keyed_files",
    f"WITH {BARS_SQL} SELECT ticker, dt, round(close, 6) AS close FROM bars",
)
def scan_keyed_files(spark, sf):
    """Bars written to one folder per ticker; the ticker is read back from the path."""
    daily = rounded(bars(spark, sf).select("ticker", "dt", "close"), "close")
    folder = fl.write_csv(daily, fl.scratch_folder(spark, "bars"), ["dt", "close"], partition="ticker")
    return fl.read_keyed_csv(spark, folder, "dt date, close double")


@query(
    "scan_url_list",
    """WITH e(page_id, nth, url) AS (SELECT page_id, 0, url FROM pages UNION ALL SELECT page_id, 2, url FROM pages
  UNION ALL SELECT page_id, 3, regexp_replace(url, '[?#].*$', '') FROM pages)
SELECT page_id, CAST(nth AS INTEGER) AS "at", url FROM e QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, nth) = 1""",
)
def scan_url_list(spark, sf):
    arrays = table(spark, sf, "pages").select(
        "page_id",
        F.to_json(F.array("url", F.lit(" "), F.concat(F.lit(" "), "url"), F.regexp_replace("url", "[?#].*$", ""))).alias("body"),
    )
    return fl.read_url_list(arrays, "body", ["page_id"]).select("page_id", "at", "url")


@query(
    "scan_source_list",
    """SELECT doc_id, CAST(i AS INTEGER) AS "at", CASE i WHEN 0 THEN source ELSE lang END AS source FROM documents, (SELECT unnest([0, 1]) AS i)""",
)
def scan_source_list(spark, sf):
    """Three JSON shapes of a source list, by document."""
    counted = F.array(*[F.struct(F.col(c).alias("source"), F.lit(1).alias("count")) for c in ("source", "lang")])
    keyed = F.concat(F.lit('{"'), "source", F.lit('":1,"'), "lang", F.lit('":2}'))
    shape = F.col("doc_id") % 3
    body = F.when(shape == 0, F.to_json(F.array("source", "lang"))).when(shape == 1, F.to_json(counted)).otherwise(keyed)
    return fl.read_source_list(table(spark, sf, "documents").select("doc_id", body.alias("body")), "body")


@query(
    "flatten_snapshot",
    f"""WITH {nw.ARTICLES_SQL} SELECT pos, source, title, CASE pos % 3 WHEN 0 THEN url WHEN 1 THEN url || '/l' ELSE url || '/g' END AS url FROM articles
UNION ALL SELECT pos, lang, text, url FROM articles""",
)
def flatten_snapshot(spark, sf):
    """Snapshots with two sources each, the url in one of three places."""
    third = F.col("pos") % 3
    blank = F.lit("")
    first = F.struct(
        "title",
        F.when(third == 0, F.col("url")).otherwise(blank).alias("decoded_url"),
        F.when(third == 1, F.concat("url", F.lit("/l"))).otherwise(blank).alias("link"),
        F.concat("url", F.lit("/g")).alias("google_link"),
    )
    second = F.struct(F.col("text").alias("title"), F.col("url").alias("link"))
    source_map = F.concat(
        F.lit('{"metadata":{"total_articles":2},"articles":{"'), "source", F.lit('":['), F.to_json(first), F.lit('],"'), "lang", F.lit('":['), F.to_json(second), F.lit("]}}"),
    )
    snapshots = nw.articles(spark, sf).select("pos", source_map.alias("body"))
    return fl.flatten_snapshot(snapshots, "body", ["pos"]).select("pos", "source", "title", "url")


@query(
    "export_metadata",
    f"WITH {nw.DOCS_SQL} SELECT count(*) AS total_articles, '2024-12-31 15:30:00' AS generated_at, '1.0' AS format_version FROM docs",
)
def export_metadata(spark, sf):
    return fl.export_metadata(nw.docs(spark, sf), "2024-12-31 15:30:00")


@query(
    "inline_rows",
    f"""WITH {nw.DOCS_SQL}, u(ticker) AS (VALUES {", ".join(f"('{s}')" for s in lx.SYMBOLS)}),
linked AS (SELECT {LINK} AS ticker FROM docs)
SELECT u.ticker, count(linked.ticker) AS n_headlines FROM u LEFT JOIN linked USING (ticker) GROUP BY u.ticker""",
)
def inline_rows(spark, sf):
    """The inline ticker universe with the number of linked headlines of each."""
    universe = spark.createDataFrame([(s,) for s in lx.SYMBOLS], "ticker string")
    linked = nw.docs(spark, sf).select(lx.link_company(F.col("headline")).alias("ticker"))
    counts = linked.where("ticker IS NOT NULL").groupBy("ticker").agg(F.count("*").alias("n_headlines"))
    return universe.join(counts, "ticker", "left").fillna({"n_headlines": 0})


@query("percent_string", "SELECT p_partkey, CAST((p_size / 100.0::DOUBLE) * 100 AS VARCHAR) || '%' AS percentage FROM part")
def percent_string(spark, sf):
    share = (F.col("p_size").cast("double") / 100) * 100
    return table(spark, sf, "part").select("p_partkey", F.concat(share.cast("string"), F.lit("%")).alias("percentage"))
