"""Pages to article records, and links out of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapewire.functions import pages as pg
from tapewire.functions import times as tm
from tapewire.functions import urls as ur
from tapewire.session import cut_lineage


def jsonld_record(html_pages: DataFrame) -> DataFrame:
    """First filled headline, date, author and description over all JSON-LD nodes."""
    nodes = html_pages.withColumn("nodes", pg.ld_nodes(pg.ld_items(F.col("html"))))
    node = F.col("nodes")
    dates = F.flatten(F.transform(node, lambda n: F.array(*[n[k] for k in pg.LD_DATES])))
    stamps = F.transform(dates, tm.any_timestamp)
    about = F.transform(node, lambda n: F.coalesce(F.nullif(n["description"], F.lit("")), n["articleBody"]))
    return nodes.select(
        *[c for c in html_pages.columns],
        F.trim(pg.first_filled(F.transform(node, lambda n: n["headline"]))).alias("ld_title"),
        F.get(F.filter(stamps, lambda s: s.isNotNull()), F.lit(0)).alias("ld_published"),
        pg.first_filled(F.transform(node, lambda n: pg.first_author(n["author"]))).alias("ld_author"),
        F.left(pg.first_filled(about), F.lit(pg.SUMMARY_CHARS)).alias("ld_description"),
    )


def jsonld_article(html_pages: DataFrame) -> DataFrame:
    """Fields of the article-typed items; a later item overrides, all author names are joined."""
    typed = F.filter(pg.ld_items(F.col("html")), lambda i: i["@type"].isin(pg.ARTICLE_TYPES))
    items = html_pages.withColumn("items", typed)
    field = lambda name: pg.last_filled(F.transform("items", lambda i: i[name]))
    return items.select(
        *[c for c in html_pages.columns if c != "html"],
        field("headline").alias("title"),
        field("description").alias("description"),
        field("datePublished").alias("published_time"),
        field("dateModified").alias("updated_time"),
        pg.last_filled(F.transform("items", lambda i: pg.all_authors(i["author"]))).alias("author"),
        F.coalesce(field("articleBody"), F.nullif(pg.article_text(F.col("html")), F.lit(""))).alias("content"),
    )


def page_records(html_pages: DataFrame) -> DataFrame:
    """One record per (page_id, url, html): JSON-LD, then meta tags, then elements.

    Every page gives a row. `status` is `ok`, or `failed` with the reason in
    `error`: blocked, no date, or a parse error.
    """
    base = jsonld_record(html_pages).withColumns(
        {"tags": pg.meta_tags(F.col("html")), "walk": pg.fallbacks(F.col("html")), "blocked": pg.is_blocked(F.col("html"))}
    )
    meta_dates = F.array(*[tm.any_timestamp(pg.meta_value(F.col("tags"), [k])) for k in pg.DATE_KEYS])
    element_dates = F.transform("walk.times", tm.any_timestamp)
    first = lambda values: F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))
    filled = lambda value: F.nullif(value, F.lit(""))
    found = base.select(
        "page_id", "url", "blocked", "walk.error",
        F.coalesce(filled(F.col("ld_title")), pg.meta_value(F.col("tags"), ["og:title"]), filled(pg.title(F.col("html")))).alias("title"),
        F.coalesce("ld_published", first(meta_dates), first(element_dates)).alias("published_at"),
        F.coalesce(filled(F.col("ld_author")), pg.meta_value(F.col("tags"), pg.AUTHOR_KEYS), filled(F.col("walk.byline"))).alias("author"),
        F.coalesce(
            filled(F.col("ld_description")),
            F.left(pg.meta_value(F.col("tags"), pg.DESCRIPTION_KEYS), F.lit(pg.SUMMARY_CHARS)),
            filled(pg.article_summary(F.col("html"))),
        ).alias("description"),
        pg.body_text(F.col("html")).alias("content"),
    )
    reason = (
        F.when(F.col("blocked"), "blocked page")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("published_at").isNull(), "no date")
        .when(F.col("title").isNull() | (F.col("content") == ""), "no title or content")
    )
    out = found.withColumn("error", reason).drop("blocked")
    return out.withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed"))


def enrich(feed: DataFrame, records: DataFrame, as_of: str) -> DataFrame:
    """Feed rows (pos, page_id, source, title, published) with page records, else feed values.

    The records are written before they are filtered: a filter on their status would
    parse every page again, once for each field that the status looks at.
    """
    parsed = cut_lineage(records.select("page_id", "url", "title", "author", "description", "published_at", "status"))
    good = parsed.where("status = 'ok'").select(
        "page_id", "url",
        F.col("title").alias("_title"), F.col("author").alias("_author"), F.col("description").alias("_description"),
        tm.eastern(F.col("published_at")).alias("_published"),
    )
    hit = F.col("_published").isNotNull()
    filled = lambda name: F.nullif(F.col(name), F.lit(""))
    return feed.join(good, "page_id", "left").select(
        "pos", "page_id", "source",
        F.when(hit, F.coalesce("_title", "title")).otherwise(F.col("title")).alias("title"),
        F.when(hit, F.col("_published")).otherwise(F.coalesce(filled("published"), F.lit(as_of))).alias("published_at"),
        F.when(hit, F.coalesce("_author", F.lit(""))).otherwise(F.lit("Unknown")).alias("author"),
        F.when(hit, F.coalesce("_description", F.lit(""))).otherwise(F.col("title")).alias("description"),
        F.when(hit, "tier1_http").otherwise("fast_fallback").alias("time_tier"),
    )


def page_links(html_pages: DataFrame) -> DataFrame:
    """Distinct absolute links per page with both article tests."""
    anchors = F.regexp_extract_all(F.col("html"), F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))
    hrefs = F.array_compact(F.transform(anchors, lambda a: pg.attribute(a, "href")))
    found = html_pages.select("page_id", "url", F.explode(F.array_distinct(hrefs)).alias("href"))
    link = ur.resolve(F.col("href"), F.col("url"))
    return found.select("page_id", link.alias("link")).distinct().select(
        "page_id",
        "link",
        ur.is_section_article(F.col("link")).alias("section_article"),
        ur.is_dated_article(F.col("link")).alias("dated_article"),
    )


def first_links(links: DataFrame, n: int) -> DataFrame:
    """The first `n` of the sorted distinct links; every task hands on at most `n`."""
    return links.select("link").distinct().orderBy("link").limit(n)


def feed_fields(items: DataFrame, body: str) -> DataFrame:
    """Title, time and link of feed items whose fields lie under `content` or on top.

    An item without `content` is its own content. The nested value wins where it is
    filled; the link is that of `canonicalUrl` where that is an object, else `link`.
    Items without a title go, and so does text that is not JSON.
    """
    raw = F.col(body)
    nested = F.get_json_object(raw, "$.content").isNotNull()

    def inner(name: str) -> Column:
        return F.when(nested, F.get_json_object(raw, f"$.content.{name}")).otherwise(F.get_json_object(raw, f"$.{name}"))

    def filled(*values: Column) -> Column:
        return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])

    canonical = inner("canonicalUrl")
    link = F.when(canonical.startswith("{"), inner("canonicalUrl.url")).otherwise(inner("link"))
    return items.select(
        *[c for c in items.columns if c != body],
        filled(inner("title"), F.get_json_object(raw, "$.title")).alias("title"),
        filled(inner("pubDate"), inner("providerPublishTime"), F.get_json_object(raw, "$.providerPublishTime")).alias("published"),
        F.coalesce(link, F.lit("")).alias("link"),
    ).where("title IS NOT NULL")
