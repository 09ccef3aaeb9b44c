"""Page checks and extraction as column expressions.

Everything with a regular shape (blocks, meta tags, titles, paragraphs, links) is
read in the JVM. Only the byline and time elements need a tag walk; that is one
small parser run in Arrow batches.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tapewire.functions.text import squeeze, unescape_basic

# Bot-wall signatures, meta keys, JSON-LD types and keys, byline marks, length limits of the method.
WALLS = [
    "just a moment", "checking your browser", "cf-browser-verification", "challenge-platform",
    "enable javascript and cookies to continue", "attention required! | cloudflare",
]
WALL_CHARS = 3000
DATE_KEYS = [
    "article:published_time", "og:published_time", "datePublished",
    "pubdate", "publish_date", "date", "DC.date.issued", "sailthru.date",
]
AUTHOR_KEYS = [
    "author", "article:author", "dc.creator", "sailthru.author", "byl",
    "twitter:creator", "parsely-author", "citation_author", "author-name",
]
DESCRIPTION_KEYS = ["og:description", "description"]
ARTICLE_TYPES = ["ReportageNewsArticle", "NewsArticle", "Article"]
LD_DATES = ["datePublished", "dateCreated", "uploadDate"]
BYLINE_CLASSES = [
    "byline", "author", "byline-author", "author-name", "c-author", "article-author", "post-author", "byline__name",
    "entry-author", "author-link",
]
SUMMARY_CHARS = 800

LD_FIELDS = [
    "`@type` string", "headline string", "datePublished string", "dateCreated string", "uploadDate string",
    "dateModified string", "author string", "description string", "articleBody string",
]
LD_NODE = "struct<" + ", ".join(f.replace(" string", ": string") for f in LD_FIELDS) + ">"
LD_ITEM = LD_NODE[:-1] + f", `@graph`: array<{LD_NODE}>>"
NAMES = [f.split()[0].strip("`") for f in LD_FIELDS]


def is_blocked(html: Column) -> Column:
    """Empty pages and pages that open with a bot wall."""
    opening = F.substring(F.lower(html), 1, WALL_CHARS)
    found = F.coalesce(html, F.lit("")) == ""
    for wall in WALLS:
        found = found | F.contains(opening, F.lit(wall))
    return found


def plain(fragment: Column) -> Column:
    """Text of an HTML fragment: tags become spaces, entities are decoded, space is collapsed."""
    return squeeze(unescape_basic(F.regexp_replace(fragment, r"<[^>]*>", " ")))


def title(html: Column) -> Column:
    return plain(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def attribute(tag: Column, names: str) -> Column:
    """Value of an attribute in double, single or no quotes, null without it; `names` are alternatives."""
    pattern = rf"""(?is)\s(?:{names})\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, form) for form in (1, 2, 3)])
    return F.when(tag.rlike(pattern), value)


def meta_tags(html: Column) -> Column:
    """(key, content) of every meta tag, in page order."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\s[^>]*>"), F.lit(0))
    return F.transform(
        tags,
        lambda t: F.struct(
            F.coalesce(attribute(t, "property|name"), F.lit("")).alias("key"),
            unescape_basic(F.coalesce(attribute(t, "content"), F.lit(""))).alias("content"),
        ),
    )


def first_filled(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(0))


def last_filled(values: Column) -> Column:
    return first_filled(F.reverse(values))


def meta_value(tags: Column, keys: list[str]) -> Column:
    """Content of the first key, in key order, that the page fills."""

    def content_of(key: str) -> Column:
        return F.get(F.filter(tags, lambda t: t["key"] == key), F.lit(0))["content"]

    return first_filled(F.array(*[content_of(k) for k in keys]))


def without_scripts(html: Column) -> Column:
    for tag in ("script", "style", "noscript"):
        html = F.regexp_replace(html, rf"(?is)<{tag}[^>]*>.*?</{tag}>", "")
    return html


def paragraphs(html: Column) -> Column:
    """Texts of the non-empty `<p>` elements; one left open ends at the next or at its parent's end."""
    pieces = F.split(html, r"(?i)<p(?:\s[^>]*)?>")
    bodies = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    texts = F.transform(bodies, lambda b: plain(F.regexp_replace(b, r"(?is)</(p|article|div|body|html)>.*$", "")))
    return F.filter(texts, lambda t: t != "")


def body_text(html: Column) -> Column:
    return F.array_join(paragraphs(without_scripts(html)), " ")


def article_block(html: Column) -> Column:
    return F.regexp_extract(without_scripts(html), r"(?is)<article[^>]*>(.*?)</article>", 1)


def article_text(html: Column) -> Column:
    return F.array_join(paragraphs(article_block(html)), "\n")


def article_summary(html: Column) -> Column:
    """First five paragraphs of the article, at most 800 characters."""
    return F.left(F.array_join(F.slice(paragraphs(article_block(html)), 1, 5), " "), F.lit(SUMMARY_CHARS))


def ld_items(html: Column) -> Column:
    """Items of all well-formed JSON-LD blocks: a block is one object or a list of them."""
    pattern = r"""(?is)<script[^>]*type=["']?application/ld\+json["']?[^>]*>(.*?)</script>"""
    blocks = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    valid = F.filter(blocks, lambda b: F.try_parse_json(b).isNotNull())
    return F.flatten(F.transform(valid, lambda b: F.from_json(b, f"array<{LD_ITEM}>")))


def ld_nodes(items: Column) -> Column:
    """Every item followed by the nodes of its graph."""
    own = lambda i: F.struct(*[i[n].alias(n) for n in NAMES])
    return F.flatten(F.transform(items, lambda i: F.concat(F.array(own(i)), F.coalesce(i["@graph"], F.array()))))


def first_author(raw: Column) -> Column:
    """Name from an author given as object, list (its first entry) or text."""
    return (
        F.when(raw.startswith("{"), F.get_json_object(raw, "$.name"))
        .when(raw.startswith("["), F.coalesce(F.get_json_object(raw, "$[0].name"), F.get_json_object(raw, "$[0]")))
        .otherwise(raw)
    )


def all_authors(raw: Column) -> Column:
    """All names of an author field, joined by commas."""
    entries = F.from_json(F.when(raw.startswith("["), raw), "array<string>")
    names = F.transform(entries, lambda e: F.when(e.startswith("{"), F.get_json_object(e, "$.name")).otherwise(e))
    joined = F.array_join(F.filter(names, lambda n: n.isNotNull() & (n != "")), ", ")
    return F.when(raw.startswith("{"), F.get_json_object(raw, "$.name")).when(raw.startswith("["), joined).otherwise(raw)


class _Fallbacks(HTMLParser):
    """Collects the `<time>` values and the text of the first byline element."""

    VOID = {"br", "img", "meta", "link", "input", "hr"}
    # Elements whose end tag may be left out: these starts, and the end of any container, close them.
    CONTAINERS = {"article", "aside", "body", "div", "dl", "footer", "header", "html", "main", "ol", "section", "table", "tr", "ul"}
    CLOSED_BY = {
        "p": CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "form", "blockquote"},
        "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    }

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.times, self.byline, self.open, self.in_time = [], None, [], False

    def is_byline(self, tag, attrs):
        named = set((attrs.get("class") or "").split()) & set(BYLINE_CLASSES)
        linked = tag == "a" and "/author/" in (attrs.get("href") or "")
        return named or linked or attrs.get("itemprop") == "author" or attrs.get("rel") == "author"

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "time":
            self.in_time = not attrs.get("datetime")
            self.times.append(attrs.get("datetime") or "")
        if tag in self.VOID:
            return
        while self.open and tag in self.CLOSED_BY.get(self.open[-1], ()):
            self.open.pop()
        if self.open:
            self.open.append(tag)
        elif self.byline is None and self.is_byline(tag, attrs):
            self.byline, self.open = "", [tag]

    def handle_endtag(self, tag):
        self.in_time = self.in_time and tag != "time"
        if tag in self.open:
            while self.open.pop() != tag:
                pass
        elif tag in self.CONTAINERS and self.open and self.open[0] in self.CLOSED_BY:
            self.open.clear()

    def handle_data(self, data):
        if self.in_time:
            self.times[-1] += data.strip()
        if self.open:
            self.byline += data.strip()


FALLBACK = (
    StructType().add("times", ArrayType(StringType())).add("byline", StringType()).add("error", StringType())
)


@F.pandas_udf(FALLBACK)
def fallbacks(html: pd.Series) -> pd.DataFrame:
    """Time values and byline per page; a page that cannot be parsed reports its error instead."""
    rows = []
    for page in html:
        parser = _Fallbacks()
        try:
            parser.feed(page or "")
            rows.append((parser.times, parser.byline, None))
        except Exception as error:
            rows.append(([], None, f"{type(error).__name__}: {error}"))
    return pd.DataFrame(rows, columns=["times", "byline", "error"])
