"""URL checks and rewriting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Site labels, article path patterns, names of paywalled sources.
SITES = {"bbc.": "BBC", "cnn.": "CNN"}
DATED_ARTICLE = r"^https://www\.cnn\.com/[0-9]{4}/[0-9]{2}/[0-9]{2}/[^/]+/[^/?#]+"
PAYWALLED = [
    "bloomberg.com", "bloomberg", "wsj.com", "wsj", "wall street journal",
    "ft.com", "financial times", "barrons.com", "barron's",
]
PARTS = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), PARTS, 2))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), PARTS, 4))


def path(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), PARTS, 5)


def is_valid(url: Column) -> Column:
    """Non-empty, http or https, with a host."""
    return F.coalesce(scheme(url).isin("http", "https") & (host(url) != ""), F.lit(False))


def canonical(url: Column) -> Column:
    """Lower scheme and host, no trailing slashes, no query, no fragment."""
    front = F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise("")
    net = F.when(host(url) != "", F.concat(F.lit("//"), host(url))).otherwise("")
    return F.concat(front, net, F.rtrim(path(url), F.lit("/")))


def without_query(url: Column) -> Column:
    return F.split_part(F.split_part(url, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))


def site(url: Column) -> Column:
    labels = [F.when(F.contains(host(url), F.lit(part)), label) for part, label in SITES.items()]
    return F.coalesce(*labels, F.lit("Other"))


def domain(url: Column) -> Column:
    """Host without a leading `www.` (the prefix, not any of its letters)."""
    return F.regexp_replace(host(url), r"^www\.", "")


def article_id(url: Column) -> Column:
    """Last non-empty path segment."""
    return F.element_at(F.split(F.rtrim(without_query(url), F.lit("/")), "/"), -1)


def without_dots(address: Column) -> Column:
    """`.` and `..` segments of the path worked off, the query left as it is."""
    head = F.regexp_extract(address, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    rest = F.substring(address, F.length(head) + 1, F.length(address))
    inner = F.regexp_extract(rest, r"^([^?#]*)", 1)
    parts = F.split(inner, "/", -1)
    folded = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept)
        .otherwise(F.array_append(kept, s)),
    )
    open_end = F.when(inner.rlike(r"/\.{1,2}$") & (F.size(folded) > 0), "/").otherwise("")
    clean = F.concat(head, F.lit("/"), F.array_join(folded, "/"), open_end, F.substring(rest, F.length(inner) + 1, F.length(rest)))
    return F.when(inner.rlike(r"/\.{1,2}(/|$)"), clean).otherwise(address)


def resolve(link: Column, base: Column) -> Column:
    """Absolute form of a link found on page `base`."""
    origin = F.concat(scheme(base), F.lit("://"), host(base))
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    joined = (
        F.when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.rlike("^[?#]") | (link == ""), F.concat(without_query(base), link))
        .otherwise(F.concat(origin, folder, link))
    )
    return F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link).otherwise(without_dots(joined))


def is_section_article(url: Column) -> Column:
    return F.contains(url, F.lit("bbc.com")) & F.contains(url, F.lit("/news/")) & F.contains(url, F.lit("/articles/"))


def is_dated_article(url: Column) -> Column:
    return url.rlike(DATED_ARTICLE) & ~F.contains(url, F.lit("/video/")) & ~F.contains(url, F.lit("/live-news/"))


def is_paywalled(domain_name: Column, source: Column) -> Column:
    """Whether the domain or the source name contains a paywalled name."""
    tests = [
        F.contains(F.lower(c), F.lit(name)) for name in PAYWALLED for c in (domain_name, F.coalesce(source, F.lit("")))
    ]
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found


def feed_query(query: Column, after: str = "", before: str = "", language: str = "en", country: str = "US") -> Column:
    """Feed search address; with both dates the query is narrowed to them."""
    if after and before:
        query = F.concat(query, F.lit(f" after:{after} before:{before}"))
    quoted = F.replace(F.replace(F.url_encode(query), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    tail = f"&hl={language}-{country}&gl={country}&ceid={country}:{language}"
    return F.concat(F.lit("https://news.google.com/rss/search?q="), quoted, F.lit(tail))
