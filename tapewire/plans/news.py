"""Queries over news rows: text, urls, dates, cleaning, dedup, joins with bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewire.functions import lexicon as lx
from tapewire.functions import text as tx
from tapewire.functions import times as tm
from tapewire.functions import urls as ur
from tapewire.functions.numeric import rounded
from tapewire.operators import dedup as dd
from tapewire.operators import ordering as od
from tapewire.operators import quality as ql
from tapewire.operators import timeseries as ts
from tapewire.plans.bars import MARKET_SQL, round_sql
from tapewire.plans.registry import query
from tapewire.sources import news as nw
from tapewire.sources.tables import BARS_SQL, bars, table

AS_OF = "2024-12-31 15:30:00"


def sq(expr: str) -> str:
    """Collapse whitespace and trim, as SQL."""
    return f"trim(regexp_replace({expr}, '\\s+', ' ', 'g'))"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def basic(expr: str) -> str:
    for entity, char in tx.BASIC_ENTITIES.items():
        quoted = char.replace("'", "''")
        expr = f"replace({expr}, '{entity}', '{quoted}')"
    return expr


def words_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '\\s+'), lambda w: w <> '')"


ALNUM = sq(
    "regexp_replace(regexp_replace(regexp_replace(lower(text), 'http\\S+|www\\S+', ' ', 'g'), '\\S+@\\S+', ' ', 'g'),"
    " '[^a-z0-9\\s]', ' ', 'g')"
)
LETTERS = sq("regexp_replace(regexp_replace(lower(text), 'http\\S+|www\\S+', ' ', 'g'), '[^a-z\\s]', ' ', 'g')")
SIMPLE = sq("regexp_replace(lower(text), '[^a-z\\s]', ' ', 'g')")


def text_of(spark, sf, **columns):
    return table(spark, sf, "documents").select("doc_id", *[c.alias(n) for n, c in columns.items()])


@query("clean_title_letters", f"SELECT doc_id, {LETTERS} AS cleaned FROM documents")
def clean_title_letters(spark, sf):
    return text_of(spark, sf, cleaned=tx.letters_only(F.col("text")))


@query("clean_title_alnum", f"SELECT doc_id, {ALNUM} AS cleaned FROM documents")
def clean_title_alnum(spark, sf):
    return text_of(spark, sf, cleaned=tx.letters_digits(F.col("text")))


@query("clean_title_simple", f"SELECT doc_id, {SIMPLE} AS cleaned FROM documents")
def clean_title_simple(spark, sf):
    return text_of(spark, sf, cleaned=tx.letters_simple(F.col("text")))


def headline_sql(expr: str) -> str:
    brand = "(?i)\\s*[-|–—:]\\s*(" + "|".join(tx.BRANDS) + ")\\s*$"
    name = "(?i)\\s*[-|–—]\\s*[A-Z][a-zA-Z0-9\\s.]{2,25}$"
    first = strip(f"regexp_replace({strip(basic(expr))}, '{brand}', '')")
    return sq(strip(f"regexp_replace({first}, '{name}', '')"))


def author_sql(author: str, source: str) -> str:
    text = strip(f"regexp_replace({strip(basic(author))}, '(?i)^(by|written by|author|posted by)[:\\s]+', '')")
    junk = "(?i)^https?://|www\\.|@[\\p{L}\\p{N}_]+|^[0-9]+$|^admin$|^staff$|^contributor$|^editor$|^newsroom$|^editorial team$|^unknown$"
    return f"""CASE WHEN NOT regexp_matches({text}, '{junk}') AND length({sq(text)}) >= 2 THEN {sq(text)}
  WHEN coalesce({source}, '') = '' THEN 'Unknown' ELSE {source} || ' Staff' END"""


def description_sql(text: str, title: str) -> str:
    plain = f"regexp_replace(regexp_replace({basic(text)}, '<[^>]+>', ' ', 'g'), 'https?://\\S+', '', 'g')"
    return f"coalesce(nullif({sq(f'''replace(replace({plain}, '&nbsp;', ' '), chr(160), ' ')''')}, ''), {title})"


@query("clean_headline", f"WITH {nw.DOCS_SQL} SELECT doc_id, {headline_sql('branded')} AS title FROM docs")
def clean_headline(spark, sf):
    return nw.docs(spark, sf).select("doc_id", tx.headline(F.col("branded")).alias("title"))


@query("clean_author", f"WITH {nw.DOCS_SQL} SELECT doc_id, {author_sql('author', 'source')} AS author FROM docs")
def clean_author(spark, sf):
    return nw.docs(spark, sf).select("doc_id", tx.author_name(F.col("author"), F.col("source")).alias("author"))


@query("clean_description", f"WITH {nw.DOCS_SQL} SELECT doc_id, {description_sql('summary', 'title')} AS summary FROM docs")
def clean_description(spark, sf):
    return nw.docs(spark, sf).select("doc_id", tx.description(F.col("summary"), F.col("title")).alias("summary"))


@query("html_unescape", f"WITH {nw.DOCS_SQL} SELECT doc_id, {basic('summary')} AS plain FROM docs")
def html_unescape(spark, sf):
    plain = F.replace(tx.unescape_html(F.col("summary")), F.lit("\u00a0"), F.lit(" "))
    return nw.docs(spark, sf).select("doc_id", plain.alias("plain"))


BROKEN = "CASE WHEN lang = 'fr' THEN replace(replace(text, 'é', 'Ã©'), 'ê', 'Ãª') ELSE text END"
LATIN = """try(decode(unhex(array_to_string(list_transform(str_split(t, ''), lambda c: printf('%02x', ord(c))), ''))))"""


@query(
    "fix_mojibake",
    f"""WITH b AS (SELECT doc_id, {BROKEN} AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_full_match(t, '[\\x{{00}}-\\x{{ff}}]*') THEN coalesce({LATIN}, t) ELSE t END AS fixed FROM b""",
)
def fix_mojibake(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.fix_mojibake(F.expr(BROKEN)).alias("fixed"))


@query(
    "text_counts",
    f"SELECT doc_id, CAST(len({words_sql('text')}) AS INTEGER) AS word_count, CAST(length(text) AS INTEGER) AS char_count FROM documents",
)
def text_counts(spark, sf):
    return text_of(spark, sf, word_count=tx.word_count(F.col("text")), char_count=F.char_length("text"))


@query(
    "title_features",
    f"""WITH f AS (SELECT doc_id, length(text) AS title_length, len({words_sql("text")}) AS word_count,
  len(list_distinct({words_sql(ALNUM)})) AS unique_words, len(regexp_extract_all(text, '[0-9]')) AS digit_count FROM documents)
SELECT doc_id, CAST(title_length AS INTEGER) AS title_length, CAST(word_count AS INTEGER) AS word_count,
  CAST(unique_words AS INTEGER) AS unique_words, CAST(digit_count AS INTEGER) AS digit_count,
  round(unique_words / CASE WHEN word_count = 0 THEN 1 ELSE word_count END, 6) AS unique_ratio FROM f""",
)
def title_features(spark, sf):
    return rounded(text_of(spark, sf, **tx.title_features(F.col("text"))), "unique_ratio")


@query(
    "word_freq_top",
    f"""SELECT term, count(*) AS n FROM (SELECT unnest({words_sql(SIMPLE)}) AS term FROM documents)
GROUP BY term ORDER BY n DESC, term LIMIT 15""",
)
def word_freq_top(spark, sf):
    terms = table(spark, sf, "documents").select(F.explode(tx.words(tx.letters_simple(F.col("text")))).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(15)


def in_list(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


MOOD_SQL = f"""{nw.DOCS_SQL},
hits AS (SELECT doc_id, headline,
  len(list_filter(regexp_extract_all(lower(headline), '[a-z'']+'), lambda w: w IN ({in_list(lx.POSITIVE)}))) AS p,
  len(list_filter(regexp_extract_all(lower(headline), '[a-z'']+'), lambda w: w IN ({in_list(lx.NEGATIVE)}))) AS q FROM docs),
moods AS (SELECT doc_id, headline, CASE WHEN p + q = 0 THEN 0.0 ELSE (p - q) / (p + q) END AS score FROM hits)"""


@query("sentiment_score", f"WITH {MOOD_SQL} SELECT doc_id, round(score, 6) AS sentiment FROM moods")
def sentiment_score(spark, sf):
    return nw.docs(spark, sf).select("doc_id", F.round(lx.sentiment(F.col("headline")), 6).alias("sentiment"))


@query(
    "sentiment_dist",
    f"""WITH {MOOD_SQL} SELECT doc_id, round(CASE WHEN score < 0 THEN -score ELSE 0 END, 6) AS crash,
  round(1 - abs(score), 6) AS neutral, round(CASE WHEN score > 0 THEN score ELSE 0 END, 6) AS spike FROM moods""",
)
def sentiment_dist(spark, sf):
    scored = nw.docs(spark, sf).select("doc_id", lx.sentiment(F.col("headline")).alias("s"))
    parts = {n: F.round(c, 6).alias(n) for n, c in lx.sentiment_parts(F.col("s")).items()}
    return scored.select("doc_id", *parts.values())


EDGE = "[^\\p{L}\\p{N}_]"
LINK = (
    "CASE "
    + " ".join(
        f"WHEN regexp_matches(lower(headline), '(^|{EDGE}){a.replace('.', '[.]')}($|{EDGE})') THEN '{t}'" for a, t in lx.ALIASES.items()
    )
    + f""" ELSE list_filter(list_transform(regexp_extract_all(headline, '\\$?[A-Z]{{2,5}}'), lambda t: ltrim(t, '$')),
  lambda t: t IN ({in_list(lx.SYMBOLS)}))[1] END"""
)


@query("link_entity", f"WITH {nw.DOCS_SQL} SELECT doc_id, {LINK} AS ticker FROM docs")
def link_entity(spark, sf):
    return nw.docs(spark, sf).select("doc_id", lx.link_company(F.col("headline")).alias("ticker"))


BLEND = {
    "crash": "0.65 * 0.2 + 0.35 * greatest(-score, 0)",
    "neutral": "0.65 * 0.5 + 0.35 * (1 - abs(score))",
    "spike": "0.65 * 0.3 + 0.35 * greatest(score, 0)",
}


@query(
    "blend_argmax",
    f"""WITH {MOOD_SQL}, b AS (SELECT doc_id, {", ".join(f"{e} AS {n}" for n, e in BLEND.items())} FROM moods),
r AS (SELECT doc_id, {", ".join(f"round({n} / (crash + neutral + spike), 3) AS {n}" for n in BLEND)} FROM b)
SELECT doc_id, crash, neutral, spike, CASE WHEN crash >= neutral AND crash >= spike THEN 'crash'
  WHEN neutral >= spike THEN 'neutral' ELSE 'spike' END AS call FROM r""",
)
def blend_argmax(spark, sf):
    scored = nw.docs(spark, sf).select("doc_id", lx.sentiment(F.col("headline")).alias("s"))
    model = {"crash": F.lit(0.2), "neutral": F.lit(0.5), "spike": F.lit(0.3)}
    mixed = lx.blend(model, lx.sentiment_parts(F.col("s")))
    table_ = scored.select("doc_id", *[c.alias(n) for n, c in mixed.items()])
    return table_.withColumn("call", lx.top_label({n: F.col(n) for n in lx.LABELS}))


# ---- urls -----------------------------------------------------------------

SCHEME = "lower(regexp_extract(trim(url), '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)', 2))"
HOST = "lower(regexp_extract(trim(url), '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)', 4))"
PATH = "regexp_extract(trim(url), '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)', 5)"
VALID = "regexp_matches(lower(trim(url)), '^https?://[^/?#]+')"
CANON = f"""CASE WHEN {SCHEME} = '' THEN '' ELSE {SCHEME} || ':' END || CASE WHEN {HOST} = '' THEN '' ELSE '//' || {HOST} END
  || rtrim({PATH}, '/')"""


def of_links(spark, sf, **columns):
    return nw.links(spark, sf).select("pos", "url", *[c.alias(n) for n, c in columns.items()])


@query("url_valid", f"WITH {nw.LINKS_SQL} SELECT pos, url, {VALID} AS valid FROM links")
def url_valid(spark, sf):
    return of_links(spark, sf, valid=ur.is_valid(F.col("url")))


@query(
    "url_classify",
    f"""WITH {nw.LINKS_SQL} SELECT pos, url, CASE WHEN row_number() OVER (PARTITION BY url ORDER BY pos) > 1 THEN 'duplicate'
  WHEN {VALID} THEN 'clean' ELSE 'invalid' END AS class FROM links""",
)
def url_classify(spark, sf):
    marked = dd.mark_repeats(nw.links(spark, sf), "url", "pos")
    kind = F.when(F.col("repeat"), "duplicate").when(ur.is_valid(F.col("url")), "clean").otherwise("invalid")
    return marked.select("pos", "url", kind.alias("class"))


@query("url_canonical", f"WITH {nw.LINKS_SQL} SELECT pos, url, {CANON} AS canonical FROM links")
def url_canonical(spark, sf):
    return of_links(spark, sf, canonical=ur.canonical(F.col("url")))


@query("url_strip_query", f"WITH {nw.LINKS_SQL} SELECT pos, url, regexp_replace(url, '[?#].*$', '') AS bare FROM links")
def url_strip_query(spark, sf):
    return of_links(spark, sf, bare=ur.without_query(F.col("url")))


@query(
    "url_source",
    f"""WITH {nw.LINKS_SQL} SELECT pos, url, CASE WHEN contains({HOST}, 'bbc.') THEN 'BBC' WHEN contains({HOST}, 'cnn.') THEN 'CNN'
  ELSE 'Other' END AS site FROM links""",
)
def url_source(spark, sf):
    return of_links(spark, sf, site=ur.site(F.col("url")))


@query("url_domain", f"WITH {nw.LINKS_SQL} SELECT pos, url, regexp_replace({HOST}, '^www\\.', '') AS domain FROM links")
def url_domain(spark, sf):
    return of_links(spark, sf, domain=ur.domain(F.col("url")))


@query(
    "article_id",
    f"WITH {nw.LINKS_SQL} SELECT pos, url, list_extract(str_split(rtrim(regexp_replace(url, '[?#].*$', ''), '/'), '/'), -1) AS article_id FROM links",
)
def article_id(spark, sf):
    return of_links(spark, sf, article_id=ur.article_id(F.col("url")))


@query(
    "route_paywalled",
    f"""WITH {nw.LINKS_SQL}, d AS (SELECT pos, url, regexp_replace({HOST}, '^www\\.', '') AS domain FROM links)
SELECT pos, url, {" OR ".join("contains(domain, '" + p.replace("'", "''") + "')" for p in ur.PAYWALLED)} AS paywalled FROM d""",
)
def route_paywalled(spark, sf):
    return of_links(spark, sf, paywalled=ur.is_paywalled(ur.domain(F.col("url")), F.lit("")))


@query(
    "feed_url",
    """SELECT DISTINCT source, 'https://news.google.com/rss/search?q=' || replace(url_encode(source || ' news/markets after:2021-01-01 before:2026-12-31'),
  '%2F', '/') || '&hl=en-US&gl=US&ceid=US:en' AS feed FROM documents""",
)
def feed_url(spark, sf):
    sources = table(spark, sf, "documents").select("source").distinct()
    wanted = F.concat("source", F.lit(" news/markets"))
    return sources.select("source", ur.feed_query(wanted, "2021-01-01", "2026-12-31").alias("feed"))


# ---- dates ----------------------------------------------------------------

FIXED = """regexp_replace(trim(published), '([+-][0-9]{2})([0-9]{2})$', '\\1:\\2')"""
PARSED = f"""coalesce(try_strptime({FIXED}, '%Y-%m-%dT%H:%M:%SZ') AT TIME ZONE 'UTC', try_strptime({FIXED}, '%Y-%m-%dT%H:%M:%S%z'),
  try_strptime({FIXED}, '%Y-%m-%d %H:%M:%S') AT TIME ZONE 'UTC', try_strptime({FIXED}, '%Y-%m-%d') AT TIME ZONE 'UTC')"""
SPOKEN = """timezone('America/New_York', try_strptime(regexp_replace(regexp_extract(published, '[A-Z][a-z]+ [0-9]+, [0-9]{4} at [0-9]+:[0-9]{2} (AM|PM)'), ',| at', '', 'g'),
  '%b %d %Y %I:%M %p'))"""


def shown(ts_sql: str, pattern: str = "%Y-%m-%d %I:%M:%S %p") -> str:
    local = f"timezone('America/New_York', {ts_sql})"
    offset = f"epoch({local}) - epoch(timezone('UTC', {ts_sql}))"
    return f"strftime({local}, '{pattern}') || CASE WHEN {offset} = -14400 THEN ' EDT' ELSE ' EST' END"


STAMPS_SQL = f"{nw.DOCS_SQL}, stamps AS (SELECT doc_id, published, {PARSED} AS ts, coalesce({PARSED}, {SPOKEN}) AS any_ts FROM docs)"


@query("parse_ts", f"WITH {STAMPS_SQL} SELECT doc_id, strftime(timezone('UTC', ts), '%Y-%m-%d %H:%M:%S') AS utc FROM stamps")
def parse_ts(spark, sf):
    return nw.docs(spark, sf).select(
        "doc_id", F.date_format(tm.iso_timestamp(F.col("published")), "yyyy-MM-dd HH:mm:ss").alias("utc")
    )


@query("parse_ts_multi", f"WITH {STAMPS_SQL} SELECT doc_id, {shown('any_ts')} AS eastern FROM stamps")
def parse_ts_multi(spark, sf):
    return nw.docs(spark, sf).select("doc_id", tm.eastern(tm.any_timestamp(F.col("published"))).alias("eastern"))


@query("format_eastern", f"SELECT event_id, {shown('''timezone('UTC', CAST(ts AS TIMESTAMP))''')} AS eastern FROM events")
def format_eastern(spark, sf):
    return table(spark, sf, "events").select("event_id", tm.eastern(F.col("ts").cast("timestamp")).alias("eastern"))


@query(
    "split_date_time",
    f"""WITH {STAMPS_SQL}, s AS (SELECT *, coalesce(published, '') AS p, regexp_extract(coalesce(published, ''),
  '(?i)([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\s+([0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}\\s*(AM|PM)?(\\s+[A-Z]{{3,4}})?)', ['d', 't']) AS m FROM stamps)
SELECT doc_id, CASE WHEN m.d <> '' THEN m.d WHEN ts IS NOT NULL THEN strftime(timezone('America/New_York', ts), '%Y-%m-%d')
    ELSE '2024-12-31' END AS published_date,
  CASE WHEN p = '' THEN '10:30:00 AM EST' WHEN m.d <> '' THEN trim(m.t) WHEN ts IS NOT NULL THEN {shown("ts", "%I:%M:%S %p")}
    ELSE '12:00:00 PM EST' END AS published_time FROM s""",
)
def split_date_time(spark, sf):
    day, time = tm.split_display(F.col("published"), AS_OF)
    return nw.docs(spark, sf).select("doc_id", day.alias("published_date"), time.alias("published_time"))


@query(
    "epoch_or_iso_date",
    f"""WITH e AS (SELECT doc_id, {nw.EPOCH_OR_ISO} AS s FROM documents)
SELECT doc_id, coalesce(CAST(to_timestamp(try_cast(s AS BIGINT)) AT TIME ZONE 'UTC' AS DATE), try_cast(left(s, 10) AS DATE), DATE '2024-12-31') AS day FROM e""",
)
def epoch_or_iso_date(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tm.epoch_or_iso_date(F.expr(nw.EPOCH_OR_ISO), "2024-12-31").alias("day")
    )


@query(
    "rfc2822_date",
    f"""WITH e AS (SELECT doc_id, {nw.RSS_DATE} AS s FROM documents)
SELECT doc_id, CAST(timezone('UTC', try_strptime(replace(s, 'GMT', '+0000'), '%a, %d %b %Y %H:%M:%S %z')) AS DATE) AS day FROM e""",
)
def rfc2822_date(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tm.feed_date(F.expr(nw.RSS_DATE)).alias("day"))


# ---- cleaning, reports ----------------------------------------------------

RAW = ["pos", "url", "source", "title", "content", "author", "published"]
CLEAN_SQL = f"""{nw.ARTICLES_SQL},
firsts AS (SELECT *, text AS content FROM articles QUALIFY row_number() OVER (PARTITION BY url ORDER BY pos) = 1),
tidy AS (SELECT pos, {CANON} AS url, upper(trim(coalesce(source, 'UNKNOWN'))) AS source, {sq("title")} AS title, {sq("content")} AS content,
  {sq("coalesce(author, '')")} AS author, {PARSED} AS ts FROM firsts),
sized AS (SELECT *, len({words_sql("content")}) AS word_count, length(content) AS char_count FROM tidy),
clean AS (SELECT * FROM sized WHERE url <> '' AND content <> '' AND word_count >= 20
  QUALIFY row_number() OVER (PARTITION BY title, content ORDER BY pos) = 1)
"""


def raw_articles(spark, sf):
    return nw.articles(spark, sf).withColumn("content", F.col("text")).select(*RAW)


@query(
    "clean_articles",
    f"""WITH {CLEAN_SQL} SELECT pos, url, source, title, content, author, strftime(timezone('UTC', ts), '%Y-%m-%d %H:%M:%S') AS published_at,
  CAST(word_count AS INTEGER) AS word_count, CAST(char_count AS INTEGER) AS char_count FROM clean""",
)
def clean_articles(spark, sf):
    cleaned = ql.clean_articles(raw_articles(spark, sf))
    return cleaned.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "cleaning_report",
    f"""WITH {nw.ARTICLES_SQL},
f AS (SELECT row_number() OVER (PARTITION BY url ORDER BY pos) = 1 AS a, url <> '' AND {sq("text")} <> '' AS b,
  len({words_sql(sq("text"))}) >= 20 AS c, {sq("title")} AS t, {sq("text")} AS x FROM articles),
t AS (SELECT count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2, count(*) FILTER (a AND b AND c) AS n3,
  (SELECT count(*) FROM (SELECT DISTINCT t, x FROM f WHERE a AND b AND c)) AS n4 FROM f)
SELECT * FROM (SELECT 'unique_url' AS stage, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed FROM t
UNION ALL SELECT 'filled', n1, n2, n1 - n2 FROM t UNION ALL SELECT 'long_enough', n2, n3, n2 - n3 FROM t UNION ALL SELECT 'unique_text', n3, n4, n3 - n4 FROM t)""",
)
def cleaning_report(spark, sf):
    return ql.cleaning_report(raw_articles(spark, sf))


@query(
    "null_profile",
    f"""WITH {nw.ARTICLES_SQL} {" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) FILTER (trim(CAST({c} AS STRING)) = '') AS n_blank FROM articles"
    for c in ("pos", "url", "source", "title", "text", "author", "published"))}""",
)
def null_profile(spark, sf):
    return ql.null_profile(nw.articles(spark, sf).select("pos", "url", "source", "title", "text", "author", "published"))


@query(
    "duplicate_profile",
    f"""WITH {nw.ARTICLES_SQL} SELECT 'url' AS key_name, CAST(count(*) - count(DISTINCT url) AS BIGINT) AS n_duplicates FROM articles
UNION ALL SELECT 'title_content', count(*) - count(DISTINCT (title, text)) FROM articles
UNION ALL SELECT 'author', count(*) - (SELECT count(*) FROM (SELECT DISTINCT author FROM articles)) FROM articles""",
)
def duplicate_profile(spark, sf):
    keys = {"url": ["url"], "title_content": ["title", "text"], "author": ["author"]}
    return ql.duplicate_profile(nw.articles(spark, sf), keys)


@query(
    "value_counts",
    f"""WITH {nw.ARTICLES_SQL} SELECT 'lang' AS field, lang AS value, count(*) AS n FROM articles GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM articles GROUP BY source
UNION ALL SELECT 'site', CASE WHEN contains({HOST}, 'bbc.') THEN 'BBC' WHEN contains({HOST}, 'cnn.') THEN 'CNN' ELSE 'Other' END, count(*)
FROM articles GROUP BY 2""",
)
def value_counts(spark, sf):
    fields = {"lang": F.col("lang"), "source": F.col("source"), "site": ur.site(F.col("url"))}
    cells = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in fields.items()])
    rows = nw.articles(spark, sf).select(F.explode(cells).alias("c")).select("c.*")
    return rows.groupBy("field", "value").agg(F.count("*").alias("n"))


@query("drop_null_subset", f"WITH {nw.DOCS_SQL} SELECT doc_id, author, published FROM docs WHERE author IS NOT NULL AND published IS NOT NULL")
def drop_null_subset(spark, sf):
    return nw.docs(spark, sf).select("doc_id", "author", "published").dropna(subset=["author", "published"])


@query("label_encode", "SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label FROM documents")
def label_encode(spark, sf):
    """Classes in alphabetical order; the class table is one row per class."""
    from pyspark.sql import Window

    rows = table(spark, sf, "documents").select("doc_id", "lang")
    classes = rows.select("lang").distinct()
    coded = classes.withColumn("label", F.row_number().over(Window.orderBy("lang")) - 1)
    return rows.join(coded, "lang")


@query(
    "crawl_status",
    f"""WITH {nw.CRAWL_SQL} SELECT page_id, url, status_code, coalesce(status_code BETWEEN 200 AND 399, false) AS reachable,
  CASE WHEN status_code IS NULL THEN 'Timeout' WHEN status_code BETWEEN 200 AND 399 THEN '' ELSE 'HTTP ' || status_code END AS error FROM crawl""",
)
def crawl_status(spark, sf):
    return checked(spark, sf).select("page_id", "url", "status_code", "reachable", "error")


def checked(spark, sf):
    code = F.col("status_code")
    ok = F.coalesce((code >= 200) & (code < 400), F.lit(False))
    error = F.when(code.isNull(), "Timeout").when(ok, "").otherwise(F.concat(F.lit("HTTP "), code.cast("string")))
    return nw.crawl_log(spark, sf).withColumns({"reachable": ok, "error": error})


@query("crawl_retry_set", f"WITH {nw.CRAWL_SQL} SELECT page_id, url FROM crawl WHERE status_code = 429")
def crawl_retry_set(spark, sf):
    return checked(spark, sf).where(F.trim("error") == "HTTP 429").select("page_id", "url")


@query(
    "blocked_pages",
    """WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '<title>Just a Moment</title>' || html WHEN 1 THEN '' ELSE html END AS h FROM pages)
SELECT page_id, h = '' OR contains(left(lower(h), 3000), 'just a moment') OR contains(left(lower(h), 3000), 'checking your browser')
  OR contains(left(lower(h), 3000), 'cf-browser-verification') OR contains(left(lower(h), 3000), 'challenge-platform')
  OR contains(left(lower(h), 3000), 'enable javascript and cookies to continue')
  OR contains(left(lower(h), 3000), 'attention required! | cloudflare') AS blocked FROM p""",
)
def blocked_pages(spark, sf):
    from tapewire.functions.pages import is_blocked

    page = F.expr("CASE page_id % 5 WHEN 0 THEN '<title>Just a Moment</title>' || html WHEN 1 THEN '' ELSE html END")
    return table(spark, sf, "pages").select("page_id", is_blocked(page).alias("blocked"))


# ---- dedup, order, sets ---------------------------------------------------


@query(
    "dedup_keep_first",
    f"WITH {nw.ARTICLES_SQL} SELECT pos, url, title FROM articles QUALIFY row_number() OVER (PARTITION BY title, text ORDER BY pos) = 1",
)
def dedup_keep_first(spark, sf):
    return dd.keep_first(nw.articles(spark, sf), ["title", "text"], ["pos"]).select("pos", "url", "title")


@query("dedup_greedy")
def dedup_greedy(spark, sf):
    key = F.left(F.lower(tx.headline(F.col("branded"))), F.lit(60))
    rows = nw.articles(spark, sf).select("pos", "url", key.alias("title_key"))
    return dd.greedy_two_key(rows, "url", "title_key", "pos")


HISTORY_SQL = f"""{nw.NEWS_SQL},
old AS (SELECT ticker, headline AS title, doc_id AS pos, 'history' AS origin FROM news WHERE dt < DATE '1999-01-01'),
new AS (SELECT ticker, headline AS title, doc_id AS pos, 'fresh' AS origin FROM news WHERE dt >= DATE '1998-06-01'),
joined AS (SELECT *, 0 AS p FROM old UNION ALL SELECT *, 1 FROM new)
"""


def history_parts(spark, sf):
    rows = nw.news_history(spark, sf).withColumnsRenamed({"headline": "title", "doc_id": "pos"})
    keep = ["ticker", "title", "pos"]
    old = rows.where("dt < DATE '1999-01-01'").select(*keep).withColumn("origin", F.lit("history"))
    new = rows.where("dt >= DATE '1998-06-01'").select(*keep).withColumn("origin", F.lit("fresh"))
    return old, new


@query(
    "append_dedup",
    f"WITH {HISTORY_SQL} SELECT ticker, title, pos, origin FROM joined QUALIFY row_number() OVER (PARTITION BY ticker, title ORDER BY p, pos) = 1",
)
def append_dedup(spark, sf):
    return dd.append_history(*history_parts(spark, sf), ["ticker", "title"], ["pos"])


@query("sequential_id", f"WITH {nw.DOCS_SQL} SELECT row_number() OVER (ORDER BY source, pos) AS id, pos, source FROM docs")
def sequential_id(spark, sf):
    return od.sequential_id(nw.docs(spark, sf).select("source", "pos"), ["source", "pos"])


@query(
    "topk_per_group",
    f"WITH {nw.DOCS_SQL} SELECT source, pos, title FROM docs QUALIFY row_number() OVER (PARTITION BY source ORDER BY pos) <= 50",
)
def topk_per_group(spark, sf):
    return dd.top_per_group(nw.docs(spark, sf).select("source", "pos", "title"), ["source"], ["pos"], 50)


@query(
    "topup_union",
    f"""WITH {nw.ARTICLES_SQL}, a AS (SELECT source, url, pos, 0 AS s FROM articles WHERE lang = 'en' UNION ALL SELECT source, url, pos, 1 FROM articles),
u AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY s, pos) = 1)
SELECT source, url, pos FROM u QUALIFY row_number() OVER (PARTITION BY source ORDER BY s, pos) <= 50""",
)
def topup_union(spark, sf):
    rows = nw.articles(spark, sf).select("source", "url", "pos", "lang")
    primary = rows.where("lang = 'en'").drop("lang")
    return dd.top_up(primary, rows.drop("lang"), "source", "url", "pos", 50)


@query("sort_multi", f"WITH {nw.NEWS_SQL} SELECT ticker, dt, doc_id FROM news ORDER BY ticker, dt, doc_id")
def sort_multi(spark, sf):
    return nw.news_history(spark, sf).select("ticker", "dt", "doc_id").orderBy("ticker", "dt", "doc_id")


@query(
    "preview",
    f"""WITH {nw.DOCS_SQL} SELECT * FROM ((SELECT 'head' AS side, pos, title FROM docs ORDER BY pos LIMIT 5)
UNION ALL (SELECT 'tail', pos, title FROM docs ORDER BY pos DESC LIMIT 5))""",
)
def preview(spark, sf):
    rows = nw.docs(spark, sf).select("pos", "title")
    head = rows.orderBy("pos").limit(5).withColumn("side", F.lit("head"))
    return head.unionByName(rows.orderBy(F.desc("pos")).limit(5).withColumn("side", F.lit("tail")))


@query(
    "union_sources",
    """SELECT 'document' AS origin, doc_id AS id, text, lang FROM documents UNION ALL SELECT 'benchmark', item_id, text, NULL FROM benchmark""",
)
def union_sources(spark, sf):
    left = table(spark, sf, "documents").select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text", "lang")
    right = table(spark, sf, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text")
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "resume_anti",
    f"""WITH {nw.ARTICLES_SQL}, done AS MATERIALIZED (SELECT DISTINCT source, url FROM articles WHERE lang <> 'en')
SELECT pos, source, url FROM articles ANTI JOIN done USING (source, url)""",
)
def resume_anti(spark, sf):
    rows = nw.articles(spark, sf).select("pos", "source", "url", "lang")
    return dd.unseen(rows.drop("lang"), rows.where("lang <> 'en'"), ["source", "url"])


@query(
    "resume_semi",
    f"""WITH {nw.ARTICLES_SQL}, done AS MATERIALIZED (SELECT DISTINCT source, url FROM articles WHERE lang <> 'en')
SELECT pos, source, url FROM articles SEMI JOIN done USING (source, url)""",
)
def resume_semi(spark, sf):
    rows = nw.articles(spark, sf).select("pos", "source", "url", "lang")
    return dd.seen(rows.drop("lang"), rows.where("lang <> 'en'"), ["source", "url"])


STORE_SQL = f"""{nw.ARTICLES_SQL},
existing AS (SELECT url, min(pos) AS id, 'old' AS source, 'old title' AS title, 'Old Author' AS author, '2020-01-01' AS published_date,
  '09:00:00 AM EST' AS published_time, 'old summary' AS summary FROM articles WHERE lang <> 'fr' GROUP BY url),
latest AS (SELECT url, pos AS id, source, title, coalesce(nullif(author, ''), 'Unknown') AS author, nullif(published, '') AS published_date,
  NULL AS published_time, coalesce(summary, '') AS summary FROM articles WHERE lang IN ('fr', 'de')
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY pos DESC) = 1)"""


def store(spark, sf):
    rows = nw.articles(spark, sf)
    fixed = {
        "source": "old", "title": "old title", "author": "Old Author", "published_date": "2020-01-01",
        "published_time": "09:00:00 AM EST", "summary": "old summary",
    }
    existing = rows.where("lang <> 'fr'").groupBy("url").agg(F.min("pos").alias("id"))
    existing = existing.select("url", "id", *[F.lit(v).alias(n) for n, v in fixed.items()])
    incoming = rows.where("lang IN ('fr', 'de')").select(
        "url", F.col("pos").alias("id"), "source", "title", "author", F.col("published").alias("published_date"),
        F.lit("").alias("published_time"), "summary", "pos",
    )
    return existing, incoming


@query(
    "upsert_articles",
    f"""WITH {STORE_SQL} SELECT url, coalesce(e.id, l.id) AS id, coalesce(e.source, l.source) AS source,
  {", ".join(f"CASE WHEN l.url IS NOT NULL THEN l.{c} ELSE e.{c} END AS {c}" for c in dd.UPDATED)} FROM existing e FULL JOIN latest l USING (url)""",
)
def upsert_articles(spark, sf):
    return dd.upsert(*store(spark, sf))


@query(
    "split_by_status",
    f"""WITH {nw.CRAWL_SQL} SELECT coalesce(status_code BETWEEN 200 AND 399, false) AS reachable, count(*) AS n, count(DISTINCT url) AS n_urls
FROM crawl GROUP BY 1""",
)
def split_by_status(spark, sf):
    """Two outputs of one result: written once, partitioned by outcome, counted per part."""
    from tapewire.sources.files import scratch_folder, write_split

    folder = write_split(checked(spark, sf), "reachable", scratch_folder(spark, "status"))
    rows = spark.read.parquet(folder).withColumn("reachable", F.col("reachable").cast("boolean"))
    return rows.groupBy("reachable").agg(F.count("*").alias("n"), F.countDistinct("url").alias("n_urls"))


# ---- news with bars -------------------------------------------------------

AGG_SQL = f"""{BARS_SQL}, {nw.NEWS_SQL},
scored AS (SELECT ticker, dt, len(list_filter(regexp_extract_all(lower(headline), '[a-z'']+'), lambda w: w IN ({in_list(lx.POSITIVE)}))) AS p,
  len(list_filter(regexp_extract_all(lower(headline), '[a-z'']+'), lambda w: w IN ({in_list(lx.NEGATIVE)}))) AS q FROM news),
moods AS (SELECT ticker, dt, round(CASE WHEN p + q = 0 THEN 0.0 ELSE (p - q) / (p + q) END, 2) AS sentiment FROM scored),
daily_news AS (SELECT ticker, dt, avg(sentiment) AS news_sentiment_mean, count(sentiment) AS news_count FROM moods GROUP BY ticker, dt)
"""


def scored_news(spark, sf):
    rows = nw.news_history(spark, sf)
    return rows.select("ticker", "dt", F.round(lx.sentiment(F.col("headline")), 2).alias("sentiment"))


def daily_news(spark, sf):
    return scored_news(spark, sf).groupBy("ticker", "dt").agg(
        F.avg("sentiment").alias("news_sentiment_mean"), F.count("sentiment").alias("news_count")
    )


def with_news(rows, news):
    """Left join of the daily news figures; days without news count as zero."""
    return rows.join(news, ["ticker", "dt"], "left").fillna({"news_sentiment_mean": 0.0, "news_count": 0})


@query("daily_news_agg", f"WITH {AGG_SQL} SELECT ticker, dt, round(news_sentiment_mean, 6) AS news_sentiment_mean, news_count FROM daily_news")
def daily_news_agg(spark, sf):
    return rounded(daily_news(spark, sf), "news_sentiment_mean")


@query(
    "news_price_join",
    f"""WITH {AGG_SQL} SELECT ticker, dt, round(close, 6) AS close, round(coalesce(news_sentiment_mean, 0), 6) AS news_sentiment_mean,
  coalesce(news_count, 0) AS news_count FROM bars LEFT JOIN daily_news USING (ticker, dt)""",
)
def news_price_join(spark, sf):
    joined = with_news(bars(spark, sf).select("ticker", "dt", "close"), daily_news(spark, sf))
    return rounded(joined, "close", "news_sentiment_mean")


@query(
    "coverage_share",
    f"""WITH {AGG_SQL} SELECT count(*) AS n_rows, count(news_count) AS n_covered, round(avg(CASE WHEN news_count > 0 THEN 1.0 ELSE 0 END), 6) AS share
FROM bars LEFT JOIN daily_news USING (ticker, dt)""",
)
def coverage_share(spark, sf):
    covered = F.col("news_count") > 0
    joined = with_news(bars(spark, sf).select("ticker", "dt"), daily_news(spark, sf))
    share = F.round(F.avg(covered.cast("int")), 6)
    return joined.agg(F.count("*").alias("n_rows"), F.count_if(covered).alias("n_covered"), share.alias("share"))


@query(
    "training_dataset",
    f"""WITH {AGG_SQL}, {MARKET_SQL}, ahead AS (SELECT ticker, dt, lead(close) OVER (PARTITION BY ticker ORDER BY dt) / nullif(close, 0) - 1 AS r FROM bars)
SELECT ticker, dt, {round_sql(*ts.MARKET_FEATURES)}, round(coalesce(news_sentiment_mean, 0), 6) AS news_sentiment_mean,
  coalesce(news_count, 0) AS news_count, CASE WHEN r > 0.015 THEN 'spike' WHEN r < -0.015 THEN 'crash' ELSE 'neutral' END AS label
FROM market JOIN ahead USING (ticker, dt) LEFT JOIN daily_news USING (ticker, dt) WHERE r IS NOT NULL""",
)
def training_dataset(spark, sf):
    return rounded(training_rows(spark, sf), *ts.MARKET_FEATURES, "news_sentiment_mean")


def training_rows(spark, sf):
    """Features, label and news of each labelled day; label and features share the ticker exchange."""
    daily = bars(spark, sf)
    labels = ts.next_day_label(daily).select("ticker", "dt", "label")
    return with_news(ts.market_features(daily).join(labels, ["ticker", "dt"]), daily_news(spark, sf))


@query(
    "news_window_join",
    f"""WITH {AGG_SQL} SELECT b.ticker, b.dt, round(coalesce(avg(sentiment), 0), 3) AS sentiment_7d, count(sentiment) AS count_7d
FROM bars b LEFT JOIN moods m ON m.ticker = b.ticker AND m.dt BETWEEN b.dt - INTERVAL 7 DAY AND b.dt GROUP BY b.ticker, b.dt""",
)
def news_window_join(spark, sf):
    """Headlines of the trailing seven days for every bar.

    Headlines are summed per ticker and day first; a time-range window over bars
    and news days of a ticker then replaces a range join.
    """
    from pyspark.sql import Window

    sums = scored_news(spark, sf).groupBy("ticker", "dt").agg(F.sum("sentiment").alias("s"), F.count("sentiment").alias("n"))
    days = bars(spark, sf).select("ticker", "dt", F.lit(True).alias("bar")).join(sums, ["ticker", "dt"], "full_outer")
    day_number = F.datediff("dt", F.lit("1970-01-01").cast("date"))
    week = Window.partitionBy("ticker").orderBy("day").rangeBetween(-7, 0)
    rolled = days.withColumn("day", day_number).select(
        "ticker", "dt", "bar",
        F.coalesce(F.sum("n").over(week), F.lit(0)).alias("count_7d"),
        F.sum("s").over(week).alias("total"),
    )
    mean = F.round(F.coalesce(F.col("total") / F.nullif("count_7d", F.lit(0)), F.lit(0.0)), 3)
    return rolled.where("bar").select("ticker", "dt", mean.alias("sentiment_7d"), "count_7d")
