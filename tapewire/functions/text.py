"""Text cleaners and counters as column expressions.

Word classes are spelt out ([\\p{L}\\p{N}_]) because \\w is ASCII in Java.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Brand names stripped from headlines, author prefixes and junk authors.
BRANDS = [
    "Reuters", "BBC", "CNN", "CNBC", "Bloomberg", "WSJ", "The Guardian", "Al Jazeera", "AP News", "Fox News",
    "The New York Times", "NPR", "Forbes", "Business Insider", "MarketWatch", "Politico", "Axios",
]
BRAND_SUFFIX = r"(?i)\s*[-|–—:]\s*(" + "|".join(BRANDS) + r")\s*$"
NAME_SUFFIX = r"(?i)\s*[-|–—]\s*[A-Z][a-zA-Z0-9\s.]{2,25}$"
AUTHOR_PREFIX = r"(?i)^(by|written by|author|posted by)[:\s]+"
JUNK_AUTHOR = (
    r"(?i)^https?://|www\.|@[\p{L}\p{N}_]+|^[0-9]+$|^admin$|^staff$"
    r"|^contributor$|^editor$|^newsroom$|^editorial team$|^unknown$"
)
BASIC_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def squeeze(text: Column) -> Column:
    """Collapse runs of whitespace and trim."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def letters_only(text: Column) -> Column:
    """Lower case, links dropped, everything but a-z and spaces blanked."""
    unlinked = F.regexp_replace(F.lower(text), r"http\S+|www\S+", " ")
    return squeeze(F.regexp_replace(unlinked, r"[^a-z\s]", " "))


def letters_digits(text: Column) -> Column:
    """Lower case, links and mail addresses dropped, everything but a-z, 0-9 and spaces blanked."""
    unlinked = F.regexp_replace(F.lower(text), r"http\S+|www\S+", " ")
    unlinked = F.regexp_replace(unlinked, r"\S+@\S+", " ")
    return squeeze(F.regexp_replace(unlinked, r"[^a-z0-9\s]", " "))


def letters_simple(text: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(text), r"[^a-z\s]", " "))


@F.pandas_udf(StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """All HTML entities, by the standard library; Arrow batches."""
    return text.map(html.unescape, na_action="ignore")


def unescape_basic(text: Column) -> Column:
    """The six common entities, without leaving the JVM; `&amp;` last, so nothing decodes twice."""
    for entity, char in BASIC_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def headline(title: Column, decode=unescape_html) -> Column:
    """Strip a trailing brand, then any trailing `- Name` of 3 to 26 characters."""
    text = strip_space(decode(F.coalesce(title, F.lit(""))))
    for suffix in (BRAND_SUFFIX, NAME_SUFFIX):
        text = strip_space(F.regexp_replace(text, suffix, ""))
    return squeeze(text)


def author_name(author: Column, source: Column, decode=unescape_html) -> Column:
    """Author without `by` prefixes; junk or too short falls back to `<source> Staff`."""
    fallback = F.when(F.coalesce(source, F.lit("")) == "", "Unknown").otherwise(F.concat(source, F.lit(" Staff")))
    text = strip_space(decode(author))
    text = strip_space(F.regexp_replace(text, AUTHOR_PREFIX, ""))
    clean = squeeze(text)
    usable = ~text.rlike(JUNK_AUTHOR) & (F.char_length(clean) >= 2)
    return F.when(usable, clean).otherwise(fallback)


def listed_authors(authors: Column) -> Column:
    """Authors given as a list, as one name for `author_name`: filled entries, comma-joined."""
    return F.array_join(F.filter(F.transform(authors, strip_space), lambda a: a.isNotNull() & (a != "")), ", ")


def description(text: Column, title: Column, decode=unescape_html) -> Column:
    """Plain description; an empty one is replaced by the title."""
    plain = F.regexp_replace(decode(text), r"<[^>]+>", " ")
    plain = F.regexp_replace(plain, r"https?://\S+", "")
    plain = squeeze(F.replace(F.replace(plain, F.lit("&nbsp;"), F.lit(" ")), F.lit("\u00a0"), F.lit(" ")))
    return F.coalesce(F.nullif(plain, F.lit("")), title)


def fix_mojibake(text: Column) -> Column:
    """Undo UTF-8 read as Latin-1; unchanged where that is not what happened."""
    raw = F.when(text.rlike("^[\\x00-\\xff]*$"), F.encode(text, "ISO-8859-1"))
    return F.coalesce(F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")), text)


def source_name(source: Column, missing: str = "UNKNOWN") -> Column:
    return F.upper(F.trim(F.coalesce(source, F.lit(missing))))


def words(text: Column) -> Column:
    """Non-empty pieces between whitespace."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def title_features(title: Column) -> dict[str, Column]:
    """Length, raw word count, distinct cleaned words, their ratio, digits."""
    raw = word_count(title)
    unique = F.size(F.array_distinct(words(letters_digits(title))))
    return {
        "title_length": F.char_length(title),
        "word_count": raw,
        "unique_words": unique,
        "unique_ratio": unique / F.when(raw == 0, 1).otherwise(raw),
        "digit_count": F.regexp_count(title, F.lit("[0-9]")),
    }


def blank_if_null(df, names):
    """Null becomes '' and values become text, for those of `names` that exist."""
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in present})
