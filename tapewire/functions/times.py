"""Timestamp parsing and Eastern display as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted formats, display format and zone.
EASTERN = "America/New_York"
ISO_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX", "yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd",
]
# Minutes, seconds or up to nine digits of a second, with or without an offset.
ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"
MONTH_FORMATS = ["MMMM d yyyy h:mm a", "MMM d yyyy h:mm a"]
MONTH_DATE = r"(?i)([A-Za-z]+ [0-9]{1,2},?\s*[0-9]{4})\s*(at\s*)?([0-9]{1,2}:[0-9]{2}(:[0-9]{2})?\s*(AM|PM))?"
DISPLAY = r"(?i)([0-9]{4}-[0-9]{2}-[0-9]{2})\s+([0-9]{1,2}:[0-9]{2}:[0-9]{2}\s*(AM|PM)?(\s+[A-Z]{3,4})?)"


def with_colon(text: Column) -> Column:
    """Trim, cut fractions past microseconds, write offsets as +hh:mm."""
    short = F.regexp_replace(F.trim(text), r"(\.[0-9]{6})[0-9]+", "$1")
    return F.regexp_replace(short, r"(:[0-9]{2}(?:\.[0-9]+)?[+-][0-9]{2})([0-9]{2})$", "$1:$2")


def iso_timestamp(text: Column) -> Column:
    """UTC timestamp from any accepted ISO form, else null."""
    tidy = with_colon(text)
    plain = F.when(tidy.rlike(ISO_SHAPE), tidy.try_cast("timestamp"))
    return F.coalesce(plain, *[F.try_to_timestamp(tidy, F.lit(f)) for f in ISO_FORMATS])


def any_timestamp(text: Column) -> Column:
    """ISO forms first, then `Month DD, YYYY [at] HH:MM AM/PM` read as Eastern, noon if without time."""
    day = F.replace(F.regexp_extract(text, MONTH_DATE, 1), F.lit(","), F.lit(""))
    clock = F.coalesce(F.nullif(F.regexp_extract(text, MONTH_DATE, 3), F.lit("")), F.lit("12:00 PM"))
    local = F.concat_ws(" ", F.regexp_replace(day, r"\s+", " "), F.upper(F.trim(clock)))
    spoken = F.coalesce(*[F.try_to_timestamp(local, F.lit(f)) for f in MONTH_FORMATS])
    return F.coalesce(iso_timestamp(text), F.to_utc_timestamp(spoken, EASTERN))


def eastern_suffix(ts: Column) -> Column:
    local = F.from_utc_timestamp(ts, EASTERN)
    return F.when(F.unix_timestamp(local) - F.unix_timestamp(ts) == -4 * 3600, "EDT").otherwise("EST")


def eastern(ts: Column, pattern: str = "yyyy-MM-dd hh:mm:ss a") -> Column:
    shown = F.date_format(F.from_utc_timestamp(ts, EASTERN), pattern)
    return F.when(ts.isNotNull(), F.concat_ws(" ", shown, eastern_suffix(ts)))


def split_display(text: Column, as_of: str) -> tuple[Column, Column]:
    """Date and time strings of a display text; `as_of` (UTC) stands in for the clock."""
    now = F.lit(as_of).cast("timestamp")
    text = F.coalesce(text, F.lit(""))
    shown_day, shown_time = F.regexp_extract(text, DISPLAY, 1), F.trim(F.regexp_extract(text, DISPLAY, 2))
    ts = iso_timestamp(text)
    bare = F.regexp_extract(text, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    noon = F.lit("12:00:00 PM EST")
    rest = F.coalesce(F.nullif(F.trim(F.replace(text, bare, F.lit(""))), F.lit("")), noon)
    today = F.date_format(F.from_utc_timestamp(now, EASTERN), "yyyy-MM-dd")
    day = (
        F.when(text == "", today)
        .when(shown_day != "", shown_day)
        .when(ts.isNotNull(), F.date_format(F.from_utc_timestamp(ts, EASTERN), "yyyy-MM-dd"))
        .when(bare != "", bare)
        .otherwise(today)
    )
    time = (
        F.when(text == "", F.concat(F.date_format(F.from_utc_timestamp(now, EASTERN), "hh:mm:ss a"), F.lit(" EST")))
        .when(shown_day != "", shown_time)
        .when(ts.isNotNull(), eastern(ts, "hh:mm:ss a"))
        .when(bare != "", rest)
        .otherwise(noon)
    )
    return day, time


def epoch_or_iso_date(text: Column, as_of: str) -> Column:
    """Date of epoch seconds or of an ISO text; missing gives `as_of`."""
    seconds = F.try_to_number(text, F.lit("9999999999")).cast("bigint")
    return F.coalesce(
        F.to_date(F.timestamp_seconds(seconds)),
        F.left(text, F.lit(10)).try_cast("date"),
        F.lit(as_of).cast("date"),
    )


def feed_date(text: Column) -> Column:
    """Date of an RFC 2822 stamp; the weekday is dropped, Spark does not parse it."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(bare, r"(GMT|UTC)$", "+0000")
    return F.to_date(F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss Z")))
