"""Time columns. "Now" is always a parameter, never read from a clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """A timestamp, UTC where no offset is given; null where it can't be read."""
    return F.try_to_timestamp(text)


def has_offset(text: Column) -> Column:
    return text.rlike(r"(Z|[+-]\d{2}:\d{2})$")


def parse_any(text: Column, *formats: str) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def posted_time(text: Column) -> Column:
    """A posted time, after what follows "by" is cut off."""
    return parse_any(F.trim(F.regexp_replace(text, r"(?i)\s+by\s+.*$", "")), "M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy")


def compact_time(text: Column) -> Column:
    """yyyyMMddHHmmss, or its first eight digits."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")), F.try_to_timestamp(F.substring(text, 1, 8), F.lit("yyyyMMdd")))


def epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def url_date(url: Column) -> Column:
    """The date in a /YYYY/MM/DD/ path, if it is one."""
    pattern = r"/((?:19|20)\d{2})/(\d{2})/(\d{2})/"
    parts = F.concat_ws("-", *[F.regexp_extract(url, pattern, k) for k in (1, 2, 3)])
    return F.when(url.rlike(pattern), F.to_date(F.try_to_timestamp(parts, F.lit("yyyy-MM-dd"))))


def resolve_published(feed: Column, url: Column, as_of: Column) -> Column:
    """The feed's time; the URL's date where their years differ or the feed has none; else as_of."""
    dated = url.cast("timestamp")
    return F.when(F.year(url) != F.year(feed), dated).otherwise(F.coalesce(feed, dated, as_of))


def event_time(summary: Column) -> Column:
    """The time of an event in a summary's markup."""
    return F.try_to_timestamp(F.replace(F.regexp_extract(summary, r"<dt>Time</dt><dd>([^<]+ UTC)</dd>", 1), F.lit(" UTC"), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss"))


def month_parts(text: Column) -> tuple[Column, Column]:
    """Year and month of an ISO time's text, null where it has none."""
    pattern = r"^(\d{4})-(\d{2})"
    return tuple(F.nullif(F.regexp_extract(text, pattern, k), F.lit("")) for k in (1, 2))


def latency_hours(event: Column, report: Column) -> Column:
    return F.bround((F.unix_micros(report) - F.unix_micros(event)) / 3.6e9, 1)


def age_on(born: Column, day: Column) -> Column:
    before = (F.month(day) * 100 + F.dayofmonth(day)) < (F.month(born) * 100 + F.dayofmonth(born))
    return F.year(day) - F.year(born) - before.cast("int")


def within(ts: Column, as_of: Column, seconds: int, strict: bool = False) -> Column:
    """Whether ts is no older than seconds before as_of; later times pass; null doesn't."""
    since = as_of - F.make_dt_interval(secs=F.lit(float(seconds)))
    return F.coalesce(ts > since if strict else ts >= since, F.lit(False))
