"""Predicates and classifications of signals, as Columns over a frame's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalogs as C
from ..functions.rules import additive_score, contains_any, first_match, lookup, multi_match
from ..functions.text import clean_text


def is_bad_item(title: Column, link: Column, summary: Column, feed: Column, decode=None) -> Column:
    """Items that are no news: nothing in them, payments, uploads, bare numbers, embedded data, or only their own title."""
    t, s, u = F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")), F.lower(F.coalesce(link, F.lit("")))
    tl, sl = F.trim(F.lower(t)), F.lower(s)
    cleaned = F.lower(clean_text(s, decode) if decode else clean_text(s))
    return (
        ((tl == "") & (sl == ""))
        | u.contains("post_type=give_payment")
        | (tl.contains("wp-content/uploads") & tl.startswith("http"))
        | tl.rlike(r"\.(jpg|jpeg|png|gif|webp)$")
        | (F.trim(t).rlike("^[0-9]+$") & (F.length(F.trim(s)) < 80))
        | sl.rlike(r'\{\s*"?url"?\s*:')
        | contains_any(sl, ["islcp", "viewport"])
        | (~contains_any(F.lower(F.coalesce(feed, F.lit(""))), C.EXEMPT_FEEDS) & ((cleaned == tl) | (cleaned == "")))
    )


def has_title_and_link(title: Column, link: Column) -> Column:
    return (F.coalesce(title, F.lit("")) != "") & (F.coalesce(link, F.lit("")) != "")


def is_noise(text: Column, feed: Column, phrases: list[str], feeds: list[str]) -> Column:
    """Whether a feed of the named kind says one of phrases."""
    return contains_any(feed, feeds) & contains_any(F.lower(text), phrases)


def is_local(text: Column, feed: Column, markers: list[str], feeds: list[str]) -> Column:
    """Feeds of the named kind must have a marker; others pass."""
    return ~contains_any(feed, feeds) | contains_any(F.lower(text), markers)


def young_enough(ts: Column, as_of: Column, days: int = 3650) -> Column:
    """At most so many whole days old; unreadable times pass."""
    return ts.isNull() | (F.floor((F.unix_micros(as_of) - F.unix_micros(ts)) / 86_400_000_000) <= days)


def plausible_time(ts: Column, as_of: Column, since: str = "2000-01-01", ahead_days: int = 2) -> Column:
    """Not before since, not more than ahead_days after as_of, and readable."""
    return F.coalesce((ts >= F.lit(since).cast("timestamp")) & (ts <= as_of + F.make_dt_interval(days=F.lit(ahead_days))), F.lit(False))


def dated_or_stamped(published: Column, url_date: Column, feed: Column, owners: list[str]) -> Column:
    """Undated items of feeds whose own producer owns the times (owners, by name) go; others may be stamped later."""
    return published.isNotNull() | url_date.isNotNull() | ~F.coalesce(feed.isin(*owners), F.lit(False))


def split_anomalies(df: DataFrame, ts: str, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) by plausible_time."""
    ok = plausible_time(F.col(ts), as_of)
    return df.filter(ok), df.filter(~ok)


def is_web_link(link: Column) -> Column:
    return F.coalesce(link.startswith("http"), F.lit(False))


def is_stolen_vehicle(*texts: Column, phrases: tuple[str, ...] = ("stolen vehicle", "vehicle theft")) -> Column:
    return contains_any(F.lower(F.concat_ws(" ", *texts)), phrases)


def event_included(kind: Column, kinds: list[str]) -> Column:
    return contains_any(F.lower(kind), [k.lower() for k in kinds])


def is_due(next_check: Column, as_of: Column) -> Column:
    """Feeds without a plan are due."""
    return next_check.isNull() | (next_check <= as_of)


def is_dns_failure(error: Column, signatures: list[str]) -> Column:
    return contains_any(error, signatures)


def feed_candidate(url: Column) -> Column:
    """direct_feed by a URL's ending, page by a word in it, else null."""
    low = F.lower(url)
    ends = low.rlike("(" + "|".join(e.replace(".", r"\.") for e in C.FEED_ENDINGS) + ")$")
    return F.when(ends, "direct_feed").when(contains_any(low, C.FEED_WORDS), "page")


def impact_score(category: Column, text: Column, rules=C.SCORE_RULES, base: int = C.SCORE_BASE, low: int = C.SCORE_LOW, high: int = C.SCORE_HIGH) -> Column:
    return additive_score(base, rules, category, text, low, high)


def urgency(score: Column) -> Column:
    out = None
    for least, label in C.URGENCY:
        out = F.when(score >= least, label) if out is None else out.when(score >= least, label)
    return out.otherwise(C.URGENCY_DEFAULT)


def sector(category: Column, table=C.SECTORS, default: str = C.SECTOR_DEFAULT) -> Column:
    return lookup(category, table, default)


def region(text: Column, rules=C.TAG_REGIONS, default: str = C.STATEWIDE) -> Column:
    """text in lower case."""
    return first_match(text, rules, default)


def entity_slugs(text: Column, rules=C.ENTITIES) -> Column:
    return multi_match(text, rules)


def url_category(url: Column, rules=C.URL_CATEGORIES, default: str = C.URL_CATEGORY_DEFAULT) -> Column:
    return first_match(url, [(label, [f"/{w}" for w in words]) for label, words in rules], default)


def fisheries_type(text: Column) -> Column:
    return first_match(text, C.FISHERIES_TYPES, C.FISHERIES_DEFAULT)


def species(text: Column) -> Column:
    return multi_match(text, C.SPECIES)


def legislative_action(text: Column) -> Column:
    return first_match(text, C.LEGISLATIVE_ACTIONS, C.LEGISLATIVE_DEFAULT)


def alert_levels(severity: Column, urgency_word: Column) -> tuple[Column, Column]:
    return lookup(severity, C.ALERT_IMPACT, C.ALERT_IMPACT_DEFAULT), lookup(urgency_word, C.ALERT_URGENCY, "background")


def volcano_score(color: Column, level: Column) -> Column:
    return F.greatest(lookup(color, C.VOLCANO_IMPACT, C.VOLCANO_DEFAULT), lookup(level, C.VOLCANO_IMPACT, C.VOLCANO_DEFAULT))


def road_levels(kind: Column) -> tuple[Column, Column]:
    """(urgency, impact)."""
    u = lookup(kind, C.ROAD_URGENCY, "background")
    return u, F.when(u == "now", 70).otherwise(40)


def escalate(missing: Column) -> tuple[Column, Column]:
    """(impact, urgency) of an incident."""
    return F.when(missing, 90).otherwise(60), F.when(missing, "now").otherwise("background")
