"""Finding the working feeds of sites, and testing feeds: a frontier of sites, of which each step asks only those still without one.

Asking is a function of DataFrames, (url) to (url, status, body, latency_ms, error): over_http of a fetch function, whose calls run in
the executors, or a join with answers fetched before (answered_by).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import heal_xml
from ..operators.filters import feed_candidate
from ..operators.ranking import pages as numbered
from ..session import settle, ship
from .feeds import Fetch

ANSWER = "url string, status int, body string, latency_ms long, error string"
Ask = Callable[[DataFrame], DataFrame]

#: Where sitemaps and feeds commonly are, in the order in which they are asked.
SITEMAP_PATHS = ("/sitemap.xml", "/sitemap_index.xml", "/wp-sitemap.xml", "/sitemap.xml.gz")
FEED_PATHS = (
    "/feed", "/feed/", "/rss", "/rss.xml", "/feed.xml", "/atom.xml", "/news/feed", "/blog/feed", "/news.rss", "/index.xml",
    "/feed/rss", "/feed/atom", "/?feed=rss2", "/news/rss", "/blog/rss", "/updates/feed",
    "/search/?f=rss&t=article&c=news&l=50&s=start_time&sd=desc",
)


class Found(NamedTuple):
    """feeds: (base, stage, rank, url, items, latency_ms), a row for each base, stage null where no feed was found; asked: every
    question, (base, stage, rank, url, status, items, latency_ms, error)."""

    feeds: DataFrame
    asked: DataFrame


def over_http(fetch: Fetch, timeout: float = 12.0, tasks: int = 64) -> Ask:
    """Asks each URL once by fetch(url, timeout), timed in milliseconds; what it raises becomes the answer's error, latency 0."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            out = []
            for url in urls["url"]:
                start = time.monotonic()
                try:
                    status, body = fetch(url, timeout)
                    out.append((url, status, body, round((time.monotonic() - start) * 1000), None))
                except Exception as e:  # noqa: BLE001  told in the row
                    out.append((url, None, None, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["url", "status", "body", "latency_ms", "error"]).astype({"status": "Int32"})

    def ask(urls: DataFrame) -> DataFrame:
        ship(urls.sparkSession)
        return urls.select("url").distinct().repartition(tasks, "url").mapInPandas(rows, ANSWER)

    return ask


def answered_by(answers: DataFrame) -> Ask:
    """Asks a table of answers (url, status, body, latency_ms, error), one for each URL; what isn't there is an error."""

    def ask(urls: DataFrame) -> DataFrame:
        known = answers.select("url", "status", "body", "latency_ms", "error", F.lit(True).alias("__known"))
        joined = urls.select("url").distinct().join(known, "url", "left")
        return joined.select("url", "status", "body", F.coalesce("latency_ms", F.lit(0)).cast("long").alias("latency_ms"), F.when(F.col("__known").isNull(), "no answer").otherwise(F.col("error")).alias("error"))

    return ask


def entry_count(body: Column) -> Column:
    """Entries of a feed's text, well formed or not: item and entry tags outside of comments and CDATA."""
    bare = F.regexp_replace(body, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    return F.coalesce(F.size(F.regexp_extract_all(bare, F.lit(r"(?i)<(?:item|entry)[\s>]"), 0)), F.lit(0))


def _good() -> Column:
    return F.coalesce(F.col("error").isNull() & (F.col("status") < 400), F.lit(False))


def feed_health(answers: DataFrame) -> DataFrame:
    """answers with health (ok, warning or error), items, and message, null where ok.

    In this order: what raised, a status of 400 or more, no entries in a text that doesn't parse are errors; no entries, and
    entries in a text that doesn't parse, are warnings. A null body has no entries and doesn't parse.
    """
    parsed = F.from_xml(F.col("body"), "__any string, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    judged = answers.withColumns({"items": entry_count(F.col("body")), "__dirty": F.col("body").isNull() | parsed["__bad"].isNotNull()})
    cases = [
        (F.col("error").isNotNull(), "error", F.col("error")),
        (F.col("status") >= 400, "error", F.concat(F.lit("HTTP "), "status")),
        ((F.col("items") == 0) & F.col("__dirty"), "error", F.lit("Parse error")),
        (F.col("items") == 0, "warning", F.lit("No entries found in feed")),
        (F.col("__dirty"), "warning", F.lit("Dirty XML")),
    ]
    case = lambda of: F.coalesce(*[F.when(c, of(h, m)) for c, h, m in cases])
    return judged.withColumns({"health": F.coalesce(case(lambda h, m: F.lit(h)), F.lit("ok")), "message": case(lambda h, m: m)}).drop("__dirty")


def joined_url(page: Column, href: Column) -> Column:
    """href as seen from page: whole, without scheme, from the site's root, or from the page's folder."""
    site = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.concat(site, F.coalesce(F.nullif(F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/(?:[^?#]*/)?)", 1), F.lit("")), F.lit("/")))
    scheme = F.regexp_extract(page, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    return F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(site, href)).otherwise(F.concat(folder, href))


def feed_links(page: Column, html: Column) -> Column:
    """Addresses of feeds that a page names, each once: alternate links of an XML type, then anchors to feed, rss or .xml."""
    attribute = lambda tag, name: F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']?([^"'\s>]+)""", 1)
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), 0)
    heads = F.filter(tags, lambda t: (F.lower(attribute(t, "rel")) == "alternate") & F.lower(attribute(t, "type")).rlike("rss|atom|xml"))
    anchors = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>"), 0), lambda t: attribute(t, "href"))
    anchors = F.filter(anchors, lambda h: F.lower(h).rlike(r"feed|rss|\.xml$"))
    hrefs = F.filter(F.concat(F.transform(heads, lambda t: attribute(t, "href")), anchors), lambda h: h != "")
    return F.array_distinct(F.transform(hrefs, lambda h: joined_url(page, F.replace(h, F.lit("&amp;"), F.lit("&")))))


def _first(candidates: DataFrame, ask: Ask, stage: str, good: Column | None = None, keep: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """(the first good candidate of each base, by rank; all that was asked) of candidates (base, rank, url), ranks from 1.

    As the loop over ranks that stops at the first good one, but in waves: 1, 2, 4... candidates of each base that has none yet,
    so that waves are as many as a rank has bits, and a base is asked at most twice what the loop would have.
    """
    left, asked, hits, start, width = settle(candidates.select("base", "rank", "url"), "candidates"), [], [], 1, 1
    last = left.agg(F.max("rank")).first()[0] or 0
    while start <= last:
        wave = left.filter(F.col("rank").between(start, start + width - 1))
        for hit in hits:
            wave = wave.join(hit.select("base"), "base", "left_anti")
        wave = settle(wave, "wave")
        start, width = start + width, width * 2
        if wave.isEmpty():
            continue
        answers = wave.join(ask(wave.select("url")), "url").withColumn("items", entry_count(F.col("body")))
        ok = _good() & (F.col("items") > 0 if good is None else F.coalesce(good, F.lit(False)))
        answers = settle(answers.select("base", F.lit(stage).alias("stage"), "rank", "url", "status", "items", "latency_ms", "error", ok.alias("good"), *keep), "answers")
        asked.append(answers)
        columns = [c for c in answers.columns if c not in ("base", "good")]
        hits.append(settle(answers.filter("good").groupBy("base").agg(F.min_by(F.struct(*columns), "rank").alias("a")).select("base", "a.*"), "hits"))
    empty = left.select("base", F.lit(stage).alias("stage"), F.col("rank"), "url", F.lit(0).alias("status"), F.lit(0).alias("items"), F.lit(0).cast("long").alias("latency_ms"), F.lit("").alias("error"), *[F.lit("").alias(k) for k in keep]).limit(0)
    return reduce(DataFrame.unionByName, hits, empty), asked


def _under(bases: DataFrame, paths: Sequence[str]) -> DataFrame:
    each = bases.select("base", F.posexplode(F.array(*[F.lit(p) for p in paths])).alias("p", "path"))
    return each.select("base", (F.col("p") + 1).cast("long").alias("rank"), F.concat(F.regexp_replace("base", "/+$", ""), "path").alias("url"))


def _ranked(rows: DataFrame, order: str) -> DataFrame:
    """rows with the rank of each in its base, from 1, by order; no base goes through one task."""
    n = numbered(rows, [F.col("base"), F.col(order)], 1)
    starts = n.groupBy("base").agg(F.min("page").alias("__s"))
    return n.join(starts, "base").withColumn("rank", F.col("page") - F.col("__s") + 1).drop("page", "__s", order)


def site_pages(maps: DataFrame, ask: Ask, depth: int = 2) -> DataFrame:
    """(base, path, url) of the pages that sitemaps (base, path, url) and the indexes within them list, to a depth; path, an array
    of positions, orders them as a reader that opens each sitemap where it is named."""
    level, out = maps, []
    for _ in range(depth + 1):
        level = settle(level, "sitemaps")
        if level.isEmpty():
            break
        got = level.join(ask(level.select("url")).filter(_good()), "url").withColumn("__x", heal_xml(F.col("body")))
        listed = got.select("base", "path", F.lower("__x").contains("<sitemapindex").alias("index"), F.posexplode(F.regexp_extract_all("__x", F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1)).alias("p", "url"))
        listed = settle(listed.select("base", F.concat("path", F.array("p")).alias("path"), F.replace("url", F.lit("&amp;"), F.lit("&")).alias("url"), "index"), "listed")
        out.append(listed.filter("NOT index").drop("index"))
        level = listed.filter("index").drop("index")
    return reduce(DataFrame.unionByName, out) if out else maps.limit(0)


def discover(sites: DataFrame, ask: Ask, maps: int = 3, depth: int = 2, within: int = 10, pages: int = 5, links: int = 5) -> Found:
    """The first working feed of each site (base), looked for in the order: what its sitemaps list that ends like a feed
    (stage sitemap), common paths (path), links of its front page and of the pages that its sitemaps name like news (page).

    Sitemaps are those of robots.txt, the first maps of them, else the first common path that is one. A feed works if it
    answers below 400 and has entries. How many pages (of the first within candidates) and links of a page are asked is a matter of manners,
    set by the limits; sitemaps' feeds have none. Repeated and null bases are asked once and not at all; a base without an
    answer has null stage, rank, url, items and latency_ms.
    """
    bases = settle(sites.select("base").filter("base IS NOT NULL").distinct(), "bases")
    asked: list[DataFrame] = []

    def unresolved(found: Sequence[DataFrame]) -> DataFrame:
        return reduce(lambda df, f: df.join(f.select("base"), "base", "left_anti"), found, bases)

    robots, a = _first(_under(bases, ["/robots.txt"]), ask, "robots", F.col("body").isNotNull(), keep=["body"])
    asked += [x.drop("body") for x in a]
    lines = robots.select("base", F.posexplode(F.slice(F.regexp_extract_all("body", F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1), 1, maps)).alias("p", "url"))
    named = settle(lines.select("base", F.array("p").alias("path"), F.when(F.col("url").startswith("//"), F.concat(F.lit("https:"), "url")).otherwise(F.col("url")).alias("url")), "named")
    is_map = F.left("body", F.lit(100)).contains("<?xml") | F.left("body", F.lit(200)).rlike("<urlset|<sitemapindex")
    common, a = _first(_under(unresolved([named]), SITEMAP_PATHS), ask, "sitemaps", is_map)
    asked += a
    roots = named.unionByName(common.select("base", F.array(F.lit(0)).alias("path"), "url"))

    listed = site_pages(roots, ask, depth).withColumn("kind", feed_candidate(F.col("url"))).filter("kind IS NOT NULL")
    once = listed.groupBy("base", "url", "kind").agg(F.min("path").alias("path"))
    candidates = settle(_ranked(once, "path"), "ranked")
    direct, a = _first(_ranked(candidates.filter("kind = 'direct_feed'").withColumnRenamed("rank", "__o"), "__o"), ask, "sitemap")
    asked += a
    paths, a = _first(_under(unresolved([direct]), FEED_PATHS), ask, "path")
    asked += a

    left = settle(unresolved([direct, paths]), "left")
    near = candidates.filter((F.col("kind") == "page") & (F.col("rank") < within + 1)).select("base", "rank", "url").join(left, "base", "left_semi")
    fronts = left.select("base", F.lit(0).cast("long").alias("rank"), F.col("base").alias("url"))
    order = _ranked(fronts.unionByName(near).withColumnRenamed("rank", "__o"), "__o").filter(F.col("rank") <= pages)
    opened = settle(order.join(ask(settle(order, "pages").select("url")).filter(_good()), "url").select("base", "rank", F.slice(feed_links(F.col("url"), F.col("body")), 1, links).alias("l")), "opened")
    each = opened.select("base", "rank", F.posexplode("l").alias("p", "url")).select("base", ((F.col("rank") - 1) * links + F.col("p") + 1).alias("rank"), "url")
    scraped, a = _first(each, ask, "page")
    asked += a

    found = reduce(DataFrame.unionByName, [f.select("base", "stage", "rank", "url", "items", "latency_ms") for f in (direct, paths, scraped)])
    return Found(bases.join(found, "base", "left"), reduce(DataFrame.unionByName, [x.drop("good") for x in asked]) if asked else found.limit(0))
