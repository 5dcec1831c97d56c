"""Queries of sites and their feeds: a web made of the pages table, discovered and tested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import xml_escape
from ..session import settle
from ..sources import discovery
from .frames import table
from .queries import query

_BASE = "'https://s'||page_id||'.example.org'"
_FEED = "'<rss><channel>'||array_to_string(list_transform(hrefs, lambda h: '<item><link>'||replace(replace(replace(base||h,'&','&amp;'),'<','&lt;'),'>','&gt;')||'</link></item>'), '')||'</channel></rss>'"
_LOCS = "array_to_string(list_transform(hrefs, lambda h: '<url><loc>'||replace(replace(replace(base||h,'&','&amp;'),'<','&lt;'),'>','&gt;')||'</loc></url>'), '')"
#: (kind, path, status, body): what a site answers, by page_id % 6; a status may depend on the page.
_WEB = f"""WITH p AS (SELECT page_id, {_BASE} AS base, html, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages),
answers AS (SELECT base, base||path AS url, status, body, length(body) % 97 AS latency FROM (
  SELECT *, unnest([
    {{'k': 0, 'path': '/robots.txt', 'status': 200, 'body': 'User-agent: *' || chr(10) || 'Sitemap: ' || base || '/map.xml'}},
    {{'k': 0, 'path': '/map.xml', 'status': 200, 'body': '<urlset>' || {_LOCS} || '<url><loc>' || base || '/old.rss</loc></url><url><loc>' || base || '/news.rss</loc></url></urlset>'}},
    {{'k': 0, 'path': '/old.rss', 'status': 404, 'body': {_FEED}}},
    {{'k': 0, 'path': '/news.rss', 'status': CASE WHEN page_id % 4 = 0 THEN 200 ELSE 500 END, 'body': {_FEED}}},
    {{'k': 0, 'path': '/blog/rss', 'status': 200, 'body': {_FEED}}},
    {{'k': 1, 'path': '/sitemap_index.xml', 'status': 200, 'body': '<sitemapindex><sitemap><loc> ' || base || '/child.xml </loc></sitemap></sitemapindex>'}},
    {{'k': 1, 'path': '/child.xml', 'status': 200, 'body': '<urlset><url><loc>' || base || '/a.atom</loc></url><url><loc>' || base || '/b.rss</loc></url></urlset>'}},
    {{'k': 1, 'path': '/a.atom', 'status': 200, 'body': '<feed></feed>'}},
    {{'k': 1, 'path': '/b.rss', 'status': 200, 'body': {_FEED}}},
    {{'k': 2, 'path': '/blog/feed', 'status': 200, 'body': {_FEED}}},
    {{'k': 2, 'path': '/feed.xml', 'status': 200, 'body': {_FEED}}},
    {{'k': 3, 'path': '', 'status': 200, 'body': '<link rel="alternate" type="application/rss+xml" href="/own.rss">' || html}},
    {{'k': 3, 'path': '/own.rss', 'status': 200, 'body': {_FEED}}},
    {{'k': 4, 'path': '', 'status': 200, 'body': '<a href="feeds/all.xml">All</a>' || html}},
    {{'k': 4, 'path': '/feeds/all.xml', 'status': 200, 'body': {_FEED}}},
    {{'k': 5, 'path': '', 'status': 200, 'body': html}}], recursive := true) FROM p) WHERE page_id % 6 = k),
feeds AS (SELECT base, url, len(regexp_extract_all(body, '<item>')) AS items, latency FROM answers WHERE status < 400 AND contains(body, '<item>'))"""


def web(spark, d: str) -> DataFrame:
    """Answers of one site for each page, some with sitemaps, some with feeds at common paths, some with links."""
    hrefs = F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), 1)
    p = table(spark, d, "pages").select("page_id", F.concat(F.lit("https://s"), "page_id", F.lit(".example.org")).alias("base"), "html", hrefs.alias("hrefs"))
    each = lambda before, after: F.array_join(F.transform("hrefs", lambda h: F.concat(F.lit(before), xml_escape(F.concat("base", h)), F.lit(after))), "")
    p = p.withColumns({"feed": F.concat(F.lit("<rss><channel>"), each("<item><link>", "</link></item>"), F.lit("</channel></rss>")), "locs": each("<url><loc>", "</loc></url>")})
    text = lambda *parts: F.concat(*[F.col(x[1:]) if x.startswith("$") else F.lit(x) for x in parts])
    answers = [
        (0, "/robots.txt", 200, text("User-agent: *\nSitemap: ", "$base", "/map.xml")),
        (0, "/map.xml", 200, text("<urlset>", "$locs", "<url><loc>", "$base", "/old.rss</loc></url><url><loc>", "$base", "/news.rss</loc></url></urlset>")),
        (0, "/old.rss", 404, F.col("feed")),
        (0, "/news.rss", F.when(F.col("page_id") % 4 == 0, 200).otherwise(500), F.col("feed")),
        (0, "/blog/rss", 200, F.col("feed")),
        (1, "/sitemap_index.xml", 200, text("<sitemapindex><sitemap><loc> ", "$base", "/child.xml </loc></sitemap></sitemapindex>")),
        (1, "/child.xml", 200, text("<urlset><url><loc>", "$base", "/a.atom</loc></url><url><loc>", "$base", "/b.rss</loc></url></urlset>")),
        (1, "/a.atom", 200, F.lit("<feed></feed>")),
        (1, "/b.rss", 200, F.col("feed")),
        (2, "/blog/feed", 200, F.col("feed")),
        (2, "/feed.xml", 200, F.col("feed")),
        (3, "", 200, text('<link rel="alternate" type="application/rss+xml" href="/own.rss">', "$html")),
        (3, "/own.rss", 200, F.col("feed")),
        (4, "", 200, text('<a href="feeds/all.xml">All</a>', "$html")),
        (4, "/feeds/all.xml", 200, F.col("feed")),
        (5, "", 200, F.col("html")),
    ]
    row = lambda k, path, status, body: F.when(F.col("page_id") % 6 == k, F.struct(F.concat("base", F.lit(path)).alias("url"), (status if not isinstance(status, int) else F.lit(status)).alias("status"), body.alias("body")))
    found = p.select(F.explode(F.array_compact(F.array(*[row(*a) for a in answers]))).alias("a")).select("a.*")
    return found.select("url", "status", "body", (F.length("body") % 97).cast("long").alias("latency_ms"), F.lit(None).cast("string").alias("error"))


_PATHS = ", ".join(f"'{p}'" for p in discovery.FEED_PATHS)


@query(f"""{_WEB.replace("WITH p", "WITH RECURSIVE p", 1)},
maps(base, path, url) AS (SELECT base, []::BIGINT[], url FROM answers WHERE url = base||'/sitemap_index.xml'
  UNION ALL SELECT base, []::BIGINT[], unnest(regexp_extract_all(body, 'Sitemap: (\\S+)', 1)) FROM answers WHERE url = base||'/robots.txt'
  UNION ALL SELECT base, list_append(path, i), trim(replace(l[i], '&amp;', '&')) FROM (SELECT base, path, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT m.base, m.path, regexp_extract_all(a.body, '<loc>\\s*([^<\\s]+)\\s*</loc>', 1) AS l FROM maps m JOIN answers a ON a.url = m.url WHERE contains(a.body, '<loc>')))),
candidates AS (SELECT base, 'sitemap' AS stage, 1 AS s, path, url FROM maps WHERE regexp_matches(url, '(\\.xml|\\.rss|\\.atom|/feed|/rss)$')
  UNION ALL SELECT base, 'path', 2, [i], base||([{_PATHS}])[i] FROM p, (SELECT unnest(range(1, {len(discovery.FEED_PATHS) + 1})) AS i)
  UNION ALL SELECT base, 'page', 3, [1], base||regexp_extract(body, '^<link rel="alternate" type="application/rss.xml" href="([^"]*)"', 1) FROM answers WHERE url = base
  UNION ALL SELECT base, 'page', 3, [2], base||'/'||regexp_extract(body, '^<a href="([^"]*)"', 1) FROM answers WHERE url = base),
first AS (SELECT c.base, stage, c.url, items, latency AS latency_ms FROM candidates c JOIN feeds f ON f.url = c.url QUALIFY row_number() OVER (PARTITION BY c.base ORDER BY s, path) = 1)
SELECT base, stage, url, items, latency_ms FROM p LEFT JOIN first USING (base)""")
def discovered_feeds(spark, d):
    answers = settle(web(spark, d), "web")
    sites = table(spark, d, "pages").select(F.concat(F.lit("https://s"), "page_id", F.lit(".example.org")).alias("base"))
    return discovery.discover(sites, discovery.answered_by(answers)).feeds.select("base", "stage", "url", "items", "latency_ms")


@query(f"""{_WEB} SELECT url, latency_ms, items, CASE WHEN status >= 400 THEN 'error' WHEN items = 0 THEN CASE WHEN broken THEN 'error' ELSE 'warning' END WHEN broken THEN 'warning' ELSE 'ok' END AS health,
  CASE WHEN status >= 400 THEN 'HTTP '||status WHEN items = 0 THEN CASE WHEN broken THEN 'Parse error' ELSE 'No entries found in feed' END WHEN broken THEN 'Dirty XML' END AS message
FROM (SELECT url, status, latency AS latency_ms, len(regexp_extract_all(body, '<item>')) AS items, length(body) % 5 = 0 AS broken FROM answers WHERE regexp_matches(url, '\\.rss$|/feed$|feed\\.xml$|\\.atom$'))""")
def feed_health(spark, d):
    """The feeds of all sites; a fifth of them has lost its end."""
    feeds = web(spark, d).filter(F.col("url").rlike(r"\.rss$|/feed$|feed\.xml$|\.atom$"))
    cut = F.when(F.length("body") % 5 == 0, F.regexp_replace("body", "</[a-z]+>$", "")).otherwise(F.col("body"))
    return discovery.feed_health(feeds.withColumn("body", cut)).select("url", "latency_ms", "items", "health", "message")
