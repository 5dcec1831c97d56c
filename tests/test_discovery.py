"""Discovery of feeds against a loop that asks one address after another; tests of feeds."""

import random
import re
from urllib.parse import urljoin

import pytest

from quillgrid.functions import catalogs as C
from quillgrid.sources import discovery as D

from .test_whole_tables import held_to_sql


@pytest.mark.parametrize("name", ["discovered_feeds", "feed_health"])
def test_held_to_sql(spark, name):
    assert held_to_sql(spark, name)


def loop(base, web):
    """(stage, url) of a site's feed, and the addresses asked, by the sequential rule."""
    asked = []

    def get(url):
        asked.append(url)
        status, body = web.get(url, (None, None))
        return body if status is not None and status < 400 else None

    def works(url):
        return len(re.findall(r"(?i)<(?:item|entry)[\s>]", get(url) or "")) > 0

    maps = re.findall(r"(?im)^\s*sitemap:\s*(\S+)", get(base + "/robots.txt") or "")[:3]
    if not maps:
        for p in D.SITEMAP_PATHS:
            if "<?xml" in (b := get(base + p) or "")[:100] or "<urlset" in b[:200] or "<sitemapindex" in b[:200]:
                maps.append(base + p)
                break

    def listed(url, depth):
        body = get(url) or ""
        locs = re.findall(r"<loc>\s*([^<\s]+)\s*</loc>", body)
        if "<sitemapindex" not in body:
            return locs
        return [u for x in locs for u in listed(x, depth + 1)] if depth < 2 else []

    urls = list(dict.fromkeys(u for m in maps for u in listed(m, 0)))
    kinds = [("direct" if u.lower().endswith(tuple(C.FEED_ENDINGS)) else "page", u) for u in urls if u.lower().endswith(tuple(C.FEED_ENDINGS)) or any(w in u.lower() for w in C.FEED_WORDS)]
    for kind, u in kinds:
        if kind == "direct" and works(u):
            return ("sitemap", u), asked
    for p in D.FEED_PATHS:
        if works(base + p):
            return ("path", base + p), asked
    for page in [base, *[u for k, u in kinds[:10] if k == "page"]][:5]:
        html = get(page) or ""
        hrefs = re.findall(r'<link rel="alternate" type="application/(?:rss|atom)\+xml" href="([^"]*)"', html)
        hrefs += [h for h in re.findall(r'<a href="([^"]*)"', html) if re.search(r"feed|rss|\.xml$", h.lower())]
        for u in list(dict.fromkeys(urljoin(page + ("/" if page.count("/") == 2 else ""), h) for h in hrefs if h))[:5]:
            if works(u):
                return ("page", u), asked
    return (None, None), asked


def a_web(seed, sites):
    rng = random.Random(seed)
    web, feed = {}, lambda n: (rng.choice([200, 200, 200, 404]), "<rss><channel>" + "<item><title>x</title></item>" * n + "</channel></rss>")
    for k in range(sites):
        b = f"https://s{k}.test"
        names = [b + rng.choice(["/a.xml", "/b/feed", "/c.rss", "/news/1", "/blog", "/x", "/press/y", "/d.atom"]) + rng.choice(["", "", "?q"]) for _ in range(rng.randint(0, 25))]
        page = "".join(rng.choice(['<link rel="alternate" type="application/rss+xml" href="/l.rss">', '<a href="sub/feed.php">f</a>', '<a class="c" href="/no">n</a>', '<a href="//s0.test/e.xml">e</a>', "<p>t</p>"]) for _ in range(6))
        page = page.replace('<a class="c" ', "<a ")
        urlset = "<?xml version='1.0'?><urlset>" + "".join(f"<url><loc> {u} </loc></url>" for u in names) + "</urlset>"
        shape = rng.randint(0, 4)
        if shape == 0:
            web[b + "/robots.txt"] = (200, f"User-agent: *\n Sitemap: {b}/m.xml\nsitemap: {b}/n.xml\n")
            web[b + "/m.xml"], web[b + "/n.xml"] = (200, urlset), (200, f"<urlset><url><loc>{b}/late.rss</loc></url></urlset>")
        elif shape == 1:
            web[b + "/wp-sitemap.xml"] = (200, f"<sitemapindex><sitemap><loc>{b}/i1</loc></sitemap><sitemap><loc>{b}/i2</loc></sitemap></sitemapindex>")
            web[b + "/i1"] = (200, f"<sitemapindex><sitemap><loc>{b}/i3</loc></sitemap></sitemapindex>")
            web[b + "/i2"], web[b + "/i3"] = (200, "<urlset><url><loc>" + b + "/z.xml</loc></url></urlset>"), (200, urlset)
        for u in {*names, b + "/late.rss", b + "/z.xml", b + "/l.rss", b + "/sub/feed.php", b + "/e.xml", b + "/e"}:
            if rng.random() < 0.5:
                web[u] = feed(rng.choice([0, 0, 1, 3])) if u.split("?")[0].endswith((".xml", "feed", ".rss", ".atom", ".php")) else (200, page)
        if rng.random() < 0.3:
            web[b + rng.choice(D.FEED_PATHS)] = feed(2)
        if rng.random() < 0.7:
            web[b] = (200, page)
    return web


def test_discovery_is_the_loop(spark):
    sites = 40
    web = a_web(3, sites)
    answers = spark.createDataFrame([(u, s, b, len(b), None) for u, (s, b) in web.items()], D.ANSWER)
    bases = [f"https://s{k}.test" for k in range(sites)]
    found = D.discover(spark.createDataFrame([(b,) for b in [*bases, bases[0], None]], "base string"), D.answered_by(answers))
    got = {r.base: (r.stage, r.url) for r in found.feeds.collect()}
    want = {b: loop(b, web) for b in bases}
    assert got == {b: w for b, (w, _) in want.items()}
    assert {s for s, _ in got.values()} == {None, "sitemap", "path", "page"}
    asked = {}
    for r in found.asked.collect():
        asked.setdefault(r.base, []).append((r.stage, r.rank, r.url))
    stages = ["robots", "sitemaps", "sitemap", "path", "page"]
    for b in bases:
        stage, url = got[b]
        assert len(asked[b]) == len(set(asked[b]))
        if stage is None:
            continue
        at = next(r for s, r, u in asked[b] if (s, u) == (stage, url))
        assert all(stages.index(s) <= stages.index(stage) for s, _, _ in asked[b])  # nothing after what was found
        assert max(r for s, r, _ in asked[b] if s == stage) < 2 * at + 1  # nor beyond its wave
    empty = D.discover(spark.createDataFrame([], "base string"), D.answered_by(answers))
    assert empty.feeds.count() == 0 and empty.asked.count() == 0


def test_over_http(spark):
    def fetch(url, timeout):
        if url.endswith("bad"):
            raise OSError("no route")
        return 200, f"<rss><channel><item/><item><title>{url}</title></item></channel></rss>"

    ask = D.over_http(fetch, tasks=2)
    rows = {r.url: r for r in D.feed_health(ask(spark.createDataFrame([("u/a",), ("u/bad",), ("u/a",)], "url string"))).collect()}
    assert rows["u/a"].status == 200 and rows["u/a"].latency_ms >= 0 and (rows["u/a"].health, rows["u/a"].items) == ("ok", 1)
    assert (rows["u/bad"].health, rows["u/bad"].message, rows["u/bad"].latency_ms) == ("error", "OSError: no route", 0)


def test_feed_health(spark):
    cases = {
        "ok": (200, "<rss><channel><item><t>a</t></item></channel></rss>", None, "ok", None, 1),
        "raised": (None, None, "Name or service not known", "error", "Name or service not known", 0),
        "gone": (404, "<rss><channel><item>a</item></channel></rss>", None, "error", "HTTP 404", 1),
        "none": (200, "<rss><channel><!-- <item> --></channel></rss>", None, "warning", "No entries found in feed", 0),
        "broken": (200, "<rss><channel>", None, "error", "Parse error", 0),
        "dirty": (200, "<rss><channel><item>a</item><entry\n>", None, "warning", "Dirty XML", 2),
        "null": (200, None, None, "error", "Parse error", 0),
        "empty": (200, "", None, "error", "Parse error", 0),
    }
    df = spark.createDataFrame([(k, *v[:2], 5, v[2]) for k, v in cases.items()], D.ANSWER)
    got = {r.url: (r.health, r.message, r.items) for r in D.feed_health(df).collect()}
    assert got == {k: v[3:] for k, v in cases.items()}


def test_joined_url(spark):
    from pyspark.sql import functions as F

    pages = ["https://a.b/c/d?x=/y#/z", "https://a.b", "http://a.b/c/"]
    hrefs = ["e", "/e", "//f/e", "mailto:x", "https://g/h", "?q"]
    pairs = [(p, h) for p in pages for h in hrefs if h != "?q" or p.endswith("/")]
    got = {(r.p, r.h): r.u for r in spark.createDataFrame(pairs, "p string, h string").select("p", "h", D.joined_url(F.col("p"), F.col("h")).alias("u")).collect()}
    assert got == {(p, h): urljoin(p, h) for p, h in pairs}
