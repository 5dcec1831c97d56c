import hashlib
import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgrid.functions import catalogs as C
from quillgrid.functions import extract as X
from quillgrid.functions import geo, text, times, urls
from quillgrid.operators import filters


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*columns).first()


def plain(raw):
    t = html.unescape(raw)
    for p in (r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"<[^>]+>"):
        t = re.sub(p, " ", t)
    return re.sub(r"\s+", " ", t).strip()


@pytest.mark.parametrize("raw", ["", "a &amp;nbsp; b", "<SCRIPT>x<b></script>y", "a\xa0\xa0b <p>c</p>", "&eacute;&#233;&lt;b&gt;x", "<style>p{}</style>", "  x  "])
def test_clean_text(spark, raw):
    got = one(spark, raw, text.clean_text(F.col("t"), text.html_unescape).alias("x")).x
    assert got == plain(raw)


def test_clean_text_of_null(spark):
    assert one(spark, None, text.clean_text(F.col("t")).alias("x")).x == ""


@pytest.mark.parametrize("n", [0, 1, 299, 300, 301, 3001, 20_000])
def test_snippet_length(spark, n):
    got = one(spark, "x" * n, text.snippet(F.col("t")).alias("x")).x
    limit = min(1000, max(min(300, n), int(n * 0.1)))
    assert got == ("x" * limit + ("..." if n > limit else "") if n else C.SNIPPET_EMPTY)


def test_snippet_cut_on_a_blank_and_again(spark):
    s = "a" * 299 + " " + "b" * 200
    first = one(spark, s, text.snippet(F.col("t")).alias("x")).x
    assert first == "a" * 299 + "..." and len(first) == 302
    assert len(one(spark, first, text.snippet(F.col("t")).alias("x")).x) == 303


@settings(max_examples=20, deadline=None)
@given(st.text(max_size=40))
def test_slug_and_key(spark, s):
    got = one(spark, s, text.slug(F.col("t")).alias("a"), F.md5(F.col("t").cast("binary")).alias("b"))
    assert got.b == hashlib.md5(s.encode()).hexdigest()
    if s.isascii():
        assert got.a == re.sub(r"[^a-z0-9]+", "-", s.lower()).strip("-")


def test_heal_xml(spark):
    got = one(spark, "\ufeff<a>x&nbsp;y & z &amp; &#38;\x01</a>", text.heal_xml(F.col("t")).alias("x")).x
    assert got == "<a>x\u00a0y &amp; z &amp; &#38;</a>"


@pytest.mark.parametrize(("agency", "place"), [(None, "Unknown"), ("", "Unknown"), ("AST ENFORCEMENT PALMER", "Palmer"), ("ABI MISSING PERSONS", "Anchorage"), ("DPS", "Unknown"), ("Kenai Police Department", "Kenai")])
def test_agency(spark, agency, place):
    assert one(spark, agency, text.clean_agency(F.col("t")).alias("x")).x == place


@pytest.mark.parametrize(
    ("title", "link", "summary", "feed", "bad"),
    [
        ("", "http://x", "", "", True), ("News", "http://x/?post_type=give_payment", "long text", "", True), ("http://x/wp-content/uploads/a", "http://x", "text", "", True), ("pic.JPG", "http://x", "text", "", True),
        ("2024", "http://x", "short", "", True), ("2024", "http://x", "x" * 80, "", False), ("t", "http://x", '{ "url" : 1}', "", True), ("t", "http://x", "VIEWPORT", "", True),
        ("Same", "http://x", "<p>same</p>", "", True), ("Same", "http://x", "same", "NWS Alerts", False), ("t", "http://x", "", "fire news", False), ("t", "http://x", "fine", "", False),
    ],
)
def test_bad_items(spark, title, link, summary, feed, bad):
    row = spark.createDataFrame([(title, link, summary, feed)], "a string, b string, c string, d string").select(filters.is_bad_item(*[F.col(c) for c in "abcd"]).alias("x")).first()
    assert row.x is bad


def test_first_match_takes_the_first_rule(spark):
    row = one(spark, "kodiak and palmer; stoked", filters.region(F.col("t")).alias("a"), filters.region(F.col("t"), C.DISPATCH_REGIONS).alias("b"), filters.region(F.lit("none")).alias("c"))
    assert tuple(row) == ("Mat-Su", "Gulf Coast", "Statewide")
    assert one(spark, "stoked", filters.region(F.col("t")).alias("a")).a == "Interior"


@settings(max_examples=15, deadline=None)
@given(st.sampled_from(sorted(C.SECTORS) + ["Housing"]), st.lists(st.sampled_from([w for _, k, ws in C.SCORE_RULES if k == "text" for w in ws]), max_size=6))
def test_score_stays_in_bounds(spark, category, words):
    got = one(spark, " ".join(words), filters.impact_score(F.lit(category), F.col("t")).alias("x")).x
    want = 30 + sum(w for w, kind, ws in C.SCORE_RULES if (category in ws if kind == "category" else any(x in " ".join(words) for x in ws)))
    assert got == max(10, min(100, want))


@pytest.mark.parametrize(
    ("raw", "want"),
    [("2024-01-02T03:04:05+00:00", True), ("2024-01-02T03:04:05Z", True), ("2024-01-02T03:04:05.123Z", True), ("2024-01-02", True), ("2024-01-02T03:04:05", True), ("", False), ("garbage", False), (None, False)],
)
def test_iso_times(spark, raw, want):
    assert (one(spark, raw, times.parse_iso(F.col("t")).alias("x")).x is not None) is want


def test_other_times(spark):
    row = one(
        spark, "1/2/2021 3:04:05 PM by DPS\\x", times.posted_time(F.col("t")).alias("a"), times.compact_time(F.lit("20210203040506")).alias("b"), times.compact_time(F.lit("20210203xx")).alias("c"),
        times.url_date(F.lit("http://x/1999/13/01/")).alias("d"), times.url_date(F.lit("http://x/1999/12/01/a")).cast("string").alias("e"),
    )
    assert str(row.a) == "2021-01-02 15:04:05" and str(row.b) == "2021-02-03 04:05:06" and str(row.c) == "2021-02-03 00:00:00" and row.d is None and row.e == "1999-12-01"


def test_window_bounds(spark):
    at = F.lit("2024-01-08 00:00:00").cast("timestamp")
    row = one(spark, "2024-01-01 00:00:00", times.within(F.col("t").cast("timestamp"), at, 604_800).alias("a"), times.within(F.col("t").cast("timestamp"), at, 604_800, strict=True).alias("b"), times.within(F.lit(None).cast("timestamp"), at, 1).alias("c"))
    assert tuple(row) == (True, False, False)


def test_entities(spark):
    t = "On 3/4/2021, at approximately 930 hours John Smith (34) and 22-year-old Jane Doe Roe, Al Bo 120 YOA, John Smith (40), was arrested for theft, assault and battery. FCC. bail was set at $1,500. 0.12 BrAC"
    e = one(spark, t, X.entities(F.col("t")).alias("e")).e
    assert [(s.name, s.age) for s in e.suspects] == [("John Smith", 34), ("Jane Doe Roe", 22), ("Al Bo", 120)]
    assert e.charges == ["theft", "assault", "battery"] and e.bac == 0.12 and e.facility.code == "FCC" and tuple(e.bail) == ("set", "1500") and e.outcome == "arrested"
    assert str(e.incident_time) == "2021-03-04 09:30:00" and not e.is_missing_person
    empty = one(spark, "", X.entities(F.col("t")).alias("e")).e
    assert empty.suspects == [] and empty.outcome == "unknown" and empty.bail.status == "unknown" and empty.incident_time is None


def test_legacy_entities(spark):
    row = one(spark, "arrested John Roe (44). Jane Poe, 31, of Palmer. Charges of theft.", X.legacy_suspects(F.col("t")).alias("a"), X.legacy_charges(F.col("t")).alias("b"))
    assert [(s.name, s.age) for s in row.a] == [("Jane Poe", 31), ("John Roe", 44)] and row.b == ["theft"]


def test_places(spark):
    row = one(spark, "at Delta Junction", geo.place_of(F.col("t")).alias("a"), geo.place_of(F.lit("deltas")).alias("b"), geo.street_of(F.lit("500 block of main street"), {"main street": (61.0, -149.0)}).alias("c"), geo.agency_point(F.lit("Palmer PD"), jitter=0.02).alias("d"))
    assert row.a.lat == C.PLACES["delta junction"][0] and row.b is None
    assert row.c.lng == pytest.approx(-149.0 - 5 * 0.0016) and abs(row.d.lat - 61.5997) <= 0.02
    assert one(spark, "x", geo.haversine(F.lit(61.0), F.lit(-150.0), F.lit(61.0), F.lit(-149.0)).alias("x")).x == pytest.approx(33.5, abs=0.1)


def test_links(spark):
    page = '<a href="/a/long/article/path/1">A title that is long enough</a><a href="https://x.org/tag/abc-long-path">A title that is long enough</a><a href="/a/long/article/path/1">Again the very same link</a><a href="mailto:x">A title that is long enough</a><a href="/b">Short</a>'
    df = spark.createDataFrame([(page, "https://x.org/")], "h string, b string")
    got = df.select("b", urls.page_links(F.col("h"), F.col("b")).alias("l")).select(urls.article_links(F.col("l"), F.col("b")).alias("x")).first().x
    assert [(r.title, r.link) for r in got] == [("A title that is long enough", "https://x.org/a/long/article/path/1")]
    meta = '<meta property="og:image" content="https://i/1.png"><img src="https://i/logo.png">'
    assert one(spark, meta, urls.image_of(F.col("t")).alias("x")).x == "https://i/1.png"
