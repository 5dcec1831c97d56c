"""Names in texts, either-key deduplication, broken markup."""

import random
import xml.dom.minidom
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quillgrid.functions import extract, markup
from quillgrid.operators import gazetteer, merge, places
from quillgrid.sources import pages, verticals

from .test_whole_tables import held_to_sql


@pytest.mark.parametrize("name", ["gazetteer_entities", "vehicles_and_people", "either_key_first", "closed_markup", "feed_recovery", "street_grid"])
def test_held_to_sql(spark, name):
    assert held_to_sql(spark, name)


def slow_matches(text, names):
    import regex

    words = regex.findall(gazetteer.WORD, (text or "").lower())
    known = {}
    for name, label in names:
        w = tuple(regex.findall(gazetteer.WORD, (name or "").lower()))
        if w:
            known.setdefault(w, set()).add(label)
    out, at = [], 0
    while at < len(words):
        best = max((w for w in known if tuple(words[at : at + len(w)]) == w), key=len, default=None)
        if best:
            out.append((at, len(best), " ".join(best), ",".join(sorted(known[best]))))
        at += len(best) if best else 1
    return out


def test_gazetteer(spark):
    rng = random.Random(5)
    names = [("Anchorage", "place"), ("Fort Yukon", "place"), ("Fort", "word"), ("Fort Yukon River Lodge", "site"), ("a b a", "x"), ("b a b a c", "y"), ("a", "z"), ("a", "w"), ("É-cole", "school"), ("", "none"), (None, "none"), ("...", "none")]
    texts = ["At Fort Yukon River, near FORT  yukon; Anchorage's fort", None, "", "…", "une É cole", "a" * 50_000, "a b " * 3000] + [" ".join(rng.choice("abc") for _ in range(60)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in gazetteer.gazetteer_matches(df, spark.createDataFrame(names, "name string, label string")).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(tuple(r)[1:])
    for i, t in enumerate(texts):
        assert got.get(i, []) == slow_matches(t, names), t and t[:80]
    none = spark.createDataFrame([], "name string, label string")
    assert gazetteer.gazetteer_matches(df, none).count() == 0


def slow_street(text, streets):
    """The rule read off: names from the longest on, as words of the text; a block moves the point."""
    import re

    low = (text or "").lower()
    for name in sorted({n.strip().lower() for n, _, _ in streets if n}, key=lambda n: (-len(n), n)):
        if re.search(r"\b" + re.escape(name) + r"\b", low):
            lat, lng = min((a, b) for n, a, b in streets if n and n.strip().lower() == name)
            block = re.search(r"(\d{1,4})\s+block", low)
            return name, lat, round(lng - (int(block[1]) / 100 * 0.0016 if block else 0), 6)
    return None, None, None


def test_street_grid(spark):
    rng = random.Random(8)
    streets = [("Northern Lights", 61.1, -149.9), ("northern lights Blvd", 61.2, -149.8), ("e/r", 61.3, -149.5), ("E 5th Ave", 61.4, -149.7), ("e 5th ave", 61.3, -149.9), (None, 1.0, 1.0), ("c", 61.5, -149.6), ("a b", 61.6, -149.5), ("b-a", 61.7, -149.4), ("a_b c", 61.8, -149.3), ("a  b", 61.9, -149.2)]
    texts = ["700 block of E 5TH AVE", "Northern  Lights", "at northern lights blvd.", "northern lights blvds 12345 block", "an e/r, not e r", "e r", None, "", "…", "abc c-3", "x" * 40_000, "a b " * 2000]
    texts += ["".join(rng.choice(["a", "b", "c", " ", " ", "-", "_"]) for _ in range(40)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("lat", F.lit("clash"))
    grid = spark.createDataFrame(streets, "name string, lat double, lng double")
    got = {r.id: (r.street, r.lat, r.lng if r.lng is None else round(r.lng, 6)) for r in places.street_points(df, grid, "id", "text").collect()}
    assert got == {i: slow_street(t, streets) for i, t in enumerate(texts)}
    empty = places.street_points(df, grid.limit(0), "id", "text")
    assert empty.count() == len(texts) and empty.filter("street IS NOT NULL").count() == 0
    assert places.street_points(df.limit(0), grid, "id", "text").count() == 0


def test_people_vehicles_height(spark):
    text = "Trooper John Q. Smith met Mr. Abe Lincoln and suspect Jo; the Ford F-150 truck hit a red Yamaha snowmachine, SUV suv SUV. Victim Mary Jones. Height: 5'11\""
    row = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(extract.people(F.col("t"), F.array(F.lit("Mary Jones"))).alias("p"), extract.vehicles(F.col("t")).alias("v"), extract.height(F.col("t")).alias("h")).collect()
    assert row[0].p == ["John Q. Smith", "Abe Lincoln"]
    assert row[0].v == ["Ford F-150 truck", "Yamaha snowmachine", "SUV suv SUV"] or row[0].v[:2] == ["Ford F-150 truck", "Yamaha snowmachine"]
    assert row[0].h == 71 and tuple(row[1]) == ([], [], None) and tuple(row[2]) == ([], [], None)
    heights = {"6 ft": 72, "5 feet 4 inches": 64, "5'2": 62, "height 5-10": 70, "no figure": None, "3'2": None}
    got = spark.createDataFrame([(k,) for k in heights], "t string").select("t", extract.height(F.col("t")).alias("h")).collect()
    assert {r.t: r.h for r in got} == heights


def loop(rows, most=None):
    kept = []
    for r in sorted(rows, key=lambda r: (r[0], r[1] or "", r[2] or "")):
        if not any(k[1] == r[1] or k[2] == r[2] for k in kept):
            kept.append(r)
    return kept[:most]


@pytest.mark.parametrize(("seed", "most"), [(1, None), (2, None), (3, 5), (4, 20)])
def test_either_key_is_the_loop(spark, seed, most):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, *"abcdefghijkl"]), rng.choice([None, *"mnopqrstuvwx"])) for i in range(150)]
    df = spark.createDataFrame(rows, "seq long, url string, title string").repartition(3)
    assert sorted(tuple(r) for r in merge.first_by_either(df, "url", "title", most=most).collect()) == sorted(loop(rows, most))


def test_either_key_of_chains_and_of_nothing(spark):
    # Each row shares a key with the next: every second one stays.
    rows = [(i, f"u{i // 2}", f"t{(i + 1) // 2}") for i in range(9)]
    df = spark.createDataFrame(rows + rows[:1], "seq long, url string, title string")
    assert sorted(tuple(r) for r in merge.first_by_either(df, "url", "title").collect()) == loop(rows)
    assert merge.first_by_either(df.limit(0), "url", "title").count() == 0


def test_district_news(spark):
    rows = [(0, " Short ", "/post/1"), (1, "A long title of a post", "/post/1"), (2, "Another long title", "/POST/1"), (3, "A long title of a post", "/article/9"), (4, "Yet another title", "/post/1"), (5, "District news of the day", "https://x.org/y"), (6, "Not of any interest here", "/about"), (7, "Another long title", "/post/7")]
    df = spark.createDataFrame(rows, "seq long, title string, href string")
    got = verticals.district_news(df, home="https://d.org").orderBy("seq").collect()
    assert [(r.seq, r.url) for r in got] == [(1, "https://d.org/post/1"), (2, "https://d.org/POST/1"), (5, "https://x.org/y")]


class _Balance(HTMLParser):
    """The same automaton over the standard library's tags."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack = []

    def handle_starttag(self, tag, attrs):
        if tag not in markup.VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        assert tag in markup.VOID or (self.stack and self.stack.pop() == tag)


def test_markup_is_closed(spark):
    rng = random.Random(2)
    texts = ["<p><b>x<br><p>y</b> z</div>", "a < b & c", "<!-- no --><![CDATA[<raw>]]>", "</p>", "<P>x</p><img src='a>b'>", "", None, "<a href=\"x\">" * 700 + "</a>" * 300]
    texts += ["".join(rng.choice(["<p>", "</p>", "<b>", "</b>", "<i class='x'>", "</i>", "<br>", "text ", "<hr/>"]) for _ in range(400)) for _ in range(20)]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", markup.close_open(F.col("t")).alias("c"), markup.close_open(markup.close_open(F.col("t"))).alias("again")).orderBy("i").collect()
    assert got[0].c == "<p><b>x<br/><p>y</p></b> z</p>" and got[1].c == "a &lt; b & c" and got[2].c == "<![CDATA[<raw>]]>" and got[3].c == "" and got[5].c == "" and got[6].c is None
    for r in got:
        if r.c is not None and r.i not in (1, 2, 4):
            check = _Balance()
            check.feed(r.c)
            assert not check.stack and r.again == r.c
            xml.dom.minidom.parseString(f"<all>{r.c}</all>")


def test_recovered_entries_keep_nested_markup(spark):
    feed = """<rss><channel><item><title>One <i>of</i> two<link>http://x/1</link><description><p>first <b>bold</p> more <a href="u">link</description><pubDate>now
    <item><title>Two</title><guid>http://x/2</guid><content:encoded><div>second</div></content:encoded><description>other</item></channel>"""
    rows = pages.feed_entries(spark.createDataFrame([(feed,)], "value string")).orderBy("position").collect()
    assert [(r.stage, r.title, r.link, r.description, r.published) for r in rows] == [
        ("recovered", "One of two", "http://x/1", '<p>first <b>bold</b></p> more <a href="u">link</a>', "now"),
        ("recovered", "Two", "http://x/2", "<div>second</div>", None),
    ]


@pytest.mark.parametrize("gram", [2, 3])
def test_contained_is_the_nested_loop(spark, gram):
    from quillgrid.operators import joins

    rng = random.Random(gram)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    texts = [None, "", "a", "zz", *(word(rng.randrange(1, 7)) for _ in range(60))]
    words = [None, "", "a", *(word(rng.randrange(1, 12)) for _ in range(80))]
    t, w = (spark.createDataFrame([(x,) for x in xs], "v string") for xs in (texts, words))
    got = sorted((r.text, r.word) for r in joins.contained(t, "v", w, "v", gram).collect())
    assert got == sorted({(a, b) for a in texts for b in words if a and b and a in b})
    assert joins.contained(t.limit(0), "v", w, "v").count() == 0


def test_routes_meet_without_a_nested_loop(spark):
    from quillgrid.operators import places

    posts = spark.createDataFrame([("seward highway", 1, 60.0, -149.0), ("glenn highway", 1, 61.0, -148.0)], "route string, mile int, lat double, lng double")
    df = spark.createDataFrame([(1, "Seward Hwy", 1.0), (2, "old glenn highway north", 1.2), (3, "glenn", 0.9), (4, "none", 1.0), (5, None, 1.0)], "id int, h string, m double")
    got = places.mileposts(df, posts, F.col("h"), F.col("m"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.id: r.lat for r in got.collect()} == {1: 60.0, 2: 61.0, 3: 61.0, 4: None, 5: None}
