import json

import pytest
from pyspark.sql import functions as F

from quillgrid.sources import feeds, pages, signals


def docs(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def test_adapt_and_union(spark):
    a = spark.createDataFrame([("i1", "t", "http://x", "body", "2024-01-01T00:00:00Z")], "id string, title string, articleUrl string, content string, published string")
    b = spark.createDataFrame([("h", "t", "", "http://y", "2024-01-01T00:00:00", 5)], "hash string, title string, link string, url string, timestamp string, impactScore int")
    got = {r.hash: r for r in signals.union([signals.adapt(a, "A"), signals.adapt(b, "B")]).collect()}
    assert got["i1"].link == "http://x" and got["i1"].summary == "body" and got["i1"].ts_has_offset and got["i1"].source == "A"
    assert got["h"].link == "http://y" and not got["h"].ts_has_offset and got["h"].impactScore == 5
    assert signals.adapt(b, strict_link=True).first().link is None


def test_read_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"hash": "h", "title": "t", "timestamp": "2024-01-01"}]))
    assert signals.read_existing(spark, [f"{tmp_path}/a.json", f"{tmp_path}/none.json"]).first().hash == "h"
    assert signals.read_existing(spark, [f"{tmp_path}/none.json"]).count() == 0


def test_quakes(spark):
    f = lambda i, mag, lat: {"id": i, "properties": {"mag": mag, "time": 1704067200000, "tsunami": 1}, "geometry": {"type": "Point", "coordinates": [-150.0, lat, 5.0]}}
    got = signals.quakes(docs(spark, {"features": [f("a", 2.0, 61.0), f("b", 1.0, 61.0), f("c", 3.0, 10.0)]})).collect()
    assert [(r.id, r.tsunami, str(r.ts)) for r in got] == [("a", True, "2024-01-01 00:00:00")]


def test_alerts(spark):
    ring = [[-150.0, 60.0], [-148.0, 60.0], [-149.0, 63.0]]
    p = {"id": "x", "event": "Gale", "severity": "Severe", "urgency": "Expected", "description": "d" * 600, "areaDesc": "a" * 60, "sent": "2024-01-01T00:00:00Z"}
    df = docs(spark, {"features": [{"properties": p, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": p | {"id": "y", "severity": "Minor"}, "geometry": None}]})
    rows = {r.id: r for r in signals.alerts(df).collect()}
    assert rows["x"].lat == 61.0 and rows["x"].lng == -149.0 and len(rows["x"].description) == 500 and rows["y"].lat is None
    got = signals.alert_signals(signals.alerts(df), ["Gale"]).collect()
    assert [(r.impactScore, r.urgency, r.region, len(r.summary)) for r in got] == [(80, "now", "Statewide", 400)]


def test_other_geojson(spark):
    o = {"properties": {"temperature": {"value": -10.0}, "windSpeed": {"value": 5.0}}, "geometry": {"coordinates": [-150.0, 61.0]}}
    assert signals.observations(docs(spark, o).withColumn("station", F.lit("P"))).first().temp_f == 14.0
    f = {"attributes": {"IrwinID": "i", "DailyAcres": 0, "CalculatedAcres": 7.5, "PercentContained": 100}, "geometry": {"x": -150.0, "y": 61.0}}
    assert signals.fires(docs(spark, {"features": [f]})).first().acres == 7.5
    at = F.lit("2024-01-20").cast("timestamp")
    pt = lambda n, s, out: {"properties": {"NAME": n, "RECORDNUMBER": n, "STATUS": s, "OUTDATE": out}, "geometry": {"coordinates": [1.0, 2.0]}}
    got = signals.fire_points(docs(spark, {"features": [pt("a", "Out", 1704067200000), pt("b", "Out", 1705536000000), pt("", "Active", None), pt("c", "Active", None)]}), at).collect()
    assert [r.name for r in got] == ["b", "c"]
    n = lambda c, lv: {"observatory": "AVO", "noticeNumber": c, "volcanoName": "V", "content": "<p>x</p>", "alertLevel": lv, "aviationColorCode": c, "volcanoes": [{"latitude": 1.0, "longitude": 2.0}]}
    got = signals.volcano_notices(docs(spark, [n("GREEN", "NORMAL"), n("ORANGE", "WATCH"), n("RED", "NORMAL") | {"observatory": "X"}])).collect()
    assert [(r.impactScore, r.summary, r.lat) for r in got] == [(75, "x...", 1.0)]


def test_observations_round_half_even_by_tenths(spark):
    o = {"properties": {"windSpeed": {"value": 50.0}, "temperature": {"value": 0.25}}}  # 111.85000000000001 and 32.45
    r = signals.observations(docs(spark, o).withColumn("station", F.lit("P"))).first()
    assert (r.wind_mph, r.temp_f) == (111.8, 32.4)


def test_roads_and_skies(spark):
    e = {"id": "1", "eventType": "closure", "road": "Seward Hwy", "description": "x" * 400, "startPoint": {"latitude": 61.0, "longitude": -149.0}}
    for wrapped in ([e], {"events": [e]}, {"features": [{"properties": e}]}):
        r = signals.road_events(docs(spark, wrapped)).first()
        assert (r.urgency, r.impactScore, r.region, r.lat, len(r.summary)) == ("now", 70, "Southcentral", 61.0, 300)
    assert signals.cameras(docs(spark, [{"id": "c", "views": [{"url": "u"}]}, {"id": "d", "views": []}])).filter("url IS NULL").count() == 1
    t = [{"notam": "1", "state": "AK", "lat": "x"}, {"notam": "2", "state": "TX"}, {"notam": "3", "state": "", "lat": "61", "lng": "-150"}, {"notam": "4", "lat": "10", "lng": "10"}]
    assert sorted(r.id for r in signals.flight_restrictions(docs(spark, t)).collect()) == ["1", "3"]
    a = spark.createDataFrame([("A",), ("B",), ("C",)], "code string")
    r = spark.createDataFrame([("A", 200, True, False), ("B", None, None, True)], "code string, http int, delay boolean, failed boolean")
    assert {x.code: x.status for x in signals.airport_status(a, r).collect()} == {"A": "delayed", "B": "unknown", "C": "normal"}
    assert signals.municipal_notices(docs(spark, {"d": {"results": [{"Id": 1, "Title": "t" * 151}]}})).first().title == "t" * 150 + "..."
    known = spark.createDataFrame([("k", 1)], "id string, seq int")
    sales = {"features": [{"properties": {"FILENUMBER": i, "CSSTTSDSCR": s}} for i, s in (("a", "Open"), ("b", "CLOSED sale"), ("k", "Open"))]}
    assert [x.id for x in signals.land_sales(docs(spark, sales), known).collect()] == ["a", "k"]


def test_feed_entries(spark):
    rss = "<rss><channel><title>T</title><item><title>A &nbsp; B & C</title><link>http://x/1</link><description>d</description><pubDate>p</pubDate></item><item><title>Two</title><guid>http://x/2</guid></item></channel></rss>"
    atom = '<feed><title>T</title><entry><title>E</title><link href="http://y"/><summary>s</summary><updated>u</updated></entry></feed>'
    got = pages.feed_entries(docs(spark, rss, atom, "<rss>broken")).drop("value").collect()
    assert [(r.title.replace("\xa0", " "), r.link) for r in got] == [("A   B & C", "http://x/1"), ("Two", "http://x/2"), ("E", "http://y")]
    assert got[2].published == "u" and got[2].description == "s"


def test_feed_entries_of_bytes(spark):
    rows = [(bytearray(b"\xef\xbb\xbf<rss><channel><item><title>\xffA &deg; \xef\xbf\xbd</title><link>l</link></item></channel></rss>"), "http://s.org"), (None, "http://s.org"), (bytearray(), None), (bytearray(b"<item"), "http://s.org"), (bytearray(b"<rss><item><title><![CDATA[x <b>]]></title><guid>g</guid><item><title>two"), None)]
    got = pages.feed_entries(spark.createDataFrame(rows, "value binary, page string"), base="page").collect()
    assert [(r.stage, r.position, r.title, r.link) for r in got] == [("parsed", 0, "A ° \ufffd", "l"), ("recovered", 0, "x <b>", "g"), ("recovered", 1, "two", None)]


@pytest.mark.parametrize("entry, image", [
    ('<media:thumbnail url="a"/><media:content url="b" medium="image"/>', "a"),
    ('<media:content url="b" type="image/gif"/><enclosure url="c" type="image/png"/>', "b"),
    ('<media:content url="b" medium="video"/><enclosure url="v" type="audio/x"/><enclosure url="c" type="image/png"/>', "c"),
    ('<description>&lt;img src="http://d/e.png"&gt;</description>', "http://d/e.png"),
    ('<description>&lt;img src="http://tracker/e.png"&gt;</description>', None),
    ("<content:encoded><![CDATA[<meta property='og:image' content='f'><img src='g'>]]></content:encoded><description>s</description>", "f"),
])
def test_image_of_an_entry(spark, entry, image):
    xml = f'<rss xmlns:media="m" xmlns:content="c"><channel><item><title>T</title><link>l</link>{entry}</item></channel></rss>'
    assert [(r.stage, r.image) for r in pages.feed_entries(docs(spark, xml)).collect()] == [("parsed", image)]


def test_front_page_stands_for_a_feed_that_is_gone():
    from quillgrid.sources.feeds import _Feed, feed_source

    answers = {"http://s.org/feed": (404, "no"), "http://s.org": (200, "front"), "http://t.org/feed": (500, "bad")}
    read = lambda u: list(feed_source(lambda url, timeout: answers[url], [("n", u)])({}).reader(None).read(_Feed("n", u)))
    assert read("http://s.org/feed") == [("n", 1, "http://s.org", 200, "front", None)]
    assert read("http://t.org/feed") == [("n", 1, "http://t.org/feed", 500, "bad", None)]


def test_sitemaps(spark):
    robots = docs(spark, "User-agent: *\nSitemap: http://x/root.xml\n")
    fetched = spark.createDataFrame([("http://x/root.xml", "<sitemapindex><sitemap><loc>http://x/a.xml</loc></sitemap></sitemapindex>"), ("http://x/a.xml", "<urlset><url><loc> http://x/p1 </loc></url></urlset>")], "location string, value string")
    roots = pages.robots_sitemaps(robots).withColumnRenamed("sitemap", "location")
    assert [r.location for r in pages.sitemap_tree(roots, fetched).collect()] == ["http://x/p1"]
    h = '<link rel="alternate" type="application/rss+xml" href="/feed"><link rel="x" href="/y">'
    assert docs(spark, h).select(pages.alternate_feeds(F.col("value")).alias("x")).first().x == ["/feed"]
    c = spark.createDataFrame([("d", "u2", 2), ("d", "u1", 1)], "domain string, url string, rank int")
    assert pages.best_candidate(c, "domain", [F.col("rank")]).first().url == "u1"
    assert {r.url for r in pages.replace_urls(c.select("url"), spark.createDataFrame([("u1", "n")], "url string, new_url string")).collect()} == {"n", "u2"}


def test_dispatch_and_archives(spark):
    t = "Location: Palmer\nType: Theft\nDispatch Text: John Doe (30) was arrested. Posted on 1/2/2021 3:04:05 PM by DPS\\X\nLocation: Homer\nType: Fire\nDispatch Text: none Posted on bad"
    got = pages.dispatch_blocks(docs(spark, t)).collect()
    assert [(r.location, r.type, str(r.ts)) for r in got] == [("Palmer", "Theft", "2021-01-02 15:04:05"), ("Homer", "Fire", "None")]
    assert got[0].entities.outcome == "arrested"
    block = "Trooper report. arrested John Roe (44). " + "x" * 200
    assert pages.legacy_blocks(docs(spark, f"{block}\n\nshort\n\n{block}")).count() == 1
    m = [["timestamp", "original"], ["20200102030405", "http://www.x.com/a/"], ["20210102030405", "https://x.com/a"]]
    assert [str(r.ts) for r in pages.archive_manifest(docs(spark, m)).collect()] == ["2020-01-02 03:04:05"]
    h = '<body class="x"><br><base href="y"><h1>Old</h1><td>cell</td><meta property="og:title" content="Mid"><article>body</article><script type="application/ld+json">{"headline":"New","description":"d"}</script>'
    row = docs(spark, h).select(*[pages.article_of(F.col("value"), F.lit(y)).alias(f"y{y}") for y in (2005, 2015, 2022)]).first()
    assert [(x.title, x.body) for x in row] == [("Old", "cell"), ("Mid", "body"), ("New", "d")]


def test_registers(spark, tmp_path):
    (tmp_path / "m.csv").write_text(" Last Name , First Name,Case Number ,Sex,Race,Investigating Agency,Date Last Contacted\nDOE,JANE ,1,F,,AST PALMER,01/02/2020\nDOE,JON,1,M,,AST,bad\n,X,2,M,,AST,\n")
    got = pages.missing_persons(spark, f"{tmp_path}/m.csv").collect()
    assert [(r.id, r.name, r.location, str(r.last_contact)) for r in got] == [("AK-DPS-1", "Jane Doe", "Palmer", "2020-01-02")]
    rows = "".join(f"{'V' + str(i) if i else ''},L{i},AST KENAI,2000,Ford F150,PK,RED,AK,C{i},d,t\n" for i in range(12))
    (tmp_path / "v.csv").write_text("Vin ,License,Agency,PropertyModelYear,MakeModel,Style,Color,State,Case,Date,Type\n" + rows)
    got = {r.case_id: r for r in pages.stolen_vehicles(spark, f"{tmp_path}/v.csv").collect()}
    assert got["C0"].title == "Stolen plate: L0" and got["C11"].page == 2 and got["C1"].summary == "RED | PK | L1 | V1"


def test_feed_source(spark):
    def fetch(url, timeout):
        if "bad" in url:
            raise OSError("Name or service not known")
        return (200, "<rss/>") if "paged=3" not in url else (404, "")

    got = feeds.read_feeds(spark, fetch, [("a", "http://a/feed"), ("b", "http://bad/feed")], pages=5).collect()
    assert sorted((r.feed, r.page, r.status) for r in got if r.status) == [("a", 1, 200), ("a", 2, 200)]
    assert [r.error for r in got if r.error] == ["OSError: Name or service not known"]
    catalog = spark.createDataFrame([("a", "u", "c"), ("b", "u", "c"), ("c", "u", "c")], "name string, url string, category string")
    held = spark.createDataFrame([("b",)], "name string")
    state = spark.createDataFrame([("c", "2030-01-01")], "name string, x string").select("name", F.col("x").cast("timestamp").alias("next_check"))
    assert [r.name for r in feeds.due_feeds(catalog, held, state, F.lit("2024-01-01").cast("timestamp")).collect()] == ["a"]
    row = spark.range(1).select(pages.feed_status(F.lit(200), F.lit(0), F.lit(None)).alias("a"), pages.proxy_status(F.lit(503), F.lit(1), F.lit(None)).alias("b"), pages.grant_deadline(F.array(F.lit("x"), F.lit("1/2/2025"))).alias("c"), pages.seasonal(F.lit("2024-07-01").cast("date")).alias("d")).first()
    assert tuple(row) == ("warning", "HTTP 503", "1/2/2025", "summer")
