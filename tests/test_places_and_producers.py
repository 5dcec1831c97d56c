from pyspark.sql import functions as F

from quillgrid.operators import linking, places
from quillgrid.plans.engine import SignalEngine
from quillgrid.sources import verticals as v
from quillgrid.sources.signals import adapt


def test_mileposts(spark):
    posts = spark.createDataFrame([("seward highway", 50, 1.0, 2.0), ("seward highway", 53, 3.0, 4.0), ("glenn highway", 10, 5.0, 6.0)], "route string, mile int, lat double, lng double")
    df = spark.createDataFrame([(1, "Seward Hwy", 50.4), (2, "seward", 51.6), (3, "Glenn Highway", 40.0), (4, "Nowhere Hwy", 1.0), (5, None, 1.0)], "id int, h string, m double")
    got = {r.id: (r.route, r.lat) for r in places.mileposts(df, posts, F.col("h"), F.col("m")).collect()}
    assert got == {1: ("seward highway", 1.0), 2: ("seward highway", 3.0), 3: ("glenn highway", None), 4: (None, None), 5: (None, None)}
    assert {r.route: r.lat for r in places.midpoints(posts).collect()} == {"seward highway": 3.0, "glenn highway": 5.0}


def test_fill_places(spark):
    df = spark.createDataFrame([("near Nome", None, None), ("near Nome", 1.0, 2.0), ("x", None, None)], "t string, lat double, lng double")
    assert [r.lat for r in places.fill_places(df, F.col("t")).collect()] == [64.5011, 1.0, None]


def test_tables_and_spills(spark):
    html = "<table><tr><td>old</td></tr></table><table><tr><th>h</th></tr><tr><td>1</td><td>Spill &amp; fire</td><td>1/20/2024</td><td>Nome</td></tr><tr><td>2</td><td>b</td><td>1/1/2023</td><td>x</td></tr><tr><td>3</td></tr></table>"
    got = v.spills(spark.createDataFrame([(html,)], "value string"), F.lit("2024-01-30").cast("timestamp")).collect()
    assert [(r.number, r.title, r.place) for r in got] == [("1", "Spill & fire", "Nome")]


def test_producers(spark):
    rows = spark.createDataFrame([(1, "A", None), (2, None, "x"), (3, None, "x"), (4, "B", None), (5, None, "x")], "position int, city string, name string").withColumn("page", F.lit("p"))
    assert sorted((r.name, r.city) for r in v.venues(rows, "page").collect()) == [("x", "A"), ("x", "B")]
    acts = spark.createDataFrame([(1, "House", None, None), (2, None, "HB1", "Signed by the governor"), (3, "Senate", None, None), (4, None, "SB2", "amended")], "position int, chamber string, bill string, text string").withColumn("s", F.lit(1))
    assert [(r.chamber, r.type) for r in v.legislative_actions(acts, "s").orderBy("position").collect()] == [("House", "executive"), ("Senate", "amendment")]
    fish = spark.createDataFrame([("f", i, f"t{i}", "l", "King salmon opener") for i in range(20)], "feed string, position int, title string, link string, summary string")
    got = v.fisheries(fish).collect()
    assert len(got) == 15 and got[0].type == "opening" and got[0].species == ["salmon"]
    w = v.wildlife(spark.createDataFrame([("t", "l", "Bear attack")], "title string, link string, text string"), F.col("text")).first()
    assert w.impactScore == 85 and len(w.hash) == 64
    assert spark.range(1).select(v.session_status(F.lit("Special Session")).alias("x")).first().x == "special"
    links = spark.createDataFrame([("https://high.d.org/x", "high.d.org"), ("https://www.d.org/school/a", "www.d.org"), ("https://x.org/", "x.org")], "link string, host string")
    assert v.school_sites(links.withColumn("seq", F.lit(1)), F.col("host"), F.lit("www.d.org")).count() == 2
    assert v.permit_notices(spark.createDataFrame([("POA-1 dredging",)], "title string")).first().number == "POA-1"
    assert v.local_bulletins(spark.createDataFrame([("In Kodiak",), ("Elsewhere",)], "t string"), "t", ["kodiak"]).count() == 1


def test_engine(spark):
    engine = SignalEngine("2024-01-30 00:00:00")
    entries = spark.createDataFrame(
        [
            (1, "Src", "Safety", "Tsunami warning in Kodiak", "http://x/1", "All <b>clear</b> later", "2024-01-29T00:00:00Z"),
            (2, "Src", "Safety", "Tsunami warning in Kodiak", "http://x/1", "again", "2024-01-29T00:00:00Z"),
            (3, "Src", "Safety", "Second report", "http://x/2", "Kodiak wildfire", "2024-01-29T10:00:00Z"),
            (4, "Src", "News", "Seen before", "http://x/3", "text", "2024-01-29T10:00:00Z"),
            (5, "Src", "News", "", "http://x/4", "text", "2024-01-29T10:00:00Z"),
            (6, "Src", "News", "Ancient", "http://x/5", "text", "2001-01-29T10:00:00Z"),
        ],
        "seq int, source string, category string, title string, link string, description string, published string",
    )
    from quillgrid.functions.keys import title_link_key

    seen = entries.filter("seq = 4").select(title_link_key(F.col("title"), F.col("link")).alias("hash"))
    fresh = engine.enrich(entries, seen)
    got = {r.title: r for r in fresh.collect()}
    assert set(got) == {"Tsunami warning in Kodiak", "Second report"}
    first = got["Tsunami warning in Kodiak"]
    assert (first.impactScore, first.urgency, first.region, first.sector, first.summary) == (100, "now", "Gulf Coast", "safety", "All clear later")
    assert first.dataTag == "[Region: Gulf Coast] [Category: Safety]"
    merged = engine.merge(fresh.limit(0), fresh)
    assert {r.title: len(r.relatedSignalIds) for r in merged.collect()} == {"Tsunami warning in Kodiak": 1, "Second report": 1}
    assert engine.rolling(merged).count() == 2 and {r["index"]: r["score"] for r in engine.pulse(merged).collect()}["health"] > 0
    assert [x.count() for x in engine.slices(merged)] == [2, 2]


def test_engine_sorts_neither_texts_nor_scans(spark, monkeypatch):
    entries = spark.range(9).selectExpr("id AS seq", "'Src' AS source", "'News' AS category", "concat('Title ', id) AS title", "concat('http://x/', id) AS link", "repeat('long ', 9) AS description", "'2024-01-29T00:00:00Z' AS published")
    filed = spark.range(9).selectExpr("cast(id AS string) AS hash", "'Title' AS title", "'http://x/' AS link", "'2024-01-20T00:00:00Z' AS timestamp")
    written = []
    monkeypatch.setattr(linking, "settled", lambda df, *a: written.append(df) or df)
    engine = SignalEngine("2024-01-30 00:00:00")
    engine.merge(adapt(filed), engine.enrich(entries, spark.createDataFrame([], "hash string")))
    below = lambda node: [node.children().apply(i) for i in range(node.children().size())]
    nodes = [written[0]._jdf.queryExecution().executedPlan().initialPlan()]
    sorts = []
    while nodes:
        node = nodes.pop()
        nodes += below(node)
        if node.nodeName() == "Sort":
            sorts.append(node)
    assert sorts
    for node in sorts:
        assert not {"description", "__t"} & {node.output().apply(i).name() for i in range(node.output().size())}
        inside = [node]
        while inside:  # down to where the rows were dealt out
            inside += [n for n in below(inside.pop()) if "Exchange" not in n.nodeName()]
            assert all(below(n) for n in inside), node.toString()
