"""Queries of single producers, page facts, and what is published; each input varies by row. SQL as in queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import catalogs as C
from ..functions import extract as X
from ..functions import text, times
from ..operators import filters, publish
from ..sources import pages, signals, verticals
from .frames import EVENTS, events, table
from .queries import _features, query

DAY = "2000-06-01"


def _at(moment: str):
    return F.lit(moment).cast("timestamp")


def _case(column: str, values: dict, default: object) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


# ---- producers of JSON


@query(f"""SELECT seq AS station, sector AS conditions, ((user_id % 60 - 30) * 18 + 320)::BIGINT AS temp_tenths, (round(round_even(value * 2.237::DOUBLE, 1) * 10))::BIGINT AS wind_tenths,
  (seq % 360)::BIGINT AS wind_direction, round_even((seq % 97)::DOUBLE + 0.5::DOUBLE, 0)::BIGINT AS humidity, lat, lng FROM {EVENTS}""")
def station_observations(spark, d):
    e, value = events(spark, d), lambda c: F.struct(c.cast("double").alias("value"))
    p = {"timestamp": F.col("ts").cast("string"), "textDescription": F.col("sector"), "temperature": value(F.col("user_id") % 60 - 30), "windSpeed": value(F.col("value")), "windDirection": value(F.col("seq") % 360), "relativeHumidity": value(F.col("seq") % 97 + F.lit(0.5))}
    doc = F.to_json(F.struct(F.struct(F.array("lng", "lat").alias("coordinates")).alias("geometry"), F.struct(*[c.alias(k) for k, c in p.items()]).alias("properties")))
    got = signals.observations(e.select("seq", doc.alias("value")), station="seq")
    tenths = lambda c: F.round(F.col(c) * 10).cast("long")
    return got.select(F.col("seq").alias("station"), "conditions", tenths("temp_f").alias("temp_tenths"), tenths("wind_mph").alias("wind_tenths"), F.col("wind_direction").cast("long").alias("wind_direction"), F.col("humidity").cast("long").alias("humidity"), "lat", "lng")


@query(f"""SELECT coalesce(r, k::VARCHAR) AS id, 'Fire '||k AS name, CASE WHEN k % 3 <> 0 THEN (k % 50)::DOUBLE + 0.5::DOUBLE ELSE CASE WHEN k % 4 = 0 THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END END AS acres, status
FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'R'||o_orderkey END AS r, CASE WHEN o_orderkey % 5 = 0 THEN 'Out' ELSE 'Active' END AS status, o_orderdate AS t FROM orders)
WHERE k % 7 <> 0 AND NOT (status = 'Out' AND date_diff('day', t::DATE, DATE '{DAY}') > 7)""")
def fire_point_source(spark, d):
    k = F.col("o_orderkey")
    p = {
        "NAME": F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("Fire "), k)), "RECORDNUMBER": F.when(k % 2 == 0, F.concat(F.lit("R"), k)), "OBJECTID": k, "ESTIMATEDTOTALACRES": F.when(k % 3 == 0, 0.0).otherwise(k % 50 + F.lit(0.5)),
        "IASIZE": F.when(k % 4 == 0, 1.5), "STATUS": F.when(k % 5 == 0, "Out").otherwise("Active"), "OUTDATE": F.unix_millis(F.col("o_orderdate").cast("timestamp")),
    }
    docs = _features(table(spark, d, "orders"), F.struct(F.struct(*[c.alias(n) for n, c in p.items()]).alias("properties")), F.floor(k / 200))
    return signals.fire_points(docs, _at(DAY)).select("id", "name", "acres", "status")


_COLORS, _LEVELS = ["GREEN", "Yellow", "ORANGE", "RED", "green", "odd"], ["NORMAL", "ADVISORY", "Watch", "WARNING", "WATCH", "odd"]


@query(f"""SELECT md5('N'||seq) AS hash, 'Mount '||user_id AS title, substring(trim('p '||repeat(sector||' ', (seq % 120)::INT), ' '), 1, 400)||'...' AS summary, greatest({_case("upper(color)", C.VOLCANO_IMPACT, C.VOLCANO_DEFAULT)}, {_case("upper(level)", C.VOLCANO_IMPACT, C.VOLCANO_DEFAULT)}) AS "impactScore", lat
FROM (SELECT *, {_COLORS!r}[(seq % 6 + 1)::INT] AS color, {_LEVELS!r}[(seq % 6 + 1)::INT] AS level FROM {EVENTS}) WHERE seq % 4 <> 0 AND NOT (upper(color) = 'GREEN' AND upper(level) = 'NORMAL')""")
def volcano_source(spark, d):
    e, k = events(spark, d), F.col("seq")
    pick = lambda names: F.get(F.array(*map(F.lit, names)), (k % 6).cast("int"))
    content = F.concat(F.lit("<b>p</b> "), F.expr("repeat(concat(sector, '<br> '), cast(seq % 120 AS int))"))
    p = {"observatory": F.when(k % 4 == 0, "HVO").otherwise("AVO"), "noticeNumber": F.concat(F.lit("N"), k), "volcanoName": F.concat(F.lit("Mount "), "user_id"), "content": content, "alertLevel": pick(_LEVELS), "aviationColorCode": pick(_COLORS), "volcanoes": F.array(F.struct(F.col("lat").alias("latitude"), F.col("lng").alias("longitude")))}
    docs = e.groupBy(F.floor(k / 50).alias("g")).agg(F.to_json(F.collect_list(F.struct(*[c.alias(n) for n, c in p.items()]))).alias("value"))
    return signals.volcano_notices(docs).select("hash", "title", "summary", "impactScore", "lat")


@query(f"""SELECT 'cam'||seq AS id, sector AS name, lat, lng, CASE WHEN seq % 3 > 0 THEN 'http://cam/'||seq||'/0' END AS url FROM {EVENTS}""")
def camera_source(spark, d):
    e, k = events(spark, d), F.col("seq")
    view = lambda i: F.struct(F.concat(F.lit("http://cam/"), k, F.lit(f"/{i}")).alias("url"))
    views = F.slice(F.array(view(0), view(1)), F.lit(1), (k % 3).cast("int"))
    cam = F.struct(F.concat(F.lit("cam"), k).alias("id"), F.col("sector").alias("name"), F.col("lat").alias("latitude"), F.col("lng").alias("longitude"), views.alias("views"))
    return signals.cameras(e.groupBy(F.floor(k / 100).alias("g")).agg(F.to_json(F.collect_list(cam)).alias("value")))


@query(f"""SELECT 'T'||seq AS id, CASE WHEN seq % 2 = 0 THEN sector ELSE 'reason '||user_id END AS description, CASE seq % 4 WHEN 0 THEN 'AK' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'WA' END AS state, CASE WHEN seq % 6 <> 0 THEN lat - (seq % 5) * 5 END AS lat
FROM {EVENTS} WHERE seq % 4 <> 3 AND NOT (seq % 6 <> 0 AND lat - (seq % 5) * 5 < 50)""")
def flight_restriction_source(spark, d):
    e, k = events(spark, d), F.col("seq")
    lat = F.when(k % 6 != 0, (F.col("lat") - (k % 5) * 5).cast("string"))
    t = F.struct(
        F.when(k % 2 == 0, F.concat(F.lit("T"), k)).alias("notam"), F.when(k % 2 == 1, F.concat(F.lit("T"), k)).alias("notamNumber"), F.when(k % 2 == 0, F.col("sector")).alias("description"), F.concat(F.lit("reason "), "user_id").alias("reason"),
        F.when(k % 4 == 0, "AK").when(k % 4 == 1, "").when(k % 4 == 3, "WA").alias("state"), F.when(k % 3 == 0, lat).alias("lat"), F.when(k % 3 != 0, lat).alias("latitude"), F.col("lng").cast("string").alias("lng"),
    )
    docs = e.groupBy(F.floor(k / 100).alias("g")).agg(F.to_json(F.collect_list(t)).alias("value"))
    return signals.flight_restrictions(docs).select("id", "description", "state", "lat")


@query("""SELECT md5(doc_id::VARCHAR) AS hash, CASE WHEN length(text) > 150 THEN substring(text, 1, 150)||'...' ELSE text END AS title, CASE WHEN doc_id % 3 = 0 THEN 'start '||doc_id ELSE 'created '||doc_id END AS "timestamp" FROM documents""")
def municipal_source(spark, d):
    k = F.col("doc_id")
    row = F.struct(k.alias("Id"), F.col("text").alias("Title"), F.concat(F.lit("created "), k).alias("Created"), F.when(k % 3 == 0, F.concat(F.lit("start "), k)).alias("PublicNoticeEventStart"))
    return signals.municipal_notices(table(spark, d, "documents").select(F.to_json(F.struct(F.struct(F.array(row).alias("results")).alias("d"))).alias("value")))


@query("""SELECT id, seq FROM (SELECT id, side, seq, row_number() OVER (ORDER BY side, seq, id) AS n FROM (
  SELECT * FROM (SELECT 'S'||c_custkey AS id, 0 AS side, 0::BIGINT AS seq FROM customer WHERE c_custkey % 6 NOT IN (0, 1) AND c_custkey % 5 <> 0 ORDER BY 1 LIMIT 10) UNION ALL SELECT 'S'||c_custkey, 1, c_custkey FROM customer WHERE c_custkey % 5 = 0)) WHERE n <= 500""")
def land_sale_source(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    p = F.struct(F.when(k % 2 == 0, F.concat(F.lit("S"), k)).alias("FILENUMBER"), F.concat(F.lit("S"), k).alias("CASE_ID"), F.when(k % 6 == 0, "Closed").when(k % 6 == 1, "APPL REJECTED").when(k % 6 == 2, "open").alias("CSSTTSDSCR"), F.col("c_name").alias("CSTMRNM"))
    known = c.filter(k % 5 == 0).select(F.concat(F.lit("S"), k).alias("id"), k.alias("seq"))
    return signals.land_sales(_features(c, F.struct(p.alias("properties")), F.floor(k / 100)), known)


# ---- producers of pages and tables


@query("""SELECT c_custkey::VARCHAR AS number, c_mktsegment||' & Co' AS title, strftime(DATE '2021-01-01' + (c_custkey % 30)::INT, '%Y-%m-%d') AS day, sha256(c_custkey||'|'||c_mktsegment||' & Co') AS hash FROM customer WHERE c_custkey % 30 >= 16 AND c_custkey % 11 <> 0""")
def spill_register(spark, d):
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2021-01-01"), (k % 30).cast("int")), "M/d/yyyy")
    cell = lambda c: F.concat(F.lit("<td class=x> "), c, F.lit("</td>"))
    cells = F.concat(cell(k.cast("string")), cell(F.concat("c_mktsegment", F.lit(" &amp; <b>Co</b>"))), cell(day), F.when(k % 11 == 0, "").otherwise(cell(F.lit("Kenai"))))
    rows = F.array_join(F.collect_list(F.concat(F.lit("<tr>"), cells, F.lit("</tr>"))), "\n")
    html = F.concat(F.lit("<table><tr><td>1</td><td>a</td><td>1/30/2021</td><td>b</td></tr></table><TABLE id=t><tr><th>n</th></tr>"), rows, F.lit("</TABLE>"))
    got = verticals.spills(table(spark, d, "customer").groupBy(F.floor(k / 50).alias("g")).agg(html.alias("value")), _at("2021-01-31"))
    return got.select("number", "title", F.col("day").cast("string").alias("day"), "hash")


_SAID = ["The House ADJOURNED its session", "a Special Session is called", "now in Session", "no news"]


@query(f"""SELECT page_id, CASE WHEN contains(low, 'adjourned') OR contains(low, 'sine die') THEN 'adjourned' WHEN contains(low, 'special session') THEN 'special' WHEN contains(low, 'session') THEN 'in_session' ELSE 'unknown' END AS session,
  CASE WHEN page_id % 12 + 1 IN (12, 1, 2) THEN 'winter' WHEN page_id % 12 + 1 <= 5 THEN 'spring' WHEN page_id % 12 + 1 <= 8 THEN 'summer' ELSE 'autumn' END AS season, list_filter(cells, lambda c: contains(c, '/') OR contains(c, '202'))[-1] AS deadline,
  n % 20 < 10 OR contains(low, 'stand by') OR contains(low, 'news') AS flag, CASE WHEN n % 5 = 0 THEN 'error' WHEN n % 7 = 1 THEN 'missing' WHEN n % 7 = 2 THEN 'HTTP 500' WHEN size = 0 THEN 'empty' ELSE 'ok' END AS proxy,
  CASE WHEN n % 5 = 0 OR n % 7 IN (1, 2) THEN 'error' WHEN size = 0 THEN 'warning' ELSE 'ok' END AS feed
FROM (SELECT page_id, lower(html)||' '||lower((['{"', '".join(_SAID)}'])[page_id % 4 + 1]) AS low, length(html) AS n, len(regexp_extract_all(html, '<li>')) % 4 AS size,
  list_concat(list_transform(regexp_extract_all(html, '<li><a href="/([^"]*)"', 1), lambda x, i: CASE WHEN (i + page_id) % 4 = 0 THEN x||'/'||i WHEN (i + page_id) % 9 = 0 THEN x||' 2024' ELSE x END), ['x']) AS cells FROM pages)""")
def page_facts(spark, d):
    """Rules over whole pages: what is said in them, the links as a row's cells, their size as brightness and answer."""
    k, n = F.col("page_id"), F.length("html")
    said = F.concat("html", F.lit(" "), F.element_at(F.array(*map(F.lit, _SAID)), (k % 4 + 1).cast("int")))
    links = F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)"'), 1)
    cell = lambda x, i: F.when((i + 1 + k) % 4 == 0, F.concat(x, F.lit("/"), i + 1)).when((i + 1 + k) % 9 == 0, F.concat(x, F.lit(" 2024"))).otherwise(x)
    cells = F.concat(F.transform(links, cell), F.array(F.lit("x")))
    month = F.make_timestamp(F.lit(2024), (k % 12 + 1).cast("int"), F.lit(15), F.lit(0), F.lit(0), F.lit(0))
    http = F.when(n % 7 == 1, 404).when(n % 7 == 2, 500).otherwise(200)
    error, size = F.when(n % 5 == 0, "timeout"), F.size(F.regexp_extract_all("html", F.lit("<li>"), 0)) % 4
    return table(spark, d, "pages").select(
        "page_id", verticals.session_status(said).alias("session"), pages.seasonal(month).alias("season"), pages.grant_deadline(cells).alias("deadline"), pages.frame_flag(said, n % 20, ["stand by", "news"]).alias("flag"),
        pages.proxy_status(http, size, error).alias("proxy"), pages.feed_status(http, size, error).alias("feed"),
    )


@query("""SELECT c_custkey, 'Ann '||s||':'||(20 + c_custkey % 70) AS suspects, 'theft '||c_custkey AS charges FROM (SELECT *, upper(substring(c_mktsegment, 1, 1))||lower(substring(c_mktsegment, 2)) AS s FROM customer) WHERE c_custkey % 4 <> 0""")
def trooper_paragraphs(spark, d):
    k, s = F.col("c_custkey"), F.initcap("c_mktsegment")
    body = F.concat(F.lit("The "), F.when(k % 4 == 0, "Police").otherwise("Troopers"), F.lit(" contacted Ann "), s, F.lit(", "), 20 + k % 70, F.lit(", of Kenai,\nwho was arrested for theft "), k, F.lit(". "), F.lit("The road was closed for an hour and traffic went round by the old bridge. " * 3), F.lit("Case "), k)
    docs = table(spark, d, "customer").groupBy("c_custkey").agg(F.first(F.concat(F.lit("Trooper log\n\n"), body, F.lit("\n \n"), body, F.lit("\n\nshort Trooper"))).alias("value"))
    got = pages.legacy_blocks(docs)
    number = F.regexp_extract("block", r"Case (\d+)", 1).cast("long").alias("c_custkey")
    return got.select(number, F.array_join(F.transform("suspects", lambda p: F.concat(p["name"], F.lit(":"), p["age"])), "|").alias("suspects"), F.array_join("charges", "|").alias("charges"))


@query("""SELECT c_custkey, CASE WHEN k = 0 THEN 0.123::DOUBLE END AS bac, CASE WHEN k = 1 THEN 'FCC' WHEN k = 2 THEN 'Goose Creek' END AS facility, CASE k WHEN 0 THEN 'denied' WHEN 1 THEN 'set' WHEN 2 THEN 'released_OR' WHEN 3 THEN 'cited_released' ELSE 'unknown' END AS bail, CASE WHEN k = 1 THEN c_custkey::VARCHAR END AS amount,
  CASE WHEN k = 2 THEN 'Palmer Police|Alaska Wildlife '||c_custkey ELSE '' END AS co_agencies, CASE WHEN k = 3 THEN 'Segment '||c_custkey||' Road' WHEN k = 4 THEN 'Mile 12.5 Parks Highway' END AS address, CASE WHEN k = 0 THEN 'heroin|rifle' WHEN k = 4 THEN 'meth' ELSE '' END AS contraband,
  k = 4 AS missing, CASE WHEN k IN (1, 2) THEN strftime(DATE '2021-01-01' + (c_custkey % 28)::INT, '%Y-%m-%d')||' 09:05:00' END AS at, CASE WHEN k = 3 THEN 40 + c_custkey % 20 WHEN k = 4 THEN 31 ELSE 0 END AS age FROM (SELECT *, c_custkey % 5 AS k FROM customer)""")
def dispatch_details(spark, d):
    c = F.col("c_custkey")
    k, day = c % 5, F.date_format(F.date_add(F.lit("2021-01-01"), (c % 28).cast("int")), "M/d/yyyy")
    said = (
        F.when(k == 0, "A sample showed .123 BrAC. Heroin and a rifle were seized, no bail.")
        .when(k == 1, F.concat(F.lit("On "), day, F.lit(", at approximately 905 hours a person was taken to fcc. Bail was set at $"), c, F.lit(".")))
        .when(k == 2, F.concat(F.lit("on "), day, F.lit(" at 0905 hours, with the assistance of Palmer Police and Alaska Wildlife "), c, F.lit(". Remanded to Goose Creek, released on recognizance.")))
        .when(k == 3, F.concat(F.lit("A driver was seen near Segment "), c, F.lit(" Road. A citation was given. Age: "), 40 + c % 20, F.lit(", DOB 1/1/1950.")))
        .otherwise("Silver Alert: last seen, mile 12.5 of the Parks Highway. Meth was found. Date of Birth: 07-16-1992")
    )
    t = F.col("said")
    return table(spark, d, "customer").select("c_custkey", said.alias("said")).select(
        "c_custkey", X.blood_alcohol(t).alias("bac"), X.facility(t)["code"].alias("facility"), X.bail(t)["status"].alias("bail"), X.bail(t)["amount"].alias("amount"), F.array_join(X.co_agencies(t), "|").alias("co_agencies"), X.address_detail(t).alias("address"),
        F.array_join(X.contraband(t), "|").alias("contraband"), X.is_missing_person(t).alias("missing"), F.date_format(X.incident_time(t), "yyyy-MM-dd HH:mm:ss").alias("at"), X.bulletin_age(t, _at("2024-07-15")).cast("long").alias("age"),
    )


@query("""SELECT doc_id AS seq, split_part(text, ' ', 1) AS number, CASE WHEN contains(lower(text), ' the ') THEN 85 ELSE 60 END AS impact, CASE WHEN contains(lower(text), ' de ') THEN sha256(text) END AS local FROM documents""")
def local_notices(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("title"), F.lit("http://x/").alias("link"))
    rows = verticals.wildlife(verticals.permit_notices(docs), F.col("title"), urgent=(" the ",)).drop("hash")
    found = verticals.local_bulletins(docs.select("seq", "title"), "title", [" de "]).select("seq", F.col("hash").alias("local"))
    return rows.join(found, "seq", "left").select("seq", "number", F.col("impactScore").alias("impact"), "local")


@query("""SELECT name, city, min(position) AS position FROM (SELECT p_name AS name, position, last_value(CASE WHEN p_size = 1 THEN 'City '||p_partkey END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY position ROWS UNBOUNDED PRECEDING) AS city, p_size FROM (SELECT *, p_partkey AS position FROM part))
WHERE p_size <> 1 GROUP BY name, city""")
def venue_rows(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("page"), F.col("p_partkey").alias("position"), F.when(F.col("p_size") != 1, F.col("p_name")).alias("name"), F.when(F.col("p_size") == 1, F.concat(F.lit("City "), "p_partkey")).alias("city"))
    return verticals.venues(p, "page").select("name", "city", "position")


# ---- discovery


@query("""SELECT host, count(*) AS n, min(path) AS first, max(path) AS last FROM (SELECT DISTINCT page_id % 9 AS host, 'http://h'||(page_id % 9)||'/p'||page_id AS path FROM pages WHERE page_id % 9 < 8) GROUP BY host""")
def discovered_pages(spark, d):
    """robots.txt to an index to sitemaps; host 8 has its sitemap a level too deep."""
    p, k = table(spark, d, "pages"), F.col("page_id") % 9
    url = F.concat(F.lit("http://h"), k, F.lit("/"))
    hosts = p.select(k.alias("h"), url.alias("u")).distinct()
    at = lambda name: F.concat("u", F.lit(name))
    index = lambda where, to: hosts.select(at(where).alias("location"), F.concat(F.lit("<sitemapindex><sitemap><loc> "), at(to), F.lit(" </loc></sitemap></sitemapindex>")).alias("value"))
    maps = p.groupBy(k.alias("h"), url.alias("u")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(F.concat(F.lit("<url><loc>"), url, F.lit("p"), "page_id", F.lit("</loc></url>"))), "\n"), F.lit("</urlset>")).alias("value"))
    maps = maps.select(F.when(F.col("h") == 8, at("deep.xml")).otherwise(at("map.xml")).alias("location"), "value")
    deeper = hosts.filter("h = 8").select(at("map.xml").alias("location"), F.concat(F.lit("<sitemapindex><sitemap><loc>"), at("deep0.xml"), F.lit("</loc></sitemap></sitemapindex>")).alias("value"))
    deepest = hosts.filter("h = 8").select(at("deep0.xml").alias("location"), F.concat(F.lit("<sitemapindex><sitemap><loc>"), at("deep.xml"), F.lit("</loc></sitemap></sitemapindex>")).alias("value"))
    fetched = index("index.xml", "map.xml").unionByName(maps).unionByName(deeper).unionByName(deepest)
    roots = pages.robots_sitemaps(hosts.select(F.concat(F.lit("User-agent: *\n  SITEMAP: "), at("index.xml"), F.lit("\nDisallow: /a\n")).alias("value"))).withColumnRenamed("sitemap", "location")
    found = pages.sitemap_tree(roots, fetched).withColumn("host", F.regexp_extract("location", r"^http://h(\d+)/", 1).cast("long"))
    return found.groupBy("host").agg(F.count("*").alias("n"), F.min("location").alias("first"), F.max("location").alias("last"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '/rss/'||page_id||'|/atom' WHEN page_id % 3 = 1 THEN '/rss/'||page_id ELSE '' END AS feeds, CASE WHEN page_id % 10 = 0 THEN 'http://new/'||page_id ELSE url END AS url FROM pages""")
def alternate_feeds(spark, d):
    p, k = table(spark, d, "pages"), F.col("page_id")
    rss = F.concat(F.lit('<link rel="alternate" type="application/rss+xml" href="/rss/'), k, F.lit('"><link rel="icon" type="image/png" href="/i">'))
    head = F.when(k % 3 == 0, F.concat(rss, F.lit("<LINK type='application/atom+xml' title='x' href='/atom'>"))).when(k % 3 == 1, rss).otherwise("")
    moved = p.filter(k % 10 == 0).select("url", F.concat(F.lit("http://new/"), k).alias("new_url"), k.alias("of"))
    catalog = p.select("page_id", "url", F.array_join(pages.alternate_feeds(F.concat(head, "html")), "|").alias("feeds"))
    # URLs of pages can repeat; the replacement of a page is its own.
    return pages.replace_urls(catalog.withColumn("url", F.concat("url", F.lit("#"), "page_id")), moved.withColumn("url", F.concat("url", F.lit("#"), "of")).drop("of")).select("page_id", "feeds", F.regexp_replace("url", r"#\d+$", "").alias("url"))


@query("""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n = 1""")
def best_candidates(spark, d):
    return pages.best_candidate(table(spark, d, "documents").select("source", "doc_id", "n_chars"), "source", [F.desc("n_chars"), F.col("doc_id")]).select("source", "doc_id")


# ---- rules and times


@query("""SELECT c_custkey, c_mktsegment = 'AUTOMOBILE' AS stolen, c_mktsegment IN ('MACHINERY', 'FURNITURE') AS included, c_custkey % 3 = 0 AS web, c_custkey % 4 = 0 AS dns, CASE WHEN c_custkey % 5 = 0 THEN 90 ELSE 60 END AS impact, CASE WHEN c_custkey % 5 = 0 THEN 'now' ELSE 'background' END AS urgency,
  c_custkey % 6 = 0 OR c_custkey % 28 < 15 AS due, c_custkey % 2 = 0 OR c_custkey % 7 <> 0 AS dated FROM customer""")
def rule_flags(spark, d):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    impact, urgency = filters.escalate(k % 5 == 0)
    due = F.when(k % 6 != 0, F.date_add(F.lit("2021-01-01"), (k % 28).cast("int")).cast("timestamp"))
    return table(spark, d, "customer").select(
        "c_custkey", filters.is_stolen_vehicle(F.when(seg == "AUTOMOBILE", "A Stolen Vehicle was seen").otherwise("vehicle"), seg).alias("stolen"), filters.event_included(seg, ["Machinery", "Furniture"]).alias("included"),
        filters.is_web_link(F.when(k % 3 == 0, "https://x").when(k % 3 == 1, "mailto:x")).alias("web"), filters.is_dns_failure(F.when(k % 4 == 0, "x: Name or service not known").otherwise("timeout"), ["Name or service not known", "getaddrinfo"]).alias("dns"),
        impact.alias("impact"), urgency.alias("urgency"), filters.is_due(due, _at("2021-01-15")).alias("due"),
        filters.dated_or_stamped(F.when(k % 4 == 0, _at(DAY)), F.when(k % 4 == 2, F.to_date(F.lit(DAY))), F.when(k % 7 == 0, "Troopers").otherwise("News"), ["Troopers"]).alias("dated"),
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d')||CASE WHEN o_orderkey % 3 = 2 THEN ' 00:00:00' ELSE ' 15:04:00' END AS posted, strftime(o_orderdate, '%Y-%m-%d') AS compact, year(o_orderdate)::VARCHAR AS year, CASE WHEN o_orderkey % 2 = 0 THEN lpad(month(o_orderdate)::VARCHAR, 2, '0') END AS month,
  (o_orderkey % 1000)::DOUBLE / 10 AS latency, 30 - CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS age, strftime(o_orderdate, '%Y-%m-%d') AS millis, 'x\ty'||o_orderkey AS plain, CASE WHEN o_orderkey % 2 = 0 THEN 'a-b' ELSE 'b' END AS parts FROM orders""")
def time_texts(spark, d):
    k, t = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    posted = F.when(k % 3 == 0, F.date_format(t, "M/d/yyyy' 3:04:00 PM by DPS\\x'")).when(k % 3 == 1, F.date_format(t, "M/d/yyyy' 3:04 PM'")).otherwise(F.date_format(t, "M/d/yyyy"))
    compact = F.when(k % 2 == 0, F.date_format(t, "yyyyMMddHHmmss")).otherwise(F.date_format(t, "yyyyMMdd'x'"))
    year, month = times.month_parts(F.when(k % 2 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm")).otherwise(F.date_format(t, "yyyy-'09'")))
    born = F.add_months(t.cast("date"), -360) + F.when(k % 2 == 0, 1).otherwise(0)
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_format(times.posted_time(posted), "yyyy-MM-dd HH:mm:ss").alias("posted"), F.date_format(times.compact_time(compact), "yyyy-MM-dd").alias("compact"), year.alias("year"), F.when(k % 2 == 0, month).alias("month"),
        times.latency_hours(t, t + F.make_dt_interval(mins=(k % 1000 * 6).cast("int"))).alias("latency"), times.age_on(born, t.cast("date")).alias("age"), F.date_format(times.epoch_millis(F.unix_millis(t)), "yyyy-MM-dd").alias("millis"),
        text.strip_controls(F.concat(F.lit("x\x00\x1b\ty\x7f"), k)).alias("plain"), text.join_parts("-", F.when(k % 2 == 0, "a").otherwise(""), F.lit("b")).alias("parts"),
    )


@query("""SELECT c_custkey AS seq, strftime(DATE '2021-01-01' + (c_custkey % 900)::INT, '%Y-%m-%d') AS snapshot_date FROM customer WHERE c_custkey % 9 <> 0 AND DATE '2021-01-01' + (c_custkey % 900)::INT < DATE '2023-01-01' - 365""")
def expired_snapshots(spark, d):
    k = F.col("c_custkey")
    day = F.when(k % 9 == 0, "latest").otherwise(F.date_add(F.lit("2021-01-01"), (k % 900).cast("int")).cast("string"))
    return publish.expired_snapshots(table(spark, d, "customer").select(k.alias("seq"), day.alias("snapshot_date")), _at("2023-01-01"))


# ---- publishing


@query("""SELECT '<?xml version="1.0" encoding="UTF-8"?>'||chr(10)||'<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'||chr(10)||string_agg('  <sitemap><loc>https://x/'||source||'.xml</loc><lastmod>2024-01-30</lastmod></sitemap>', chr(10) ORDER BY source)||chr(10)||'</sitemapindex>'||chr(10) AS xml FROM (SELECT DISTINCT source FROM documents)""")
def sitemap_index(spark, d):
    return publish.sitemap_index(table(spark, d, "documents").select(F.col("source").alias("slug")).distinct(), "https://x", "2024-01-30")


@query("""SELECT '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>T</title><link>http://t</link>'||string_agg('<item><title>'||replace(replace(replace(p_name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')||' &amp; &lt;'||p_partkey||'&gt;</title><link>http://p/'||p_partkey||'</link><description></description></item>', '' ORDER BY p_size DESC, p_partkey)||'</channel></rss>' AS value
FROM (SELECT * FROM part ORDER BY p_size DESC, p_partkey LIMIT 150)""")
def rss_feed(spark, d):
    p = table(spark, d, "part").select(F.concat("p_name", F.lit(" & <"), "p_partkey", F.lit(">")).alias("title"), F.concat(F.lit("http://p/"), "p_partkey").alias("link"), F.lit(None).cast("string").alias("description"), "p_size", "p_partkey")
    return publish.rss(p, "T", "http://t", [F.desc("p_size"), F.col("p_partkey")])


@query("""SELECT '{"kind":"parts","count":'||count(*)||',"items":['||string_agg('{"p_partkey":'||p_partkey||',"p_size":'||p_size||'}', ',' ORDER BY p_size, p_partkey DESC)||']}' AS value FROM (SELECT * FROM part ORDER BY p_size, p_partkey DESC LIMIT 1000)""")
def part_snapshot(spark, d):
    return publish.snapshot(table(spark, d, "part").select("p_partkey", "p_size"), {"kind": "parts"}, [F.col("p_size"), F.desc("p_partkey")])


@query("""SELECT '<h1>Feeds: '||(SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0)||' of '||(SELECT count(*) FROM customer)||' healthy</h1><table>'||string_agg('<tr><td>'||c_name||'</td><td>'||CASE WHEN c_custkey % 2 = 0 THEN 'a &lt; b' ELSE '' END||'</td></tr>', '' ORDER BY c_name)||'</table>' AS value
FROM (SELECT * FROM customer WHERE c_custkey % 3 = 0 ORDER BY c_name LIMIT 100)""")
def health_html(spark, d):
    c = table(spark, d, "customer").withColumn("bad", F.col("c_custkey") % 3 == 0)
    summary = c.agg(F.count_if(~F.col("bad")).alias("healthy"), F.count("*").alias("total"))
    return publish.health_page(summary, c.filter("bad").select(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, "a < b").alias("error")))
