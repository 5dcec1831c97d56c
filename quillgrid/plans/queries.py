"""One query for each operator over the test tables, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalogs as C
from ..functions import extract as X
from ..functions import geo, keys, text, times, urls
from ..functions.rules import contains_any
from ..operators import aggregates, filters, joins, linking, merge, publish, ranking
from ..streaming import state
from .frames import AS_OF, DOCUMENTS, EVENTS, as_of, documents, events, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Catalogs over words that the test tables have.
REGION_WORDS = [("north", [" the ", " of the"]), ("south", [" der ", " und "]), ("east", [" que ", " del "]), ("west", [" le ", " des "])]
ENTITY_WORDS = [("t", ["the "]), ("d", ["die ", "das "]), ("l", ["les ", "los "]), ("q", ["qui "])]
SCORES = [(40, "category", ["de"]), (35, "text", [" of ", " von "]), (20, "text", ["###", "!!"]), (-25, "category", ["es", "fr"]), (12, "text", [" la "])]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _cases(column: str, rules, default: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({column}, '{w}')" for w in words) + f" THEN '{label}'" for label, words in rules) + f" ELSE '{default}' END"


# ---- keys and text


@query(f"""SELECT seq, hash, 'AK-'||substring(hash,1,8) AS short, 'x_'||source||'_'||seq AS composite, 'p-'||md5(summary) AS text_md5, sha256(title) AS title_sha FROM {DOCUMENTS}""")
def md5_key(spark, d):
    return documents(spark, d).select(
        "seq", "hash", keys.short_key("AK", F.col("hash")).alias("short"), keys.composite_key("x", F.col("source"), F.col("seq").cast("string")).alias("composite"),
        keys.text_key(F.col("summary"), "p-").alias("text_md5"), keys.sha_key(F.col("title")).alias("title_sha"),
    )


def _clean_sql(c: str) -> str:
    for code, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        c = f"replace({c}, '{code}', '{plain}')"
    for p in (r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"<[^>]+>"):
        c = f"regexp_replace({c}, '{p}', ' ', 'g')"
    return rf"trim(regexp_replace({c}, '[\s\x{{00A0}}\x{{0085}}\x0B]+', ' ', 'g'), ' ')"


@query(f"""SELECT page_id, length(t) AS n, md5(t) AS m FROM (SELECT page_id, {_clean_sql("html")} AS t FROM pages)""")
def clean_html_text(spark, d):
    t = text.clean_text(F.col("html"))
    return table(spark, d, "pages").select("page_id", t.alias("t")).select("page_id", F.length("t").alias("n"), F.md5(F.col("t").cast("binary")).alias("m"))


@query(f"""SELECT seq, CASE WHEN length(t)=0 THEN '{C.SNIPPET_EMPTY}' ELSE rtrim(substring(t,1,lim),' ') || CASE WHEN length(t)>lim THEN '...' ELSE '' END END AS snippet
FROM (SELECT seq, t, least(1000, greatest(least(300,length(t)), floor(length(t)*0.10::DOUBLE)::INT)) AS lim FROM (SELECT seq, {_clean_sql("summary")} AS t FROM {DOCUMENTS}))""")
def snippet(spark, d):
    return documents(spark, d).select("seq", text.clean_text(F.col("summary")).alias("t")).select("seq", text.snippet_of_clean(F.col("t")).alias("snippet"))


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name||' & '||p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part""")
def slugify(spark, d):
    return table(spark, d, "part").select("p_partkey", text.slug(F.concat("p_name", F.lit(" & "), "p_brand")).alias("slug"))


@query(f"""SELECT seq, tag, array_to_string(regexp_extract_all(tag, ':\\s*([^\\]]+)\\]', 1), '|') AS parts, regexp_extract(tag, '\\[Region:\\s*([^\\]]+)\\]', 1) AS region
FROM (SELECT seq, '[Region: '||{_cases("lower(title||' '||summary)", REGION_WORDS, "Statewide")}||'] [Category: '||category||']' AS tag FROM {DOCUMENTS})""")
def data_tag(spark, d):
    df = documents(spark, d)
    tag = text.data_tag(filters.region(F.lower(F.concat("title", F.lit(" "), "summary")), REGION_WORDS), F.col("category"))
    return df.select("seq", tag.alias("tag")).select("seq", "tag", F.array_join(text.tag_values(F.col("tag")), "|").alias("parts"), text.tag_region(F.col("tag")).alias("region"))


@query(f"""SELECT seq, CASE WHEN length(summary)>300 THEN substring(summary,1,297)||'...' ELSE summary END AS a, CASE WHEN length(summary)>150 THEN substring(summary,1,150)||'...' ELSE summary END AS b,
  substring(summary,1,400)||'...' AS c FROM {DOCUMENTS}""")
def truncate_text(spark, d):
    s = F.col("summary")
    return documents(spark, d).select("seq", text.truncate(s, 300, 297).alias("a"), text.truncate(s, 150).alias("b"), text.truncate(s, 400, always=True).alias("c"))


_PLAIN = "regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g')"


def _plain_documents(spark, d):
    """doc_id and the whole text, characters beyond ASCII as x, so that both sides agree on words and cases."""
    return table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[^\\x00-\\x7F]", "x").alias("t"))


def _points_sql(points) -> str:
    return ", ".join(f"({i}, '{n}', {p[0]!r}::DOUBLE)" for i, (n, p) in enumerate(points))


def _nth(values, k):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k + 1).cast("int"))


def _nth_sql(values, k: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[({k} + 1)::INT]"


def _agency_sql(c: str) -> str:
    for part in C.AGENCY_NOISE:
        c = f"replace({c}, '{part}', '')"
    return c


@query(f"""SELECT doc_id, md5(CASE WHEN a = '' THEN '{C.AGENCY_UNKNOWN}' WHEN {" OR ".join(f"contains(u, '{w}')" for w in C.AGENCY_CITY_WORDS)} THEN '{C.AGENCY_CITY}' WHEN trim(u) = '' THEN '{C.AGENCY_UNKNOWN}'
  ELSE array_to_string(list_transform(string_split(lower(trim(u)), ' '), lambda w: upper(w[1])||w[2:]), ' ') END) AS place FROM (
  SELECT doc_id, a, {_agency_sql("upper(a)")} AS u FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 11 = 1 THEN 'AST dps' ELSE regexp_replace({_PLAIN}, '[^A-Za-z]+', ' ', 'g')||{_nth_sql(["", " Borough", " police department", " AST Enforcement"], "doc_id % 4")} END AS a FROM documents))""")
def clean_agency(spark, d):
    """Whole texts as names, with parts that are cut out; a text may have them within its words."""
    k = F.col("doc_id")
    name = F.concat(F.regexp_replace("t", "[^A-Za-z]+", " "), _nth(["", " Borough", " police department", " AST Enforcement"], k % 4))
    name = F.when(k % 11 == 0, "").when(k % 11 == 1, "AST dps").otherwise(name)
    return _plain_documents(spark, d).select("doc_id", F.md5(text.clean_agency(name).cast("binary")).alias("place"))


@query("""SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, 'https://'||regexp_extract(url, '^https?://([^/:?#]+)', 1)||'/favicon.ico' AS icon,
  regexp_replace(regexp_replace(url, '^https?://(www\\.)?', ''), '/+$', '') AS bare FROM pages""")
def url_parts(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.domain(u).alias("host"), urls.favicon(u).alias("icon"), urls.without_protocol(u).alias("bare"))


@query("""SELECT page_id, count(*) AS n, string_agg(title, '|' ORDER BY i) AS titles FROM (
  SELECT page_id, i, a[2] AS title, link, row_number() OVER (PARTITION BY page_id, link ORDER BY i) AS r, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k FROM (
   SELECT page_id, i, [h, t] AS a, host||h AS link FROM (
    SELECT page_id, 'http'||CASE WHEN starts_with(url,'https') THEN 's' ELSE '' END||'://'||regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h,
      unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS t, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) AS i FROM pages)))
  WHERE r = 1 GROUP BY page_id""")
def page_links(spark, d):
    p = table(spark, d, "pages")
    links = p.select("page_id", urls.page_links(F.col("html"), F.col("url")).alias("x"))
    picked = urls.article_links(F.col("x"), F.lit(""), least_title=0, longer=0, most=1000)
    return links.select("page_id", picked.alias("y")).filter(F.size("y") > 0).select("page_id", F.size("y").cast("long").alias("n"), F.array_join(F.transform("y", lambda v: v["title"]), "|").alias("titles"))


# ---- time


@query("""SELECT o_orderkey, strftime(try_cast(CASE WHEN o_orderkey % 10 = 0 THEN '1999-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE), '%Y-%m-%d') AS day,
  CASE WHEN o_orderkey % 10 = 0 THEN '1999' ELSE strftime(o_orderdate, '%Y') END AS y FROM orders""")
def url_dates(spark, d):
    o = table(spark, d, "orders")
    url = F.concat(F.lit("https://x.org/"), F.when(F.col("o_orderkey") % 10 == 0, "1999/13/01").otherwise(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy/MM/dd")), F.lit("/a"))
    iso = F.concat_ws("-", F.when(F.col("o_orderkey") % 10 == 0, "1999").otherwise(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy")), F.lit("01-01"))
    return o.select("o_orderkey", F.date_format(times.url_date(url), "yyyy-MM-dd").alias("day"), times.month_parts(iso)[0].alias("y"))


@query("""SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y%m%d%H%M%S') AS compact, strftime(ts, '%Y-%m-%d %H:%M:%S') AS back,
  round_even((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 3600000000.0::DOUBLE, 1) AS latency FROM events""")
def time_parsing(spark, d):
    e = events(spark, d).withColumn("ms", F.unix_millis("ts")).withColumn("compact", F.date_format("ts", "yyyyMMddHHmmss"))
    back = times.compact_time(F.col("compact"))
    return e.select(F.col("seq").alias("event_id"), "ms", "compact", F.date_format(back, "yyyy-MM-dd HH:mm:ss").alias("back"), times.latency_hours(F.col("ts"), F.lit("2024-02-01").cast("timestamp")).alias("latency"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 3 = 1 THEN '2001-05-06' ELSE '2024-01-30' END AS day,
  2024 - year(o_orderdate) - CASE WHEN month(o_orderdate)*100+day(o_orderdate) > 130 THEN 1 ELSE 0 END AS age FROM orders""")
def published_and_age(spark, d):
    o = table(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    k = F.col("o_orderkey") % 3
    feed = F.when(k == 0, F.col("t"))
    url = F.when(k == 1, F.lit("2001-05-06").cast("date"))
    day = times.resolve_published(feed, url, as_of())
    return o.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), times.age_on(F.col("t"), F.to_date(as_of())).alias("age"))


# ---- filters and classes


@query(f"""SELECT seq, (
  (trim(lower(title))='' AND lower(summary)='') OR (contains(trim(lower(title)),'wp-content/uploads') AND starts_with(trim(lower(title)),'http')) OR regexp_matches(trim(lower(title)), '\\.(jpg|jpeg|png|gif|webp)$')
  OR (regexp_matches(trim(title,' '), '^[0-9]+$') AND length(trim(summary,' '))<80) OR regexp_matches(lower(summary), '\\{{\\s*"?url"?\\s*:') OR contains(lower(summary),'islcp') OR contains(lower(summary),'viewport')
  OR (NOT contains(source,'fire') AND ({_clean_sql("lower(summary)")} = trim(lower(title),' ') OR {_clean_sql("lower(summary)")} = ''))) AS bad FROM {DOCUMENTS}""")
def bad_item_filter(spark, d):
    return documents(spark, d).select("seq", filters.is_bad_item(F.col("title"), F.col("link"), F.col("summary"), F.col("source")).alias("bad"))


@query(f"""SELECT seq, category FROM {DOCUMENTS} WHERE starts_with(link,'http') AND title<>'' AND NOT (contains(source,'src1') AND (contains(lower(summary),' of ') OR contains(lower(summary),' von ')))
  AND (NOT contains(source,'src2') OR contains(lower(summary),' de '))""")
def feed_noise(spark, d):
    s, f = F.col("summary"), F.col("source")
    ok = filters.is_web_link(F.col("link")) & filters.has_title_and_link(F.col("title"), F.col("link")) & ~filters.is_noise(s, f, [" of ", " von "], ["src1"]) & filters.is_local(s, f, [" de "], ["src2"])
    return documents(spark, d).filter(ok).select("seq", "category")


@query(f"""SELECT seq FROM (SELECT seq, CASE WHEN seq % 97 = 0 THEN NULL ELSE ts + to_days(CAST(CASE WHEN seq % 10 = 0 THEN 40 WHEN seq % 11 = 0 THEN -10000 ELSE 0 END AS INTEGER)) END AS t FROM {EVENTS})
  WHERE t >= TIMESTAMP '2000-01-01' AND t <= TIMESTAMP '{AS_OF}' + INTERVAL 2 DAY""")
def anomaly_filter(spark, d):
    k = F.col("seq")
    shift = F.when(k % 10 == 0, 40).when(k % 11 == 0, -10000).otherwise(0)
    df = events(spark, d).withColumn("t", F.when(k % 97 == 0, None).otherwise(F.col("ts") + F.make_dt_interval(days=shift)))
    return merge_kept(df)


def merge_kept(df):
    return filters.split_anomalies(df, "t", as_of())[0].select("seq")


@query("""SELECT o_orderkey FROM orders WHERE floor((epoch_us(TIMESTAMP '2005-01-01') - epoch_us(o_orderdate)) / 86400000000.0::DOUBLE) <= 3650""")
def age_cap(spark, d):
    o = table(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    return o.filter(filters.young_enough(F.col("t"), F.lit("2005-01-01").cast("timestamp"))).select("o_orderkey")


@query(f"""SELECT seq FROM {EVENTS} WHERE lat BETWEEN 60.1 AND 60.3 AND lng BETWEEN -149.95 AND -149.7""")
def bounding_box(spark, d):
    return events(spark, d).filter(geo.in_box(F.col("lat"), F.col("lng"), 60.1, 60.3, -149.95, -149.7)).select("seq")


@query("""SELECT page_id, CASE WHEN regexp_matches(lower(url), '(\\.xml|\\.rss|\\.atom|/feed|/rss)$') THEN 'direct_feed' WHEN regexp_matches(lower(url), 'feed|rss|atom|blog|news|articles|press|media|updates|stories|posts') THEN 'page' END AS kind
  FROM (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN url||'/feed' WHEN page_id % 7 = 1 THEN url||'/news/x' ELSE url END AS url FROM pages)""")
def feed_candidates(spark, d):
    k = F.col("page_id") % 7
    url = F.when(k == 0, F.concat("url", F.lit("/feed"))).when(k == 1, F.concat("url", F.lit("/news/x"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", filters.feed_candidate(url).alias("kind"))


@query(f"""SELECT seq, {_cases("lower(summary)", REGION_WORDS, "Statewide")} AS region, {_cases("lower(summary)", C.TAG_REGIONS, C.STATEWIDE)} AS tag_region, {_cases("lower(summary)", C.TYPED_REGIONS, C.STATEWIDE)} AS typed,
  {_cases("lower(summary)", C.ARTICLE_REGIONS, C.STATEWIDE)} AS article, {_cases("lower(summary)", C.ROAD_REGIONS, C.STATEWIDE)} AS road, {_cases("lower(summary)", C.DISPATCH_REGIONS, C.STATEWIDE)} AS dispatch FROM {DOCUMENTS}""")
def first_match_region(spark, d):
    t = F.col("t")
    kinds = {"region": REGION_WORDS, "tag_region": C.TAG_REGIONS, "typed": C.TYPED_REGIONS, "article": C.ARTICLE_REGIONS, "road": C.ROAD_REGIONS, "dispatch": C.DISPATCH_REGIONS}
    return documents(spark, d).select("seq", F.lower("summary").alias("t")).select("seq", *[filters.region(t, r).alias(k) for k, r in kinds.items()])


def _labels_sql(rules) -> str:
    items = ", ".join(f"CASE WHEN {' OR '.join(f'''contains(lower(summary), '{w}')''' for w in words)} THEN '{label}' END" for label, words in rules)
    return f"coalesce(array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ','), '')"


@query(f"""SELECT seq, {_labels_sql(ENTITY_WORDS)} AS entities, {_labels_sql(C.ENTITIES)} AS known, {_labels_sql(C.SPECIES)} AS species FROM {DOCUMENTS}""")
def multi_label_entities(spark, d):
    t = F.col("t")  # lower case once, not once a word
    return documents(spark, d).select("seq", F.lower("summary").alias("t")).select("seq", *[F.array_join(filters.entity_slugs(t, r), ",").alias(k) for k, r in (("entities", ENTITY_WORDS), ("known", C.ENTITIES), ("species", C.SPECIES))])


def _score_sql(rules) -> str:
    terms = [f"CASE WHEN {'category IN (' + ','.join(repr(w) for w in words) + ')' if kind == 'category' else ' OR '.join(f'''contains(t, '{w}')''' for w in words)} THEN {weight} ELSE 0 END" for weight, kind, words in rules]
    return f"greatest(10, least(100, 30 + {' + '.join(terms)}))"


@query(f"""SELECT seq, score, CASE WHEN score>=80 THEN 'now' WHEN score>=50 THEN 'soon' ELSE 'background' END AS urgency, usual FROM (
  SELECT seq, {_score_sql(SCORES)} AS score, {_score_sql(C.SCORE_RULES)} AS usual FROM (SELECT seq, category, lower(title||' '||summary) AS t FROM {DOCUMENTS}))""")
def impact_score(spark, d):
    df = documents(spark, d).select("seq", "category", F.lower(F.concat("title", F.lit(" "), "summary")).alias("t"))
    df = df.select("seq", filters.impact_score(F.col("category"), F.col("t"), SCORES).alias("score"), filters.impact_score(F.col("category"), F.col("t")).alias("usual"))
    return df.select("seq", "score", filters.urgency(F.col("score")).alias("urgency"), "usual")


_SECTOR_KEYS = sorted(C.SECTORS)


@query(f"""SELECT c_custkey, CASE c_custkey % 31 {" ".join(f"WHEN {i} THEN '{C.SECTORS[k]}'" for i, k in enumerate(_SECTOR_KEYS))} ELSE 'governance' END AS sector FROM customer""")
def sector_lookup(spark, d):
    category = F.coalesce(F.get(F.array(*[F.lit(k) for k in _SECTOR_KEYS]), (F.col("c_custkey") % 31).cast("int")), F.lit("Weather"))
    return table(spark, d, "customer").select("c_custkey", filters.sector(category).alias("sector"))


@query(f"""SELECT page_id, {_cases("url", [(a, ["/" + w for w in ws]) for a, ws in C.URL_CATEGORIES], "News")} AS category FROM (
  SELECT page_id, url||CASE page_id % 4 WHEN 0 THEN '/crime/x' WHEN 1 THEN '/outdoors' WHEN 2 THEN '/oil-gas' ELSE '' END AS url FROM pages)""")
def url_category(spark, d):
    k = F.col("page_id") % 4
    url = F.concat("url", F.when(k == 0, "/crime/x").when(k == 1, "/outdoors").when(k == 2, "/oil-gas").otherwise(""))
    return table(spark, d, "pages").select("page_id", filters.url_category(url).alias("category"))


_NOTE = ["the committee met", "signed by the governor", "read the first time", "sonar count today", "closed until May", "opener for king salmon", "amended", ""]


@query(f"""SELECT doc_id, {_cases("n", C.FISHERIES_TYPES, "update")} AS fish, {_cases("n", C.LEGISLATIVE_ACTIONS, "general")} AS act FROM (
  SELECT doc_id, lower({_PLAIN})||' '||{_nth_sql(_NOTE, "doc_id % 8")}||' '||{_nth_sql(_NOTE, "(doc_id // 8) % 8")} AS n FROM documents)""")
def notice_types(spark, d):
    """Whole texts, each with two notes behind it: the first rule with a word anywhere wins."""
    k = F.col("doc_id")
    n = F.concat_ws(" ", F.lower("t"), _nth(_NOTE, k % 8), _nth(_NOTE, F.floor(k / 8) % 8))
    return _plain_documents(spark, d).select("doc_id", n.alias("n")).select("doc_id", filters.fisheries_type(F.col("n")).alias("fish"), filters.legislative_action(F.col("n")).alias("act"))


_SEVERITY, _COLOR, _ROAD = ["Extreme", "Severe", "Moderate", "Minor", "Unknown", "Odd"], ["RED", "ORANGE", "YELLOW", "GREEN", "NONE"], ["closures", "roadwork", "incident", "other"]


def _map_sql(expr: str, names: list[str], table_: dict, default) -> str:
    show = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {show(table_.get(n, default))}" for i, n in enumerate(names)) + " END"


@query(f"""SELECT event_id, {_map_sql("event_id % 6", _SEVERITY, C.ALERT_IMPACT, 40)} AS alert, greatest({_map_sql("event_id % 5", _COLOR, C.VOLCANO_IMPACT, 20)}, 40) AS volcano,
  {_map_sql("event_id % 4", _ROAD, C.ROAD_URGENCY, "background")} AS road, CASE WHEN {_map_sql("event_id % 4", _ROAD, C.ROAD_URGENCY, "background")} = 'now' THEN 70 ELSE 40 END AS road_impact FROM events""")
def alert_levels(spark, d):
    pick = lambda names: F.get(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names)).cast("int"))
    road, impact = filters.road_levels(pick(_ROAD))
    return table(spark, d, "events").select("event_id", filters.alert_levels(pick(_SEVERITY), F.lit("Past"))[0].alias("alert"), filters.volcano_score(pick(_COLOR), F.lit("ADVISORY")).alias("volcano"), road.alias("road"), impact.alias("road_impact"))


# ---- extraction


_REPORT = ("'On 3/'||(c_custkey % 28 + 1)||'/2021 at approximately 930 hours, Customer Name ('||(c_custkey % 110)||') was '||CASE c_custkey % 4 WHEN 0 THEN 'arrested for theft, assault and burglary' WHEN 1 THEN 'cited for speeding' "
           "WHEN 2 THEN 'released without bail' ELSE 'safely located' END||'. Bail set at $'||(c_custkey*10)||'. '||CASE WHEN c_custkey % 3 = 0 THEN 'Remanded to FCC' ELSE '' END")  # fmt: skip


@query(f"""SELECT c_custkey, CASE WHEN a BETWEEN 5 AND 100 THEN 'Customer Name:'||a ELSE '' END AS suspects,
  CASE k WHEN 0 THEN 'theft|assault|burglary' WHEN 1 THEN 'speeding' ELSE '' END AS charges, CASE WHEN k = 2 THEN 'denied' ELSE 'set' END AS bail, CASE WHEN k <> 2 THEN (c_custkey*10)::VARCHAR END AS amount,
  CASE k WHEN 0 THEN 'arrested' WHEN 3 THEN 'rescued' WHEN 1 THEN 'cited' ELSE 'released' END AS outcome, CASE WHEN c_custkey % 3 = 0 THEN 'FCC' END AS facility,
  '2021-03-'||lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0')||' 09:30' AS happened FROM (SELECT c_custkey, c_custkey % 110 AS a, c_custkey % 4 AS k FROM customer)""")
def dispatch_entities(spark, d):
    df = table(spark, d, "customer").select("c_custkey", F.expr(_REPORT).alias("t"))
    e = df.select("c_custkey", X.entities(F.col("t")).alias("e"))
    return e.select(
        "c_custkey", F.array_join(F.transform("e.suspects", lambda s: F.concat(s["name"], F.lit(":"), s["age"])), "|").alias("suspects"), F.array_join("e.charges", "|").alias("charges"),
        F.col("e.bail.status").alias("bail"), F.col("e.bail.amount").alias("amount"), F.col("e.outcome").alias("outcome"), F.col("e.facility.code").alias("facility"), F.date_format("e.incident_time", "yyyy-MM-dd HH:mm").alias("happened"),
    )


@query(f"""SELECT doc_id, trim(location, ' ') AS location, trim(type, ' ') AS type, md5(trim(regexp_replace(body, '[\\s\\x0B]+', ' ', 'g'), ' ')) AS body, regexp_extract(posted, '(?i)by\\s+DPS\\\\+(.+?)$', 1) AS officer FROM (
  SELECT doc_id, regexp_extract(b, '(?i)Location[:\\s]+([^\\n]+)', 1) AS location, regexp_extract(b, '(?i)Type[:\\s]+([^\\n]+)', 1) AS type, nullif(regexp_extract(b, '(?i)Dispatch Text[:\\s]+([\\s\\S]+?)(?:Posted on|$)', 1), '') AS body, regexp_extract(b, '(?i)Posted on ([^\\n]+)', 1) AS posted
  FROM (SELECT doc_id, 'Location: '||source||', '||lang||chr(10)||'Type:  '||md5(text)||' '||chr(10)||'Dispatch Text: '||{_PLAIN}||' Posted on 1/2/2021 3:04:05 PM by DPS\\X'||doc_id AS b FROM documents))""")
def dispatch_fields(spark, d):
    """Blocks whose text is a whole document."""
    t = F.regexp_replace("text", "[^\\x00-\\x7F]", "x")
    block = F.concat(F.lit("Location: "), "source", F.lit(", "), "lang", F.lit("\nType:  "), F.md5(F.col("text").cast("binary")), F.lit(" \nDispatch Text: "), t, F.lit(" Posted on 1/2/2021 3:04:05 PM by DPS\\X"), "doc_id")
    rows = table(spark, d, "documents").select("doc_id", block.alias("b"))
    f = X.dispatch_fields(F.col("b"))
    return rows.select("doc_id", f["location"].alias("location"), f["type"].alias("type"), F.md5(f["text"].cast("binary")).alias("body"), f["officer"].alias("officer"))


# ---- merges


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def keep_first_dedup(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("k"))
    return merge.keep_first(df, ["k"], "doc_id").select("doc_id")


@query("""SELECT user_id, seq, position FROM (SELECT user_id, event_id AS seq, min(event_id) OVER (PARTITION BY user_id, event_type) AS position, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""")
def keep_last_merge(spark, d):
    df = table(spark, d, "events").select("user_id", "event_type", F.col("event_id").alias("seq"))
    return merge.keep_last_in_place(df, ["user_id", "event_type"]).select("user_id", "seq", "position")


@query("""SELECT k, seq, side FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY side, seq) AS n FROM (SELECT user_id*31 + day(ts) AS k, event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END AS side FROM events)) WHERE n = 1""")
def priority_merge_month(spark, d):
    df = table(spark, d, "events").select((F.col("user_id") * 31 + F.dayofmonth("ts")).alias("k"), F.col("event_id").alias("seq"), (F.col("event_id") % 2).cast("int").alias("side"))
    return merge.priority_merge([df.filter("side = 0"), df.filter("side = 1")], ["k"]).select("k", "seq", "side")


@query("""SELECT k, seq FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY side DESC, seq DESC) AS n FROM (SELECT user_id AS k, event_id AS seq, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS side FROM events)) WHERE n = 1""")
def branch_merge(spark, d):
    df = table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("side"))
    return merge.priority_merge([df.filter("side = 0"), df.filter("side = 1")], ["k"], last_wins=True).select("k", "seq")


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, day(ts) ORDER BY event_id) AS n FROM events e WHERE event_type='click' AND NOT EXISTS (SELECT 1 FROM events s WHERE s.event_type='signup' AND day(s.ts)=day(e.ts) AND s.user_id=e.user_id)) WHERE n=1""")
def anti_join_new(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", F.day("ts").alias("day"))
    return merge.only_new(e.filter("event_type = 'click'"), e.filter("event_type = 'signup'"), ["user_id", "day"], "event_id").select("user_id", "event_id")


@query("""SELECT value FROM (SELECT value, row_number() OVER (PARTITION BY k ORDER BY side, position) AS n FROM (
  SELECT '{"hash":"'||user_id||'","e":'||event_id||'}' AS value, user_id AS k, 1000000000 - event_id AS position, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS side FROM events)) WHERE n = 1
  UNION ALL SELECT 'broken '||event_id FROM events WHERE event_type = 'signup'""")
def merge_json_lines(spark, d):
    e = table(spark, d, "events").withColumn("position", F.lit(1_000_000_000) - F.col("event_id"))
    line = F.concat(F.lit('{"hash":"'), F.col("user_id"), F.lit('","e":'), F.col("event_id"), F.lit("}")).alias("value")
    broken = e.filter("event_type = 'signup'").select(F.concat(F.lit("broken "), F.col("event_id")).alias("value"), "position")
    return merge.merge_lines(e.filter("event_type = 'view'").select(line, "position").unionByName(broken), e.filter("event_type <> 'view'").select(line, "position"))


@query("""SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL OR (n.k IS NOT NULL AND o.stamp <> n.stamp) THEN n.stamp ELSE o.stamp END AS stamp, CASE WHEN o.k IS NULL THEN n.note ELSE o.note END AS note
FROM (SELECT c_custkey AS k, c_nationkey % 7 AS stamp, 'old' AS note FROM customer WHERE c_mktsegment < 'H') o FULL JOIN (SELECT c_custkey AS k, c_nationkey % 5 AS stamp, 'new' AS note FROM customer WHERE c_mktsegment > 'B') n ON o.k = n.k""")
def upsert_selected_cols(spark, d):
    c = table(spark, d, "customer")
    old = c.filter("c_mktsegment < 'H'").select(F.col("c_custkey").alias("k"), (F.col("c_nationkey") % 7).alias("stamp"), F.lit("old").alias("note"))
    new = c.filter("c_mktsegment > 'B'").select(F.col("c_custkey").alias("k"), (F.col("c_nationkey") % 5).alias("stamp"), F.lit("new").alias("note"))
    return merge.upsert(old, new, "k", ["stamp"], when="stamp")


@query("""SELECT c_custkey AS k, 'old' AS side FROM customer WHERE c_mktsegment < 'H' UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_mktsegment >= 'H'""")
def insert_only_merge(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    side = lambda where, name: c.filter(where).select("k", F.lit(name).alias("side"))
    return merge.insert_only(side("c_mktsegment < 'H'", "old"), side("c_mktsegment > 'B'", "new"), ["k"])


@query("""SELECT value FROM (SELECT value, row_number() OVER (PARTITION BY k ORDER BY side, event_id) AS n FROM (
  SELECT event_id, '{"hash":"'||user_id||'-'||day(ts)||'","e":'||event_id||'}' AS value, user_id||'-'||day(ts) AS k, CASE WHEN event_type IN ('click', 'error') THEN 0 ELSE 1 END AS side FROM events)) WHERE n = 1
  UNION ALL SELECT 'broken '||event_id FROM events WHERE event_type = 'error'""")
def merge_every_json_line(spark, d):
    e = table(spark, d, "events")
    line = F.concat(F.lit('{"hash":"'), F.col("user_id"), F.lit("-"), F.day("ts"), F.lit('","e":'), F.col("event_id"), F.lit("}"))
    old, new = e.filter("event_type IN ('click', 'error')"), e.filter("event_type NOT IN ('click', 'error')")
    broken = e.filter("event_type = 'error'").select(F.concat(F.lit("broken "), F.col("event_id")).alias("value"), "event_id")
    return merge.merge_lines(old.select(line.alias("value"), "event_id").unionByName(broken), new.select(line.alias("value"), "event_id"), position="event_id")


@query("""SELECT user_id, day(ts)::INT AS day FROM events WHERE event_type='error' EXCEPT SELECT user_id, day(ts)::INT FROM events WHERE event_type='purchase'""")
def set_difference(spark, d):
    e = table(spark, d, "events").select("user_id", F.day("ts").alias("day"), "event_type")
    return e.filter("event_type = 'error'").select("user_id", "day").subtract(e.filter("event_type = 'purchase'").select("user_id", "day"))


# ---- ranking


@query("""SELECT source, doc_id, n AS rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n <= 15""")
def topn_per_source(spark, d):
    return ranking.top_n(table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 15).select("source", "doc_id", "rank")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role='user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations""")
def fill_forward(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.md5(F.col("text").cast("binary"))).alias("heading"))
    return ranking.fill_forward(c, ["heading"], ["turn"], ["conv_id"])


@query("""SELECT o_orderkey, ((row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 10 + 1)::BIGINT AS page FROM orders""")
def page_numbers(spark, d):
    return ranking.pages(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "page")


@query("""SELECT page, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS entries FROM (SELECT o_orderkey, o_orderkey // 10 AS page FROM orders) GROUP BY page""")
def page_toc(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 10).alias("page"))
    return aggregates.contents(o, "page", "o_orderkey").select("page", F.size("entries").cast("long").alias("n"), F.array_join(F.transform("entries", lambda e: e["o_orderkey"].cast("string")), ",").alias("entries"))


@query(f"""SELECT seq FROM {EVENTS} ORDER BY ts DESC NULLS LAST, seq LIMIT 150""")
def newest_rows(spark, d):
    return ranking.newest(events(spark, d).select("seq", "ts"), "ts", "seq", 150).select("seq")


# ---- aggregates


@query(f"""SELECT 'category' AS kind, category AS value, count(*) AS n FROM {DOCUMENTS} GROUP BY category UNION ALL SELECT 'source', source, count(*) FROM {DOCUMENTS} GROUP BY source UNION ALL SELECT 'total', NULL, count(*) FROM {DOCUMENTS}""")
def summary_counts(spark, d):
    return aggregates.summary_counts(documents(spark, d).select("category", "source"), "category", "source")


_PULSE = {"health": ["error", "view"], "supply": ["purchase"], "economy": ["click", "signup"], "none": ["absent"]}


@query(" UNION ALL ".join(f"""SELECT '{k}' AS "index", s AS score, CASE WHEN s>=70 THEN 'elevated' WHEN s>=45 THEN 'normal' ELSE 'low' END AS label FROM (SELECT coalesce(floor(avg(impact)),0)::INT AS s FROM {EVENTS} WHERE sector IN ({",".join(repr(x) for x in v)}) AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY)""" for k, v in _PULSE.items()))
def pulse_indices(spark, d):
    return aggregates.pulse(events(spark, d), _PULSE, as_of())


@query("""SELECT max(v) AS max_magnitude, min(v) AS min_magnitude, count(*) FILTER (WHERE event_type='error') AS tsunamis FROM (SELECT event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM events)""")
def quake_extent(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("value")).alias("m"), (F.col("event_type") == "error").alias("t"))
    return aggregates.quake_extent(e, "m", "t")


@query("""SELECT count(*) AS fires, round(sum(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity END), 2) AS acres, count(*) FILTER (WHERE l_quantity*2 >= 100) AS contained FROM lineitem""")
def fire_totals(spark, d):
    li = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("acres"), (F.col("l_quantity") * 2).alias("pct"))
    return aggregates.fire_totals(li, "acres", "pct").withColumn("acres", F.round("acres", 2))


@query("""SELECT 'long' AS field, count(*) FILTER (WHERE n_chars > 1000) AS n, floor(100*(count(*) FILTER (WHERE n_chars > 1000))/count(*)::DOUBLE)::BIGINT AS percent FROM documents
  UNION ALL SELECT 'english', count(*) FILTER (WHERE lang='en'), floor(100*(count(*) FILTER (WHERE lang='en'))/count(*)::DOUBLE)::BIGINT FROM documents""")
def coverage(spark, d):
    return aggregates.coverage(table(spark, d, "documents"), {"long": F.col("n_chars") > 1000, "english": F.col("lang") == "en"})


_STATUS_SQL = "CASE WHEN event_type='error' THEN 'error' WHEN event_type='signup' THEN 'warning' ELSE 'ok' END"


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE s='ok') AS healthy, count(*) FILTER (WHERE s='warning') AS warnings, count(*) FILTER (WHERE s='error') AS errors, round_even(100*(count(*) FILTER (WHERE s='ok'))/count(*)::DOUBLE, 1) AS health_score,
  count(*) FILTER (WHERE k=0) AS approved, count(*) FILTER (WHERE k=1) AS on_probation, count(*) FILTER (WHERE k=2) AS failing FROM (SELECT {_STATUS_SQL} AS s, user_id % 3 AS k FROM events)""")
def health_report(spark, d):
    e = table(spark, d, "events").select(F.expr(_STATUS_SQL).alias("status"), F.when(F.col("user_id") % 3 == 0, "approved").when(F.col("user_id") % 3 == 1, "probation").otherwise("failing").alias("probation"))
    return aggregates.health(e)


@query(f"""SELECT sector AS source, count(*) AS archived, count(*) FILTER (WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY) AS recent FROM {EVENTS} GROUP BY sector""")
def archive_manifest(spark, d):
    return aggregates.manifest(events(spark, d).withColumnRenamed("sector", "source"), as_of(), days=10)


@query("""SELECT DISTINCT strftime(o_orderdate, '%Y/%m') AS month FROM orders""")
def month_manifest(spark, d):
    return aggregates.months(table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("ts")))


@query("""SELECT p_brand, string_agg(w, ',' ORDER BY w) AS words FROM (SELECT DISTINCT p_brand, unnest(string_split(p_name,' ')) AS w FROM part) GROUP BY p_brand""")
def distinct_species(spark, d):
    p = table(spark, d, "part").select("p_brand", F.split("p_name", " ").alias("w"))
    return aggregates.distinct_values(p, "p_brand", "w").select("p_brand", F.array_join("values", ",").alias("words"))


@query("""SELECT conv_id, md5(arg_max(text, length(text)*1000000 - turn)) AS longest FROM conversations GROUP BY conv_id""")
def longest_block(spark, d):
    return aggregates.longest(table(spark, d, "conversations"), "conv_id", "text", "turn").select("conv_id", F.md5(F.col("longest").cast("binary")).alias("longest"))


@query("""SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n, min(strftime(o_orderdate, '%Y%m%d%H%M%S')) AS first, max(strftime(o_orderdate, '%Y%m%d%H%M%S')) AS last FROM orders GROUP BY 1""")
def snapshots_per_year(spark, d):
    return aggregates.by_period(table(spark, d, "orders").select(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMddHHmmss").alias("c")), "c")


@query(f"""SELECT seq, ((x + x+2 + x+4)/3) AS lng, ((y + y+3 + y)/3) AS lat, x AS first_lng FROM (SELECT seq, lng AS x, lat AS y FROM {EVENTS})""")
def centroid(spark, d):
    e = events(spark, d)
    v = lambda dx, dy: F.array(F.col("lng") + dx, F.col("lat") + dy)
    c = e.select("seq", F.array(v(0.0, 0.0), v(2.0, 3.0), v(4.0, 0.0)).alias("ring"))
    return c.select("seq", F.round(geo.centroid(F.col("ring"))["lng"], 9).alias("lng"), F.round(geo.centroid(F.col("ring"))["lat"], 9).alias("lat"), geo.first_vertex(F.col("ring"))["lng"].alias("first_lng"))


SQL["centroid"] = SQL["centroid"].replace("((x + x+2 + x+4)/3)", "round((x + (x+2) + (x+4))/3, 9)").replace("((y + y+3 + y)/3)", "round((y + (y+3) + y)/3, 9)")


# ---- joins


@query("""SELECT o_orderkey, coalesce(c.c_name, 'order '||o_orderkey) AS title, c.c_mktsegment AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def case_left_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.concat(F.lit("order "), F.col("o_orderkey")).alias("title"))
    c = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment"))
    return joins.enrich(o, c, "k", ["title", "segment"]).select("o_orderkey", "title", "segment")


@query("""SELECT p_partkey, (SELECT min(w) FROM (SELECT DISTINCT p_name AS w FROM part) WHERE contains(w, substring(p_name_o, strpos(p_name_o,' ')+1))) AS matched FROM (SELECT p_partkey, p_name AS p_name_o FROM part)""")
def contains_first_join(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.element_at(F.split("p_name", " ", 2), 2).alias("t"))
    words = table(spark, d, "part").select(F.col("p_name").alias("w")).distinct()
    return joins.contains_first(p, words, "t", "w", "w", "p_partkey").select("p_partkey", F.col("w").alias("matched"))


@query("""SELECT s_suppkey, bal AS nearest, coalesce(c_custkey, -1) AS c_custkey FROM (SELECT s_suppkey, c_acctbal AS bal, c_custkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(c_acctbal - s_acctbal) NULLS LAST, c_acctbal) AS n
  FROM supplier LEFT JOIN customer ON c_nationkey = s_nationkey AND abs(c_acctbal - s_acctbal) <= 150) WHERE n = 1""")
def nearest_within(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), "s_acctbal")
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), "c_acctbal", "c_custkey")
    return joins.nearest(s, c, ["k"], "s_acctbal", "c_acctbal", ["c_custkey"], 150.0, "s_suppkey").select("s_suppkey", "nearest", F.coalesce("c_custkey", F.lit(-1)).alias("c_custkey"))


@query("""SELECT p_partkey, CASE WHEN a % 2 = 0 THEN a WHEN b % 2 = 0 THEN b ELSE -1 END AS place FROM (SELECT p_partkey, length(string_split(p_name,' ')[1]) AS a, length(string_split(p_name,' ')[2]) AS b FROM part)""")
def place_of_parts(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("/")).alias("t"))
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("w")).distinct().select("w", F.length("w").alias("place")).filter("place % 2 = 0")
    return joins.first_part(p, "t", words, "w", ["place"], "p_partkey").select("p_partkey", F.coalesce("place", F.lit(-1)).alias("place"))


@query("""SELECT c_custkey, coalesce(n, 0) AS errors, coalesce(p, 'high') AS priority FROM customer LEFT JOIN (SELECT user_id, count(*) AS n, 'low' AS p FROM events WHERE event_type='error' GROUP BY 1) ON user_id = c_custkey""")
def feed_state_join(spark, d):
    state_ = table(spark, d, "events").filter("event_type = 'error'").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("errors")).withColumn("priority", F.lit("low"))
    return joins.with_state(table(spark, d, "customer").select("c_custkey"), state_, "c_custkey", {"errors": 0, "priority": "high"})


@query("""SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)""")
def removed_keys(spark, d):
    old = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    return joins.removed(old, table(spark, d, "supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("k")), ["k"])


@query(f"""WITH e AS (SELECT seq, hash, ts, region, sector, CASE WHEN seq % 400 = 0 THEN 'x'||(seq % 1200) END AS ent FROM {EVENTS})
SELECT a.seq, coalesce(string_agg(b.hash, ',' ORDER BY b.seq), '') AS related FROM e a LEFT JOIN (
  SELECT * FROM (SELECT x.seq AS s, y.seq, y.hash, row_number() OVER (PARTITION BY x.seq ORDER BY y.seq) AS n FROM e x JOIN e y ON x.hash <> y.hash AND ((x.region = y.region AND x.sector = y.sector AND abs(epoch_us(x.ts) - epoch_us(y.ts)) < 172800000000) OR x.ent = y.ent)) WHERE n <= 5
) b ON a.seq = b.s GROUP BY a.seq""")
def related_signals(spark, d):
    e = events(spark, d).withColumn("ents", F.when(F.col("seq") % 400 == 0, F.array(F.concat(F.lit("x"), F.col("seq") % 1200))).otherwise(F.array().cast("array<string>")))
    return linking.related(e, entities="ents").select("seq", F.array_join("related", ",").alias("related"))


@query(f"""WITH e AS (SELECT seq, hash, ts, region, sector, 'x'||(user_id % 20) AS ent FROM {EVENTS})
SELECT a.seq, coalesce(string_agg(b.hash, ',' ORDER BY b.seq), '') AS related FROM e a LEFT JOIN (
  SELECT * FROM (SELECT x.seq AS s, y.seq, y.hash, row_number() OVER (PARTITION BY x.seq ORDER BY y.seq) AS n FROM e x JOIN e y ON x.hash <> y.hash AND ((x.region = y.region AND x.sector = y.sector AND abs(epoch_us(x.ts) - epoch_us(y.ts)) < 172800000000) OR x.ent = y.ent)) WHERE n <= 5
) b ON a.seq = b.s GROUP BY a.seq""")
def related_by_entity(spark, d):
    e = events(spark, d).withColumn("ents", F.array(F.concat(F.lit("x"), F.col("user_id") % 20)))
    return linking.related(e, entities="ents").select("seq", F.array_join("related", ",").alias("related"))


_MILES_SQL = "2*3959.0::DOUBLE*atan2(sqrt(pow(sin(radians(b.lat-a.lat)/2),2)+cos(radians(a.lat))*cos(radians(b.lat))*pow(sin(radians(b.lng-a.lng)/2),2)), sqrt(1-(pow(sin(radians(b.lat-a.lat)/2),2)+cos(radians(a.lat))*cos(radians(b.lat))*pow(sin(radians(b.lng-a.lng)/2),2))))"


@query(f"""SELECT a.seq AS a, b.seq AS b FROM {EVENTS} a JOIN {EVENTS} b ON a.seq <> b.seq AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 2700000000
  AND {_MILES_SQL} <= 1.5""")
def haversine_band(spark, d):
    return linking.near_pairs(events(spark, d), "seq", "lat", "lng", "ts", 1.5, 2700)


@query(f"""WITH RECURSIVE e AS (SELECT * FROM {EVENTS}),
d AS MATERIALIZED (SELECT a.seq AS a, b.seq AS b, a.impact AS i FROM e a JOIN e b ON (a.impact > b.impact OR a.impact = b.impact AND a.seq < b.seq) AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 2700000000 AND {_MILES_SQL} <= 1.5),
r AS (SELECT seq AS k, CASE WHEN seq IN (SELECT b FROM d) THEN 'open' ELSE 'leads' END AS is_, 0 AS n FROM e
 UNION ALL SELECT x.k, CASE WHEN x.is_ <> 'open' THEN x.is_ WHEN bool_or(y.is_ = 'leads') THEN 'follows' WHEN bool_and(y.is_ = 'follows') THEN 'leads' ELSE 'open' END, x.n + 1
  FROM r x LEFT JOIN d ON d.b = x.k LEFT JOIN r y ON y.k = d.a WHERE EXISTS (SELECT 1 FROM r WHERE is_ = 'open') GROUP BY x.k, x.is_, x.n),
w AS (SELECT k FROM r WHERE n = (SELECT max(n) FROM r) AND is_ = 'leads'),
f AS (SELECT b, arg_min(a, (-i, a)) AS leads FROM d JOIN w ON w.k = d.a WHERE b NOT IN (SELECT k FROM w) GROUP BY b),
g AS (SELECT coalesce(leads, seq) AS leads, e.* FROM e LEFT JOIN f ON f.b = e.seq)
SELECT max(hash) FILTER (WHERE seq = leads) AS leader, count(*) AS reports, least(100, max(impact) FILTER (WHERE seq = leads) + 5 * (count(*) - 1))::INT AS impact,
  coalesce(string_agg(hash, ',' ORDER BY impact DESC, seq) FILTER (WHERE seq <> leads), '') AS members, CASE WHEN count(*) > 1 THEN 'Multiple Sources ('||count(*)||' reports)' END AS attribution FROM g GROUP BY leads""")
def cluster_signals(spark, d):
    e = events(spark, d)
    return linking.fold_clusters(e, linking.cluster(e)).select("leader", "reports", "impact", F.array_join("members", ",").alias("members"), "attribution")


# ---- geography


def _named_places(k, names):
    """Two names, or none, behind a text; every fifth last one isn't a word of its own."""
    name = lambda n: F.when(n < len(names), F.initcap(_nth(names, F.least(n, F.lit(len(names) - 1))))).otherwise("")
    return F.concat(F.lit(" "), name((k * 7) % 97), F.lit(", "), name((k * 11) % 89), F.when(k % 5 == 0, "s").otherwise(""))


def _named_sql(names) -> str:
    return f"' '||coalesce({_nth_sql(names, '(doc_id * 7) % 97')}, '')||', '||coalesce({_nth_sql(names, '(doc_id * 11) % 89')}, '')||CASE WHEN doc_id % 5 = 0 THEN 's' ELSE '' END"


_ROADS = [f"{a}{end}" for a in C.HIGHWAY_ALIASES for end in ("", " Hwy", " road")] + ["old hwy", "nowhere"]


@query(f"""WITH places(o, name, lat) AS (VALUES {_points_sql(C.PLACES.items())}), aliases(o, name, road) AS (VALUES {", ".join(f"({i}, '{a}', '{r}')" for i, (a, r) in enumerate(C.HIGHWAY_ALIASES.items()))}),
centers(region, lat) AS (VALUES {", ".join(f"('{r}', {p[0]!r}::DOUBLE)" for r, p in C.REGION_CENTERS.items())}),
docs AS (SELECT doc_id, lower({_PLAIN}||{_named_sql(C.PLACES)}) AS t, lower({_nth_sql(_ROADS, f"doc_id % {len(_ROADS)}")}) AS h, {_nth_sql([*C.REGION_CENTERS, "Elsewhere"], f"doc_id % {len(C.REGION_CENTERS) + 1}")} AS region FROM documents),
met AS (SELECT doc_id, arg_max(lat, length(name) * 1000 - o) AS lat FROM docs JOIN places ON contains(t, name) AND regexp_matches(t, '\\b'||regexp_escape(name)||'\\b') GROUP BY doc_id),
roads AS (SELECT doc_id, arg_min(road, CASE WHEN h = name THEN -1 ELSE o END) AS road FROM docs JOIN aliases ON contains(h, name) GROUP BY doc_id)
SELECT doc_id, met.lat AS lat, coalesce(road, replace(h, ' hwy', ' highway')) AS road, centers.lat AS center FROM docs LEFT JOIN met USING (doc_id) LEFT JOIN roads USING (doc_id) LEFT JOIN centers USING (region)""")
def place_lookup(spark, d):
    """The longest place of the catalog in whole texts, the highways of all aliases, the centers of all regions."""
    k, regions = F.col("doc_id"), [*C.REGION_CENTERS, "Elsewhere"]
    rows = _plain_documents(spark, d).select("doc_id", F.concat("t", _named_places(k, list(C.PLACES))).alias("t"))
    return rows.select("doc_id", geo.place_of(F.col("t"))["lat"].alias("lat"), geo.highway_name(_nth(_ROADS, k % len(_ROADS))).alias("road"), geo.region_center(_nth(regions, k % len(regions)))["lat"].alias("center"))


# ---- windows of time and state


@query(f"""SELECT seq, ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS day, ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS week, ts > TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY AS two_days FROM {EVENTS}""")
def rolling_slices(spark, d):
    t = F.col("ts")
    return events(spark, d).select("seq", times.within(t, as_of(), 86_400).alias("day"), times.within(t, as_of(), 604_800).alias("week"), times.within(t, as_of(), 172_800, strict=True).alias("two_days"))


@query("""SELECT event_id, strftime(ts + to_minutes(CASE WHEN event_type='error' THEN 60 WHEN user_id % 4 = 0 THEN 15 WHEN user_id % 4 = 1 THEN 180 WHEN user_id % 4 = 2 THEN 720 ELSE 10080 END), '%Y-%m-%d %H:%M:%S') AS due FROM events""")
def adaptive_schedule(spark, d):
    p = F.get(F.array(*[F.lit(x) for x in ("high", "medium", "low", "dormant")]), (F.col("user_id") % 4).cast("int"))
    due = state.next_check(p, F.col("event_type") != "error", F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", F.date_format(due, "yyyy-MM-dd HH:mm:ss").alias("due"))


@query(f"""WITH RECURSIVE c AS (SELECT user_id, event_type <> 'error' AS ok, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT user_id, 0::BIGINT AS n, 'probation' AS status, 0::BIGINT AS s, 0::BIGINT AS f, 0::BIGINT AS k, min(ts) AS added FROM c GROUP BY user_id
 UNION ALL SELECT user_id, n, CASE WHEN status = 'probation' AND ts - added >= INTERVAL {state.DAYS} DAY AND s >= {state.SUCCESSES} AND f::DOUBLE / (s + f) <= {state.MAX_FAILURE} THEN 'approved'
   WHEN status = 'probation' AND k >= {state.FAIL_PROBATION} OR status = 'approved' AND k >= {state.FAIL_APPROVED} THEN 'failing' WHEN status = 'failing' AND ok AND s >= {state.RECOVER} THEN 'probation' ELSE status END, s, f, k, added
  FROM (SELECT r.user_id, c.n, r.status, r.s + ok::INT AS s, r.f + (NOT ok)::INT AS f, CASE WHEN ok THEN 0 ELSE r.k + 1 END AS k, r.added, c.ts, c.ok FROM r JOIN c ON c.user_id = r.user_id AND c.n = r.n + 1))
SELECT user_id::VARCHAR AS feed, status, s AS success_count, f AS failure_count, k AS consecutive_failures FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS last FROM r) WHERE n = last""")
def probation_fold(spark, d):
    checks = table(spark, d, "events").select(F.col("user_id").cast("string").alias("feed"), (F.col("event_type") != "error").alias("ok"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"))
    return state.probation(checks).drop("added", "checked")


@query("""SELECT user_id::VARCHAR AS feed, count(*) AS streak FROM events e WHERE event_type IN ('view','click') AND ts > coalesce((SELECT max(ts) FROM events o WHERE o.user_id = e.user_id AND o.event_type NOT IN ('view','click')), TIMESTAMP '1970-01-01') GROUP BY 1 HAVING count(*) >= 3""")
def dns_hold(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("u"), "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return state.dns_streaks(e, "u", contains_any(F.col("event_type"), ["view", "click"]), "ts")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_health(spark, d):
    return state.latest(table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type"), "user_id", "ts", "event_id", "event_type").drop("ts")


# ---- publishing


@query(f"""SELECT source AS slug, count(*) AS urls FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY seq) AS n FROM {DOCUMENTS} WHERE starts_with(link, 'http')) WHERE n <= 20 GROUP BY source""")
def sitemap_counts(spark, d):
    df = documents(spark, d).withColumn("block", publish.url_block(F.col("link"), F.col("title"), F.col("source"), F.lit(AS_OF), AS_OF))
    return publish.sitemaps(df, "source", "block", [F.col("seq")], 20).select("slug", "urls")


@query(f"""SELECT seq, md5('  <url>\n    <loc>'||link||'</loc>\n    <news:news>\n      <news:publication>\n        <news:name>'||source||'</news:name>\n        <news:language>en</news:language>\n      </news:publication>\n      <news:publication_date>2024-01-30</news:publication_date>\n      <news:title>'||replace(replace(replace(title,'&','&amp;'),'<','&lt;'),'>','&gt;')||'</news:title>\n    </news:news>\n  </url>') AS block FROM {DOCUMENTS}""")
def url_blocks(spark, d):
    b = publish.url_block(F.col("link"), F.col("title"), F.col("source"), F.lit(AS_OF), AS_OF)
    return documents(spark, d).select("seq", F.md5(b.cast("binary")).alias("block"))


@query("""WITH years AS (SELECT year(min(o_orderdate)) AS a, year(max(o_orderdate)) AS b FROM orders), y AS (SELECT unnest(range(a, b + 1)) AS y, b FROM years), m AS (SELECT unnest(range(1, 13)) AS m)
SELECT '/archive/'||y||'/'||lpad(m::VARCHAR,2,'0') AS path, CASE WHEN b-y <= 0 THEN '0.8' WHEN b-y <= 2 THEN '0.6' ELSE '0.4' END AS priority FROM y, m UNION ALL SELECT '/', '1.0' UNION ALL SELECT '/map', '0.9'""")
def static_sitemap(spark, d):
    """The months of the years that the orders cover."""
    first, last = table(spark, d, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return publish.static_sitemap(spark, [("/", "1.0"), ("/map", "0.9")], first, last, last)


@query(f"""SELECT key, count(*) AS n, md5(string_agg('{{"seq":'||seq||',"sector":"'||sector||'"}}', chr(10) ORDER BY seq)) AS lines FROM (SELECT strftime(ts, '%Y/%m/%d')||'.jsonl' AS key, seq, sector FROM {EVENTS}) GROUP BY key""")
def json_line_payloads(spark, d):
    e = events(spark, d)
    return publish.json_lines(e, F.concat(F.date_format("ts", "yyyy/MM/dd"), F.lit(".jsonl")), ["seq", "sector"], "seq").withColumn("lines", F.md5(F.col("lines").cast("binary")))


@query("""SELECT page_id, md5(title||'|'||url) AS hash FROM (SELECT page_id, url, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages) WHERE starts_with(url,'http') AND title <> ''""")
def link_fingerprints(spark, d):
    p = table(spark, d, "pages").select("page_id", "url", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    return p.filter(urls.fingerprint(F.col("url"), F.col("title"))).select("page_id", keys.title_link_key(F.col("title"), F.col("url")).alias("hash"))


@query(f"""SELECT kind, value, n FROM (SELECT 'category' AS kind, category AS value, count(*) AS n FROM (SELECT category, source, row_number() OVER (PARTITION BY md5(summary) ORDER BY seq) AS k FROM {DOCUMENTS}) WHERE k = 1 GROUP BY 2
  UNION ALL SELECT 'source', source, count(*) FROM (SELECT category, source, row_number() OVER (PARTITION BY md5(summary) ORDER BY seq) AS k FROM {DOCUMENTS}) WHERE k = 1 GROUP BY 2
  UNION ALL SELECT 'total', NULL, count(DISTINCT md5(summary)) FROM {DOCUMENTS})""")
def ingest_summary(spark, d):
    """The flagship: signals of documents, filtered, deduplicated and summed up."""
    df = documents(spark, d).filter(filters.is_web_link(F.col("link")))
    once = merge.keep_first(df.select("seq", "category", "source", keys.text_key(F.col("summary")).alias("k")), ["k"])
    return aggregates.summary_counts(once, "category", "source")


# ---- places, producers, the whole batch


@query("""WITH routes AS (SELECT DISTINCT p_name AS route FROM part), posts AS (SELECT route, m AS post, m / 10.0::DOUBLE + length(route) AS lat FROM routes, (SELECT unnest(range(0, 200, 10)) AS m)),
rows AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name||' loop' WHEN 2 THEN string_split(p_name, ' ')[1] ELSE 'nowhere '||p_partkey END AS h, round_even(p_partkey % 200 + 0.5, 0) AS m FROM part),
routed AS (SELECT id, coalesce(max(CASE WHEN h = route THEN route END), min(route)) AS route FROM rows JOIN routes ON contains(h, route) OR contains(route, h) GROUP BY id)
SELECT id, routed.route AS route, lat FROM rows LEFT JOIN routed USING (id) LEFT JOIN posts ON posts.route = routed.route AND abs(post - m) <= 2""")
def milepost_geocode(spark, d):
    """Parts by the names of parts as routes: the name itself, one around it, one within several, none."""
    from ..operators.places import mileposts

    p, k = table(spark, d, "part"), F.col("p_partkey")
    h = F.when(k % 4 == 0, F.col("p_name")).when(k % 4 == 1, F.concat("p_name", F.lit(" loop"))).when(k % 4 == 2, F.split("p_name", " ")[0]).otherwise(F.concat(F.lit("nowhere "), k))
    posts = p.select(F.col("p_name").alias("route")).distinct().withColumn("mile", F.explode(F.sequence(F.lit(0), F.lit(190), F.lit(10)))).withColumns({"lat": F.col("mile") / 10 + F.length("route"), "lng": F.lit(0.0)})
    return mileposts(p.select(k.alias("id"), h.alias("h"), (k % 200 + F.lit(0.5)).alias("m")), posts, F.col("h"), F.col("m")).select("id", "route", "lat")


@query(f"""WITH posts AS (SELECT DISTINCT lower(c_mktsegment)||' highway' AS route, m, length(c_mktsegment) + m / 100.0::DOUBLE AS lat FROM customer, (SELECT unnest(range(0, 51, 4)) AS m)),
mid AS (SELECT route, list(lat ORDER BY m)[len(list(m)) // 2 + 1] AS lat FROM posts GROUP BY route),
centers(region, lat) AS (VALUES {", ".join(f"('{r}', {p[0]!r}::DOUBLE)" for r, p in C.REGION_CENTERS.items())}),
rows AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'Mile '||(c_custkey % 71)||' '||c_mktsegment||' Highway' WHEN 1 THEN c_mktsegment||' Hwy, '||c_name WHEN 2 THEN c_name||' / '||n_name ELSE c_name END AS location,
  {_nth_sql([*C.REGION_CENTERS, "Elsewhere"], f"c_custkey % {len(C.REGION_CENTERS) + 1}")} AS region FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 > 0) ON n_nationkey = c_nationkey),
parsed AS (SELECT id, region, location, try_cast(nullif(regexp_extract(location, '(?i)mile\\s+(\\d+)', 1), '') AS DOUBLE) AS mile, replace(nullif(trim(regexp_extract(lower(location), '([a-z]+ (?:highway|hwy))', 1)), ''), ' hwy', ' highway') AS route FROM rows),
one AS (SELECT id, arg_min(lat, abs(m - mile) * 1000 + m) AS lat FROM parsed JOIN posts USING (route) WHERE abs(m - mile) <= 5 GROUP BY id),
three AS (SELECT id, arg_min(n_nationkey::DOUBLE, i) AS lat FROM (SELECT id, unnest(string_split_regex(lower(location), '[/,]')) AS part, unnest(range(len(string_split_regex(lower(location), '[/,]')))) AS i FROM parsed) JOIN nation ON lower(n_name) = trim(part) GROUP BY id)
SELECT id, CASE WHEN one.lat IS NOT NULL THEN 1 WHEN mid.lat IS NOT NULL THEN 2 WHEN three.lat IS NOT NULL THEN 3 WHEN centers.lat IS NOT NULL THEN 4 END AS tier, coalesce(one.lat, mid.lat, three.lat, centers.lat) AS lat
FROM parsed LEFT JOIN one USING (id) LEFT JOIN mid USING (route) LEFT JOIN three USING (id) LEFT JOIN centers USING (region)""")
def tiered_places(spark, d):
    """Customers by mile and highway, by highway, by nation as city, by the region of a tag."""
    from ..operators.places import resolve

    k, regions = F.col("c_custkey"), [*C.REGION_CENTERS, "Elsewhere"]
    nation = table(spark, d, "nation")
    df = table(spark, d, "customer").join(nation.filter("n_nationkey % 5 > 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    where = F.when(k % 4 == 0, F.concat(F.lit("Mile "), k % 71, F.lit(" "), "c_mktsegment", F.lit(" Highway"))).when(k % 4 == 1, F.concat("c_mktsegment", F.lit(" Hwy, "), "c_name")).when(k % 4 == 2, F.concat("c_name", F.lit(" / "), "n_name")).otherwise(F.col("c_name"))
    region = _nth(regions, k % len(regions))
    df = df.select(k.alias("id"), where.alias("location"), F.when(k % 3 == 0, region).when(k % 3 == 1, "").alias("region"), F.concat(F.lit("[Region: "), region, F.lit("] [Category: x]")).alias("dataTag"))
    posts = table(spark, d, "customer").select("c_mktsegment").distinct().withColumn("mile", F.explode(F.sequence(F.lit(0), F.lit(48), F.lit(4))))
    posts = posts.select(F.concat(F.lower("c_mktsegment"), F.lit(" highway")).alias("route"), "mile", (F.length("c_mktsegment") + F.col("mile") / 100).alias("lat"), F.lit(0.0).alias("lng"))
    cities = nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("double").alias("lat"), F.lit(0.0).alias("lng"))
    return resolve(df, posts, cities).select("id", "tier", "lat")


@query("""SELECT conv_id, turn, chamber, type FROM (SELECT conv_id, turn, role, last_value(CASE WHEN role='user' THEN 'House '||turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS chamber,
  CASE turn % 3 WHEN 0 THEN 'committee' WHEN 1 THEN 'passage' ELSE 'general' END AS type FROM conversations) WHERE role = 'assistant'""")
def legislative_rows(spark, d):
    from ..sources.verticals import legislative_actions

    said = F.when(F.col("turn") % 3 == 0, "Referred to Finance").when(F.col("turn") % 3 == 1, "Approved").otherwise("noted")
    c = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.concat(F.lit("House "), "turn")).alias("chamber"), F.when(F.col("role") == "assistant", "HB 1").alias("bill"), said.alias("text"))
    rows = legislative_actions(c.withColumn("position", F.col("turn")), "conv_id")
    return rows.select("conv_id", "turn", F.coalesce("chamber", F.lit("")).alias("chamber"), "type")


SQL["legislative_rows"] = SQL["legislative_rows"].replace("SELECT conv_id, turn, chamber, type FROM (", "SELECT conv_id, turn, coalesce(chamber, '') AS chamber, type FROM (", 1)


@query("""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, substring(text,1,60))) WHERE n <= 5""")
def news_caps(spark, d):
    from ..sources.verticals import news

    return news(table(spark, d, "documents").select("source", "doc_id", F.substring("text", 1, 60).alias("title")), "source", "doc_id", "title", 5).select("source", "doc_id")


@query("""SELECT page_id, count(*) AS n, sum(length(c)) AS chars FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS c FROM pages) GROUP BY page_id""")
def table_rows(spark, d):
    from ..sources.verticals import table_rows as rows

    html = F.replace(F.replace("html", F.lit("<li>"), F.lit("<tr><td>")), F.lit("</li>"), F.lit("</td></tr>"))
    p = table(spark, d, "pages").select("page_id", F.concat(F.lit("<table>"), html, F.lit("</table>")).alias("value"), F.regexp_extract_all("html", F.lit("<li>(.*?)</li>"), 1).alias("raw"))
    found = rows(p, least=1).select("page_id", F.get("raw", F.col("position")).alias("c"))
    return found.groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.length("c")).alias("chars"))


@query(f"""SELECT 'category' AS kind, lang AS value, count(*) AS n FROM (SELECT lang, row_number() OVER (PARTITION BY doc_id) AS r FROM documents WHERE length(trim(substring(text,1,60))) > 0) WHERE r = 1 GROUP BY lang
  UNION ALL SELECT 'source', source, count(*) FROM documents WHERE length(trim(substring(text,1,60))) > 0 GROUP BY source UNION ALL SELECT 'total', NULL, count(*) FROM documents WHERE length(trim(substring(text,1,60))) > 0""")
def engine_summary(spark, d):
    """The batch over documents as feed entries: enriched, merged, linked, summed up.

    The archive that they are merged with has each of them under other labels, which must lose, and once more from long
    ago under another hash, which must roll off; a signal that linking loses is missing from the counts.
    """
    from ..sources.signals import adapt
    from .engine import SignalEngine

    engine, docs = SignalEngine("2024-01-30 00:00:00"), documents(spark, d)
    e = docs.select("seq", "title", "link", F.concat("summary", F.lit(" more")).alias("description"), "category", "source", F.lit("2024-01-20T00:00:00Z").alias("published"))
    signals = engine.enrich(e, spark.range(0).select(F.lit("").alias("hash")))
    filed = docs.filter(filters.has_title_and_link(F.col("title"), F.col("link")))
    filed = filed.select("title", "link", F.col("title").alias("summary"), F.lit("archived").alias("category"), F.lit("archive").alias("source"), F.explode(F.array(F.struct("hash", F.lit("2024-01-10T00:00:00Z").alias("timestamp")), F.struct(F.md5("hash").alias("hash"), F.lit("2023-01-10T00:00:00Z").alias("timestamp")))).alias("x"))
    merged = engine.merge(adapt(filed.select("title", "link", "summary", "category", "source", "x.*")), signals)
    return engine.summary(engine.rolling(merged.filter(F.size("relatedSignalIds") >= 0)))


# ---- sources, over documents in each producer's form made of the test tables


def _features(df: DataFrame, feature, group) -> DataFrame:
    """One GeoJSON document for each group."""
    return df.groupBy(group.alias("g")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))


@query(f"""SELECT seq::VARCHAR AS id, value AS magnitude, lat, lng, value > 100 AS tsunami FROM (SELECT *, row_number() OVER (ORDER BY date_trunc('millisecond', ts) DESC, seq::VARCHAR) AS n FROM {EVENTS} WHERE value >= 1.5 AND lat BETWEEN 60.1 AND 60.4) WHERE n <= 200""")
def quake_source(spark, d):
    from ..sources.signals import quakes

    e = events(spark, d)
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lng", "lat", F.lit(1.0)).alias("coordinates"))
    f = F.struct(F.col("seq").cast("string").alias("id"), F.struct(F.col("value").alias("mag"), F.unix_millis("ts").alias("time"), F.when(F.col("value") > 100, 1).otherwise(0).alias("tsunami")).alias("properties"), geometry.alias("geometry"))
    return quakes(_features(e, f, F.floor(F.col("seq") / 200)), south=60.1, north=60.4).select("id", "magnitude", "lat", "lng", "tsunami")


@query(f"""SELECT md5(seq::VARCHAR) AS hash, CASE seq % 3 WHEN 0 THEN 100 WHEN 1 THEN 20 ELSE 40 END AS "impactScore", CASE WHEN seq % 2 = 0 THEN 'now' ELSE 'background' END AS urgency, CASE WHEN seq % 4 = 0 THEN 'Statewide' ELSE 'Area' END AS region, lat + 1 AS lat
  FROM {EVENTS} WHERE NOT (seq % 5 = 0 AND seq % 3 = 1)""")
def alert_source(spark, d):
    from ..sources.signals import alert_signals, alerts

    e = events(spark, d)
    k = F.col("seq")
    corner = lambda dy: F.array(F.col("lng"), F.col("lat") + dy)
    p = F.struct(k.cast("string").alias("id"), F.when(k % 5 == 0, "Small Craft").otherwise("Gale").alias("event"), F.when(k % 3 == 0, "Extreme").when(k % 3 == 1, "Minor").otherwise("Odd").alias("severity"), F.when(k % 2 == 0, "Expected").otherwise("Past").alias("urgency"), F.when(k % 4 == 0, F.repeat(F.lit("area "), F.lit(12))).otherwise("Area").alias("areaDesc"))
    f = F.struct(p.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(F.array(corner(0.0), corner(1.0), corner(2.0))).alias("coordinates")).alias("geometry"))
    got = alert_signals(alerts(_features(e, f, F.floor(k / 200))), ["Small Craft"])
    return got.select("hash", "impactScore", "urgency", "region", F.round("lat", 9).alias("lat"))


SQL["alert_source"] = SQL["alert_source"].replace("lat + 1 AS lat", "round(((lat + (lat + 1)) + (lat + 2)) / 3, 9) AS lat")


@query("""SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN o_totalprice ELSE 7.5 END::DOUBLE AS acres, o_orderkey % 101 AS contained, CASE WHEN o_orderkey % 2 = 0 THEN 'Human' ELSE 'Unknown' END AS cause FROM orders""")
def fire_source(spark, d):
    from ..sources.signals import fires

    k = F.col("o_orderkey")
    a = F.struct(k.cast("string").alias("IrwinID"), F.when(k % 3 == 1, F.col("o_totalprice")).otherwise(0.0).alias("DailyAcres"), F.when(k % 3 == 2, 7.5).alias("CalculatedAcres"), (k % 101).alias("PercentContained"), F.when(k % 2 == 0, "Human").alias("FireCause"))
    got = fires(_features(table(spark, d, "orders"), F.struct(a.alias("attributes")), F.floor(k / 200)))
    return got.select("id", "acres", F.col("contained").cast("long").alias("contained"), "cause")


@query("""SELECT '511-'||md5(o_orderkey::VARCHAR) AS hash, CASE WHEN o_orderkey % 3 = 0 THEN 'now' ELSE 'background' END AS urgency, CASE WHEN o_orderkey % 3 = 0 THEN 70 ELSE 40 END AS "impactScore", CASE WHEN o_orderkey % 2 = 0 THEN 'Mat-Su' ELSE 'Statewide' END AS region, 61.5::DOUBLE AS lat FROM orders""")
def road_source(spark, d):
    from ..sources.signals import road_events

    k = F.col("o_orderkey")
    e = F.struct(k.cast("string").alias("id"), F.when(k % 3 == 0, "closure").otherwise("roadwork").alias("eventType"), F.when(k % 2 == 0, "Palmer Road").otherwise("Road").alias("road"), F.struct(F.lit(61.5).alias("latitude"), F.lit(-149.0).alias("longitude")).alias("startPoint"))
    rows = table(spark, d, "orders").groupBy(F.floor(k / 200).alias("g")).agg(F.collect_list(e).alias("x"))
    wrapped = F.when(F.col("g") % 2 == 0, F.to_json("x")).otherwise(F.to_json(F.struct(F.col("x").alias("events"))))
    return road_events(rows.select(wrapped.alias("value"))).select("hash", "urgency", "impactScore", "region", "lat")


@query("""SELECT g, count(*) AS n, md5(string_agg(link, ',' ORDER BY link)) AS links FROM (SELECT doc_id // 50 AS g, 'http://x/'||doc_id AS link FROM documents) GROUP BY g""")
def feed_source(spark, d):
    from ..sources.pages import feed_entries

    item = F.concat(F.lit("<item><title>A&nbsp;& B "), "doc_id", F.lit("</title><link>http://x/"), "doc_id", F.lit("</link></item>"))
    feeds = table(spark, d, "documents").groupBy(F.floor(F.col("doc_id") / 50).alias("g")).agg(F.concat(F.lit("<rss><channel><title>t</title>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("value"))
    return feed_entries(feeds).groupBy("g").agg(F.count("*").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("link")), ",").cast("binary")).alias("links"))


@query("""SELECT doc_id, CASE k WHEN 2 THEN 'recovered' WHEN 3 THEN 'links' ELSE 'parsed' END AS stage,
  CASE k WHEN 0 THEN source||' & '||doc_id WHEN 1 THEN 'E'||chr(160)||doc_id WHEN 2 THEN 'B & '||doc_id ELSE source||' tells a story '||doc_id END AS title,
  CASE k WHEN 0 THEN 'http://x/' WHEN 1 THEN 'http://y/' WHEN 2 THEN 'http://z/' ELSE 'http://site.org/story-of-' END||doc_id AS link,
  CASE k WHEN 0 THEN 'http://i/'||doc_id WHEN 1 THEN 'http://e/'||doc_id WHEN 2 THEN 'http://g/'||doc_id END AS image,
  CASE WHEN k < 3 THEN md5('about '||t||CASE k WHEN 2 THEN '<img src="http://g/'||doc_id||'">' ELSE '' END) END AS description
FROM (SELECT doc_id, source, (n_chars % 4)::INT AS k, regexp_replace(text, '[^A-Za-z ]', '', 'g')||'.' AS t FROM documents)""")
def feed_recovery(spark, d):
    from ..sources.pages import feed_entries

    t, n = F.concat(F.lit("about "), F.regexp_replace("text", "[^A-Za-z ]", ""), F.lit(".")), F.col("doc_id")
    say = lambda form, *c: F.format_string(form, *c)
    kinds = [
        say('<rss xmlns:media="m"><channel><title>t</title><item><title>%s &amp; %d</title><link>http://x/%d</link><description>%s</description><media:thumbnail url="http://i/%d"/></item></channel></rss>', F.col("source"), n, n, t, n),
        say('<feed><title>t</title><entry><title>E&nbsp;%d</title><link rel="enclosure" type="image/png" href="http://e/%d"/><link href="http://y/%d"/><summary>s</summary><content>%s</content></entry></feed>', n, n, n, t),
        say('<rss><channel><item><title>B & %d<link>http://z/%d</link><description><![CDATA[%s<img src="http://g/%d">]]></description></item></rss>', n, n, t, n),
        say('<html><body><a href="/login">sign in to read all of it</a><a href="/story-of-%d">%s tells a story %d</a>%s</body></html>', n, F.col("source"), n, t),
    ]
    kind = (F.col("n_chars") % 4).cast("int")
    body = F.concat(F.unhex(F.lit("EFBBBF")), F.encode(F.get(F.array(*kinds), kind), "UTF-8"), F.unhex(F.lit("FF")))
    pages_ = table(spark, d, "documents").select("doc_id", body.alias("value"), F.lit("http://site.org").alias("url"))
    found = feed_entries(pages_, base="url")
    return found.select("doc_id", "stage", "title", "link", "image", F.md5(F.col("description").cast("binary")).alias("description"))


@query("""SELECT count(*) AS n, count(DISTINCT url) AS urls FROM (SELECT regexp_replace(url, '[?#].*$', '') AS url FROM pages)""")
def sitemap_source(spark, d):
    from ..sources.pages import sitemap_locations

    loc = F.concat(F.lit("<url><loc>"), F.regexp_replace("url", "[?#].*$", ""), F.lit("</loc></url>"))
    maps = table(spark, d, "pages").groupBy(F.floor(F.col("page_id") / 50).alias("g")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(loc), ""), F.lit("</urlset>")).alias("value"))
    return sitemap_locations(maps).agg(F.count("*").alias("n"), F.count_distinct("location").alias("urls"))


@query("""SELECT c_name AS location, 'Theft' AS type, strftime(TIMESTAMP '2021-01-02 15:04:05' + to_days((c_custkey % 20)::INT), '%Y-%m-%d %H:%M:%S') AS posted, CASE WHEN c_custkey % 2 = 0 THEN 'arrested' ELSE 'unknown' END AS outcome FROM customer""")
def dispatch_source(spark, d):
    from ..sources.pages import dispatch_blocks

    day = F.date_format(F.date_add(F.lit("2021-01-02"), (F.col("c_custkey") % 20).cast("int")), "M/d/yyyy")
    block = F.concat(F.lit("Location: "), "c_name", F.lit("\nType: Theft\nDispatch Text: A person was "), F.when(F.col("c_custkey") % 2 == 0, "arrested").otherwise("seen"), F.lit(". Posted on "), day, F.lit(" 3:04:05 PM by DPS\\\\x\n"))
    pages_ = table(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 50).alias("g")).agg(F.array_join(F.collect_list(block), "").alias("value"))
    return dispatch_blocks(pages_).select("location", "type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("posted"), F.col("entities.outcome").alias("outcome"))


@query("""SELECT url, strftime(min(o_orderdate), '%Y-%m-%d') AS first FROM (SELECT 'x.com/'||(o_orderkey // 4) AS url, o_orderdate, row_number() OVER (PARTITION BY o_orderkey // 4 ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1 GROUP BY url""")
def archive_manifest_source(spark, d):
    from ..sources.pages import archive_manifest

    k = F.col("o_orderkey")
    url = F.concat(F.when(k % 2 == 0, "http://www.x.com/").otherwise("https://x.com/"), F.floor(k / 4), F.when(k % 3 == 0, "/").otherwise(""))
    row = F.array(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMddHHmmss"), url)
    rows = F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), row.alias("r")))), lambda x: x["r"])
    doc = table(spark, d, "orders").groupBy(F.floor(k / 200)).agg(F.to_json(F.concat(F.array(F.array(F.lit("timestamp"), F.lit("original"))), rows)).alias("value"))
    got = archive_manifest(doc)
    return got.select(F.regexp_replace(F.regexp_replace("original", "^https?://(www[.])?", ""), "/$", "").alias("url"), F.date_format("ts", "yyyy-MM-dd").alias("first"))


@query(f"""SELECT hash, link, summary, ts_has FROM (SELECT hash, link, md5(summary) AS summary, seq % 2 = 0 AS ts_has FROM {DOCUMENTS})""")
def adapted_producers(spark, d):
    from ..sources.signals import adapt, union

    df = documents(spark, d)
    a = df.filter("seq % 2 = 0").select(F.col("hash").alias("id"), "title", F.col("link").alias("articleUrl"), F.col("summary").alias("content"), F.lit("2024-01-01T00:00:00Z").alias("published"))
    b = df.filter("seq % 2 = 1").select("hash", "title", F.lit("").alias("link"), F.col("link").alias("url"), "summary", F.lit("2024-01-01T00:00:00").alias("timestamp"))
    return union([adapt(a, "a"), adapt(b, "b")]).select("hash", "link", F.md5(F.col("summary").cast("binary")).alias("summary"), F.col("ts_has_offset").alias("ts_has"))


@query("""SELECT s_suppkey AS code, CASE WHEN s_nationkey % 5 = 4 THEN 'normal' WHEN s_acctbal > 7000 THEN 'unknown' WHEN s_nationkey % 3 > 0 AND s_acctbal < 2000 THEN 'delayed' ELSE 'normal' END AS status FROM supplier""")
def airport_status(spark, d):
    """Answers for four fifths of the nations; a third of them with an error's status."""
    from ..sources.signals import airport_status as status

    s = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "code")
    answers = s.filter("s_nationkey % 5 <> 4").select("code", F.when(F.col("s_nationkey") % 3 > 0, 200).otherwise(500).alias("http"), (F.col("s_acctbal") < 2000).alias("delay"), (F.col("s_acctbal") > 7000).alias("failed"))
    return status(s.select("code"), answers).select("code", "status")


@query(f"""WITH places(o, name, lat) AS (VALUES {_points_sql(C.PLACES.items())}), agencies(o, name, lat) AS (VALUES {_points_sql(C.AGENCY_PLACES)}),
docs AS (SELECT doc_id, {_PLAIN}||{_named_sql([n.lower() for n, _ in C.AGENCY_PLACES])} AS t FROM documents),
met AS (SELECT doc_id, arg_max(lat, length(name) * 1000 - o) AS lat FROM docs JOIN places ON contains(lower(t), name) AND regexp_matches(lower(t), '\\b'||regexp_escape(name)||'\\b') GROUP BY doc_id),
named AS (SELECT doc_id, arg_min(lat, o) AS agency FROM docs JOIN agencies ON contains(upper(t), name) GROUP BY doc_id)
SELECT doc_id, CASE WHEN doc_id % 4 = 2 THEN 5.0 ELSE lat END AS lat, agency FROM docs LEFT JOIN met USING (doc_id) LEFT JOIN named USING (doc_id)""")
def agency_points(spark, d):
    """Places of whole texts where a row has none, and the first agency place in them."""
    from ..operators.places import fill_places

    k = F.col("doc_id")
    df = _plain_documents(spark, d).select("doc_id", F.concat("t", _named_places(k, [n.lower() for n, _ in C.AGENCY_PLACES])).alias("n"))
    df = df.withColumns({"lat": F.when(k % 4 == 2, 5.0), "lng": F.when(k % 4 == 2, 6.0)})
    return fill_places(df, F.col("n")).select("doc_id", "lat", geo.agency_point(F.col("n"))["lat"].alias("agency"))


@query("""SELECT count(*) AS airports, count(*) FILTER (WHERE s_acctbal < 0) AS delayed FROM supplier""")
def delayed_airports(spark, d):
    from ..sources.signals import airport_status as status

    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("code"), "s_acctbal")
    answers = s.filter("s_acctbal < 5000").select("code", F.lit(200).alias("http"), (F.col("s_acctbal") < 0).alias("delay"), F.lit(False).alias("failed"))
    return aggregates.delayed(status(s.select("code"), answers))


@query("""WITH a AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'executive' WHEN 'O' THEN 'introduction' ELSE 'committee' END AS type, CASE WHEN o_orderpriority <> '5-LOW' THEN 'HB '||o_custkey END AS bill FROM orders)
  SELECT 'total' AS kind, NULL AS value, count(*) AS n FROM a UNION ALL SELECT 'type', type, count(*) FROM a GROUP BY type UNION ALL SELECT 'bill', bill, count(*) FROM a WHERE bill IS NOT NULL GROUP BY bill""")
def action_summary(spark, d):
    from ..sources.verticals import legislative_action

    status = F.col("o_orderstatus")
    text = F.when(status == "F", "Signed by the Governor").when(status == "O", "Introduced").otherwise("Referred to Finance")
    bill = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("HB "), "o_custkey")).otherwise("")
    return aggregates.action_summary(table(spark, d, "orders").select(legislative_action(F.lower(text)).alias("type"), bill.alias("bill")))


@query(f"""SELECT CASE seq % 3 WHEN 0 THEN 'Extreme' WHEN 1 THEN 'Minor' ELSE 'Odd' END AS value, count(*) AS n FROM {EVENTS} GROUP BY 1""")
def severity_counts(spark, d):
    from ..sources.signals import alerts

    e = events(spark, d)
    k = F.col("seq")
    p = F.struct(k.cast("string").alias("id"), F.when(k % 3 == 0, "Extreme").when(k % 3 == 1, "Minor").otherwise("Odd").alias("severity"))
    return aggregates.histogram(alerts(_features(e, F.struct(p.alias("properties")), F.floor(k / 200))), "severity")


def _picked(pattern: str) -> str:
    return f"""nullif({_clean_sql(f"regexp_extract(h, '{pattern}', 1)")}, '')"""


_OG = "CASE WHEN page_id % 3 = 0 THEN '<meta property=\"og:title\" content=\"'||replace(title, '\"', '')||'\">' ELSE '' END"
_LD = "CASE WHEN page_id % 5 < 2 THEN '<script type=\"application/ld+json\">'||to_json({'headline': 'new '||title, 'description': url})||'</script>' ELSE '' END"


@query(f"""SELECT page_id, title, md5(body) AS body FROM (SELECT page_id, CASE WHEN y < 2010 THEN coalesce(t0, t2, t1) WHEN y < 2020 THEN coalesce(t1, t2, t0) ELSE coalesce(t2, t1, t0) END AS title, CASE WHEN y < 2010 THEN coalesce(b0, b2, b1) WHEN y < 2020 THEN coalesce(b1, b2, b0) ELSE coalesce(b2, b1, b0) END AS body
FROM (SELECT page_id, y, {_picked("(?is)<(?:h1|h2|b)(?:\\s[^>]*)?>(.*?)</(?:h1|h2|b)>")} AS t0, {_picked("(?is)<(?:td|div)(?:\\s[^>]*)?>(.*?)</(?:td|div)>")} AS b0, {_picked('(?is)<meta[^>]+property="og:title"[^>]+content="([^"]*)"')} AS t1, {_picked("(?is)<article[^>]*>(.*?)</article>")} AS b1,
  CASE WHEN ld <> '' THEN json_extract_string(ld, '$.headline') END AS t2, CASE WHEN ld <> '' THEN json_extract_string(ld, '$.description') END AS b2
  FROM (SELECT page_id, y, h, regexp_extract(h, '(?is)<script[^>]+application/ld\\+json[^>]*>(.*?)</script>', 1) AS ld FROM (SELECT page_id, 1999 + page_id % 26 AS y, {_OG}||{_LD}||html AS h FROM (SELECT *, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)))))""")
def era_articles(spark, d):
    """The pages as they are, some with meta and linked data before them, of all three eras."""
    from ..sources.pages import article_of

    k, title = F.col("page_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    og = F.when(k % 3 == 0, F.concat(F.lit('<meta property="og:title" content="'), F.replace(title, F.lit('"'), F.lit("")), F.lit('">'))).otherwise("")
    data = F.to_json(F.struct(F.concat(F.lit("new "), title).alias("headline"), F.col("url").alias("description")))
    ld = F.when(k % 5 < 2, F.concat(F.lit('<script type="application/ld+json">'), data, F.lit("</script>"))).otherwise("")
    found = table(spark, d, "pages").select("page_id", F.concat(og, ld, "html").alias("h")).select("page_id", article_of(F.col("h"), 1999 + k % 26).alias("a"))
    return found.select("page_id", F.col("a.title").alias("title"), F.md5(F.col("a.body").cast("binary")).alias("body"))
