"""Queries of registers, bulletins and small rules of text and time, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import catalogs as C
from ..functions import text, times, urls
from ..session import scratch
from ..sources import pages, verticals
from .frames import table
from .queries import _cases, query

_NAV = """<li><a href="/([^"]*)">([^<]*)</a></li>"""


@query(f"""WITH links AS (SELECT page_id, unnest(range(1, len(h) + 1)) AS i, h, t FROM (SELECT page_id, regexp_extract_all(html, '{_NAV}', 1) AS h, regexp_extract_all(html, '{_NAV}', 2) AS t FROM pages WHERE page_id % 4 > 0)),
named AS (SELECT page_id, i, lower(CASE WHEN page_id % 2 = 0 AND trim(t[i]) <> '' THEN trim(t[i]) ELSE string_split(h[i], '/')[-1] END) AS name, h[i] AS href FROM links)
SELECT name, 'https://example.org/getmedia/'||href||'.pdf' AS bulletin, 'https://example.org/'||page_id||'.png' AS image FROM named QUALIFY row_number() OVER (PARTITION BY name ORDER BY page_id DESC, i DESC) = 1""")
def bulletin_links(spark, d):
    """The links of all pages as bulletins, with a title on half of them; a quarter of the pages has no pictures."""
    k = F.col("page_id")
    title = F.when(k % 2 == 0, ' title=" $2 "').otherwise("")
    picture = F.when(k % 4 > 0, F.concat(F.lit('<img src="/'), k, F.lit('.png">'))).otherwise("")
    html = F.regexp_replace("html", F.lit(_NAV), F.concat(F.lit('<li><a href="/getmedia/$1.pdf"'), title, F.lit(">"), picture, F.lit("</a></li>")))
    return pages.bulletins(table(spark, d, "pages").select("page_id", html.alias("html")), base="https://example.org")


@query("""SELECT page_id, md5(trim(regexp_replace(html, '<[^>]+>', '', 'g'), ' ')) AS bare, trim(CASE WHEN page_id % 3 = 0 AND page_id % 2 = 0 THEN url ELSE link END, ' ') AS link FROM (
  SELECT page_id, html, url, CASE WHEN page_id % 3 = 0 THEN ' https://m.example.org/?post_type=od_url_metrics&p='||page_id ELSE url END AS link FROM pages)""")
def bare_pages(spark, d):
    """Whole pages without tags; a third of the links are metrics, half of which have the address in their title."""
    k = F.col("page_id")
    link = F.when(k % 3 == 0, F.concat(F.lit(" https://m.example.org/?post_type=od_url_metrics&p="), k)).otherwise(F.col("url"))
    title = F.when(k % 2 == 0, F.col("url")).otherwise(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return table(spark, d, "pages").select("page_id", F.md5(text.strip_tags(F.col("html")).cast("binary")).alias("bare"), urls.resolve_tracker(title, link).alias("link"))


@query("""SELECT event_id, CASE WHEN event_id % 5 > 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS happened FROM events""")
def event_times(spark, d):
    """Times out of summaries' markup; a fifth of them isn't in the zone that the rule reads."""
    zone = F.when(F.col("event_id") % 5 > 0, " UTC").otherwise(" AKDT")
    said = F.concat(F.lit("<p>"), F.coalesce("props", F.lit("")), F.lit("</p><dl><dt>Time</dt><dd>"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zone, F.lit("</dd><dt>Time</dt><dd>2000-01-01 00:00:00 UTC</dd></dl>"))
    first = F.substring_index(said, "<dt>Time</dt><dd>2000", 1)
    return table(spark, d, "events").select("event_id", F.date_format(times.event_time(first), "yyyy-MM-dd HH:mm:ss").alias("happened"))


@query("""SELECT 'AK-DPS-'||number AS id, string_agg(upper(w[1])||lower(w[2:]), ' ' ORDER BY i) AS name, any_value(sex) AS sex, any_value(location) AS location, any_value(last_contact) AS last_contact FROM (
  SELECT number, sex, location, last_contact, unnest(string_split(first||' '||last, ' ')) AS w, unnest(range(1, len(string_split(first||' '||last, ' ')) + 1)) AS i FROM (
    SELECT c_custkey // 3 AS number, c_mktsegment AS first, replace(c_name, '#', ' ') AS last, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex, CASE WHEN c_nationkey % 3 = 0 THEN 'Unknown' ELSE 'Post '||c_nationkey END AS location,
      CASE WHEN c_nationkey <= 20 THEN '20'||lpad((c_nationkey % 20)::VARCHAR, 2, '0')||'-03-'||lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') END AS last_contact
    FROM customer WHERE c_custkey % 7 > 0 QUALIFY row_number() OVER (PARTITION BY number ORDER BY c_custkey) = 1)) GROUP BY number""")
def missing_register(spark, d):
    """A register written as a file with padded headers, read back: three rows for each number, some without a name."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, d, "customer").orderBy("c_custkey").select(
        F.when(k % 7 > 0, F.concat(F.replace("c_name", F.lit("#"), F.lit(" ")), F.lit(" "))).alias(" Last Name"), F.concat(F.lit(" "), "c_mktsegment").alias("First Name "), F.floor(k / 3).alias("Case Number"), F.when(n % 2 == 0, "F").otherwise("M").alias("Sex"),
        F.when(n % 3 == 0, "AST DPS").otherwise(F.concat(F.lit("post "), n, F.lit(" Police Department"))).alias("Investigating Agency"), F.when(n <= 20, F.concat(F.lit("3/"), k % 28 + 1, F.lit("/20"), F.lpad((n % 20).cast("string"), 2, "0"))).otherwise("soon").alias("Date Last Contacted"),
    )
    path = scratch(spark, "register")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return pages.missing_persons(spark, path).withColumn("last_contact", F.col("last_contact").cast("string"))


@query("""SELECT 'stolen_C'||c_custkey||'_'||vin AS id, CASE WHEN vin = '' AND c_custkey % 5 > 0 THEN 'Stolen plate: L'||c_custkey ELSE 'Stolen vehicle: '||(1990 + c_nationkey)||' '||c_mktsegment END AS title,
  CASE WHEN c_nationkey % 2 = 0 THEN 'RED | ' ELSE '' END||'PK'||CASE WHEN c_custkey % 5 > 0 THEN ' | L'||c_custkey ELSE '' END||CASE WHEN vin <> '' THEN ' | '||vin ELSE '' END AS summary, 'Post '||c_nationkey AS location, (row_number() OVER (ORDER BY c_custkey) - 1) // 10 + 1 AS page
FROM (SELECT *, CASE WHEN c_custkey % 3 > 0 THEN substring(md5(c_name), 1, 17) ELSE '' END AS vin FROM customer)""")
def vehicle_register(spark, d):
    """A register of vehicles and plates written as files and read back, in pages of ten in the order of the files."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, d, "customer").orderBy("c_custkey").select(
        F.when(k % 3 > 0, F.substring(F.md5(F.col("c_name").cast("binary")), 1, 17)).alias("Vin "), F.when(k % 5 > 0, F.concat(F.lit("L"), k)).alias("License"), F.concat(F.lit("post "), n, F.lit(" DPS")).alias("Agency"), (1990 + n).alias("PropertyModelYear"),
        F.col("c_mktsegment").alias("MakeModel"), F.lit("PK").alias("Style"), F.when(n % 2 == 0, " RED").alias("Color"), F.concat(F.lit("C"), k).alias("Case"),
    )
    path = scratch(spark, "register")
    rows.write.option("header", True).csv(path)
    return pages.stolen_vehicles(spark, path).select("id", "title", "summary", "location", "page")


@query(f"""SELECT doc_id, {_cases("low", C.FISHERIES_TYPES, "update")} AS type, md5(substring(text, 1, 300)) AS summary FROM (SELECT doc_id, source, text, md5(text) AS title, n_chars AS link, lower(md5(text)||' '||regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g')) AS low FROM documents
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 40) QUALIFY row_number() OVER (PARTITION BY title, link ORDER BY doc_id) = 1""")
def fisheries_entries(spark, d):
    """The first 40 entries of each source, the feature's limit, each text once."""
    rows = table(spark, d, "documents").select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("title"), F.col("n_chars").alias("link"), F.regexp_replace("text", "[^\\x00-\\x7F]", "x").alias("low"), "text")
    found = verticals.fisheries(rows, "source", "doc_id", "title", "low", 40)
    return found.select("doc_id", "type", F.md5(F.substring("text", 1, 300).cast("binary")).alias("summary"))
