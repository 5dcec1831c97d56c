"""Rows out of markup and text: feeds, sitemaps, dispatch pages, web-archive manifests, CSV registers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions.markup import field_of
from ..functions.rules import contains_any
from ..functions.text import clean_agency, clean_text, decode_bytes, heal_xml, join_parts
from ..functions.times import compact_time, posted_time
from ..functions.urls import article_links, page_links, without_protocol
from ..operators.merge import keep_first, keep_last
from ..operators.ranking import pages as number_pages

_MEDIA = "`media:thumbnail`:array<struct<_url:string>>,`media:content`:array<struct<_url:string,_medium:string,_type:string>>"
RSS = f"struct<channel:struct<title:string,item:array<struct<title:string,link:string,description:string,`content:encoded`:string,pubDate:string,guid:string,enclosure:array<struct<_url:string,_type:string>>,{_MEDIA}>>>>"
ATOM = f"struct<title:string,entry:array<struct<title:string,link:array<struct<_href:string,_rel:string,_type:string>>,summary:string,content:string,published:string,updated:string,{_MEDIA}>>>"


def _entry(title: Column, link: Column, body: Column, published: Column, image: Column) -> Column:
    return F.struct(title.alias("title"), link.alias("link"), body.alias("description"), published.alias("published"), F.coalesce(image, image_in(body)).alias("image"))


def image_in(content: Column) -> Column:
    """The image that an entry's markup names: og or twitter meta, else its first img, unless that is inline or a tracker."""
    meta = F.regexp_extract(content, r"""(?is)<meta[^>]+property=["'](?:og|twitter):image["'][^>]*\bcontent=["']([^"']+)""", 1)
    first = F.trim(F.regexp_extract(content, r"""(?is)<img\b[^>]*?\bsrc=["']([^"']+)""", 1))
    return F.coalesce(F.nullif(F.trim(meta), F.lit("")), F.when((first != "") & ~first.rlike("^data:|pixel|tracker"), first))


def _media(x: Column, enclosures: Column) -> Column:
    """The first of a thumbnail, the first media content if an image, and an enclosed image."""
    shown = F.get(x["media:content"], F.lit(0))
    enclosed = F.get(F.filter(enclosures, lambda e: e["_type"].startswith("image/")), F.lit(0))
    return F.coalesce(F.get(x["media:thumbnail"], F.lit(0))["_url"], F.when((shown["_medium"] == "image") | shown["_type"].startswith("image/"), shown["_url"]), enclosed["_url"])


def _recovered(body: Column) -> Column:
    """Entries of markup that no parser takes: blocks from one item or entry tag to the next, fields up to their end tag or
    the next field; a body's nested markup stays, with what is open in it closed."""
    blocks = F.filter(F.split(body, r"(?i)(?=<(?:item|entry)[\s>])"), lambda x: x.rlike(r"(?i)^<(?:item|entry)[\s>]"))

    attribute = lambda x, p: F.nullif(F.regexp_extract(x, p, 1), F.lit(""))
    image = lambda x: F.coalesce(attribute(x, r"""(?is)<media:thumbnail\b[^>]*\burl=["']([^"']+)"""), attribute(x, r"""(?is)<enclosure\b(?=[^>]*\btype=["']image/)[^>]*\burl=["']([^"']+)"""))
    link = lambda x: F.coalesce(field_of(x, "link"), attribute(x, r"""(?is)<link\b[^>]*\bhref=["']([^"']+)"""), field_of(x, "guid"))
    fields = lambda x: F.struct(field_of(x, "title").alias("t"), link(x).alias("l"), field_of(x, "content:encoded", "content", "description", "summary", body=True).alias("b"), field_of(x, "pubDate", "published", "updated").alias("p"), image(x).alias("i"))
    # In two steps, so that a field is taken out once.
    return F.transform(F.transform(blocks, fields), lambda e: _entry(e["t"], e["l"], e["b"], e["p"], e["i"]))


def feed_entries(df: DataFrame, xml: str = "value", base: str | None = None) -> DataFrame:
    """Entries of RSS and Atom documents: df's columns with position, title, link, description, published, image and stage.

    xml is text, or bytes as fetched. Documents are healed and parsed (stage parsed); what gives no entries so is cut at its
    entry tags (recovered); what has none, and a page address in base, gives its article links (links). description is
    the content, else the summary. Null and empty documents give no entries.
    """
    raw = decode_bytes(F.col(xml)) if dict(df.dtypes)[xml] == "binary" else F.col(xml)
    opts = {"mode": "PERMISSIVE"}
    text = df.withColumn("__b", heal_xml(raw))
    both = text.withColumns({"__r": F.when(F.lower("__b").contains("<rss"), F.from_xml("__b", RSS, opts)), "__a": F.when(F.lower("__b").contains("<feed"), F.from_xml("__b", ATOM, opts))})
    full = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c])
    rss = F.transform("__r.channel.item", lambda i: _entry(i["title"], F.coalesce(i["link"], i["guid"]), full(i["content:encoded"], i["description"]), i["pubDate"], _media(i, i["enclosure"])))

    def atom_entry(e: Column) -> Column:
        rel = lambda name: F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == name)
        enclosed = F.transform(rel("enclosure"), lambda x: F.struct(x["_href"].alias("_url"), x["_type"].alias("_type")))
        link = F.coalesce(F.get(rel("alternate"), F.lit(0)), F.get(e["link"], F.lit(0)))["_href"]
        return _entry(e["title"], link, full(e["content"], e["summary"]), F.coalesce(e["published"], e["updated"]), _media(e, enclosed))

    some = lambda c: F.when(F.size(c) > 0, c)
    found = both.withColumn("__p", some(F.coalesce(rss, F.transform("__a.entry", atom_entry))))
    found = found.withColumn("__c", F.when(F.col("__p").isNull(), some(_recovered(F.col("__b")))))
    stages = [(F.col("__p"), "parsed"), (F.col("__c"), "recovered")]
    if base is not None:
        found = found.withColumn("__h", page_links(F.when(F.col("__p").isNull() & F.col("__c").isNull(), raw), F.col(base)))
        none = F.lit(None).cast("string")
        stages.append((F.transform(article_links(F.col("__h"), F.col(base)), lambda x: _entry(x["title"], x["link"], none, none, none)), "links"))
    stage = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for c, n in stages])
    rows = found.select(*df.columns, stage.alias("stage"), F.posexplode(F.coalesce(*[c for c, _ in stages])).alias("position", "__e"))
    return rows.select(*df.columns, "position", "__e.*", "stage")


def feed_status(http: Column, entries: Column, error: Column) -> Column:
    """ok, warning (nothing in it) or error of a fetch."""
    return F.when(error.isNotNull() | (F.coalesce(http, F.lit(0)) != 200), "error").when(F.coalesce(entries, F.lit(0)) == 0, "warning").otherwise("ok")


def proxy_status(http: Column, size: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), "error").when(http == 404, "missing").when(http != 200, F.concat(F.lit("HTTP "), http)).when(F.coalesce(size, F.lit(0)) == 0, "empty").otherwise("ok")


def robots_sitemaps(df: DataFrame, text: str = "value") -> DataFrame:
    return df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1)).alias("sitemap"))


def sitemap_locations(df: DataFrame, xml: str = "value") -> DataFrame:
    """(kind, location) of a sitemap: page of a urlset, sitemap of an index."""
    x = heal_xml(F.col(xml))
    kind = F.when(F.lower(x).contains("<sitemapindex"), "sitemap").otherwise("page")
    return df.select(kind.alias("kind"), F.explode(F.regexp_extract_all(x, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1)).alias("location"))


def sitemap_tree(roots: DataFrame, documents: DataFrame, depth: int = 2) -> DataFrame:
    """Pages of sitemaps and of the indexes below them, to a fixed depth; documents: (location, value) that were fetched."""
    level, out = roots.select("location"), None
    for _ in range(depth + 1):
        found = sitemap_locations(level.distinct().join(documents, "location"))
        pages = found.filter("kind = 'page'").select("location")
        out = pages if out is None else out.unionByName(pages)
        level = found.filter("kind = 'sitemap'").select("location")
    return out.distinct()


def alternate_feeds(html: Column) -> Column:
    """Feed URLs that a page's head names."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*\btype=[\"']application/(?:rss|atom)\+xml[\"'][^>]*>"), 0)
    return F.filter(F.transform(tags, lambda t: F.regexp_extract(t, r"(?i)\bhref=[\"']([^\"']+)", 1)), lambda u: u != "")


def best_candidate(candidates: DataFrame, domain: str, order: Sequence[Column]) -> DataFrame:
    return candidates.withColumn("__n", F.row_number().over(Window.partitionBy(domain).orderBy(*order))).filter("__n = 1").drop("__n")


def replace_urls(catalog: DataFrame, replacements: DataFrame) -> DataFrame:
    """A catalog (url) with the new URLs of replacements (url, new_url): a table update instead of edited code."""
    return catalog.join(replacements, "url", "left").withColumn("url", F.coalesce("new_url", "url")).drop("new_url")


def links_page(df: DataFrame, html: str = "html", base: str = "url", **limits) -> DataFrame:
    """df's columns with title and link of each article link."""
    found = df.withColumn("__l", page_links(F.col(html), F.col(base)))
    return found.select(*df.columns, F.explode(article_links(F.col("__l"), F.col(base), **limits)).alias("x")).select(*df.columns, "x.*")


def dispatch_blocks(df: DataFrame, text: str = "value") -> DataFrame:
    """Incidents of dispatch texts, one block for each "Location:"."""
    blocks = df.select(F.explode(F.filter(F.split(F.col(text), r"(?i)(?=Location:)"), lambda b: b.rlike("(?i)^Location:"))).alias("block"))
    f = X.dispatch_fields(F.col("block"))
    rows = blocks.select(*[c.alias(k) for k, c in f.items()]).withColumn("ts", posted_time(F.col("posted")))
    return rows.withColumn("entities", X.entities(F.coalesce("text", F.lit("")))).withColumn("hash", F.md5(F.concat_ws("|", "location", "type", "text").cast("binary")))


def legacy_blocks(df: DataFrame, text: str = "value", least: int = 200, word: str = "Trooper") -> DataFrame:
    """Free-text paragraphs long enough and with the word, in order, each once."""
    parts = df.select(F.posexplode(F.split(F.col(text), r"\n\s*\n")).alias("position", "block")).withColumn("block", F.trim(F.regexp_replace("block", r"(?U)\s+", " ")))
    kept = keep_first(parts.filter((F.length("block") > least) & F.col("block").contains(word)), ["block"], "position")
    return kept.select("position", "block", X.legacy_suspects(F.col("block")).alias("suspects"), X.legacy_charges(F.col("block")).alias("charges"))


def archive_manifest(df: DataFrame, text: str = "value") -> DataFrame:
    """(ts, original) of a web archive's rows after the header, the first of each address however it was written."""
    rows = df.select(F.posexplode(F.from_json(F.col(text), "array<array<string>>")).alias("position", "r")).filter("position > 0")
    rows = rows.select("position", F.get("r", F.lit(0)).alias("stamp"), F.get("r", F.lit(1)).alias("original")).withColumn("key", without_protocol(F.lower("original")))
    return keep_first(rows, ["key"], "position").select(compact_time(F.col("stamp")).alias("ts"), "stamp", "original")


def article_of(html: Column, year: Column) -> Column:
    """struct<title, body> by the layout of the page's time: heading and cells, then meta and article, then linked data."""
    pick = lambda p: F.nullif(clean_text(F.regexp_extract(html, p, 1)), F.lit(""))
    row = lambda t, b: F.struct(t.alias("title"), b.alias("body"))
    old = row(pick(r"(?is)<(?:h1|h2|b)(?:\s[^>]*)?>(.*?)</(?:h1|h2|b)>"), pick(r"(?is)<(?:td|div)(?:\s[^>]*)?>(.*?)</(?:td|div)>"))
    middle = row(pick(r'(?is)<meta[^>]+property="og:title"[^>]+content="([^"]*)"'), pick(r"(?is)<article[^>]*>(.*?)</article>"))
    data = F.regexp_extract(html, r'(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>', 1)
    new = row(F.get_json_object(data, "$.headline"), F.coalesce(F.get_json_object(data, "$.articleBody"), F.get_json_object(data, "$.description")))
    first = F.when(year < 2010, old).when(year < 2020, middle).otherwise(new)
    return row(F.coalesce(first["title"], new["title"], middle["title"], old["title"]), F.coalesce(first["body"], new["body"], middle["body"], old["body"]))


def _trimmed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV's columns without padding, and seq, the order of rows over files and their blocks, however these are read."""
    df = spark.read.option("header", True).csv(path)
    seq = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    return df.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip()) for c in df.columns], seq.alias("seq"))


def missing_persons(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a register with padded headers; rows need a name and a case number, the first of each number stays."""
    df = _trimmed(spark, path).filter((F.coalesce("Last Name", F.lit("")) != "") & (F.coalesce("Case Number", F.lit("")) != ""))
    first = keep_first(df, ["Case Number"])
    return first.select(
        F.concat(F.lit("AK-DPS-"), "Case Number").alias("id"), F.initcap(F.concat_ws(" ", "First Name", "Last Name")).alias("name"), F.col("Sex").alias("sex"), clean_agency(F.col("Investigating Agency")).alias("location"),
        F.to_date(F.try_to_timestamp(F.col("Date Last Contacted"), F.lit("M/d/yyyy"))).alias("last_contact"),
    )


def stolen_vehicles(spark: SparkSession, path: str, size: int = 10) -> DataFrame:
    """Vehicles or plates of a register, with their key, title, and page."""
    df = _trimmed(spark, path)
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    plate = (c("Vin") == "") & (c("License") != "")
    what = join_parts(" ", c("PropertyModelYear"), c("MakeModel"))
    rows = df.select(
        "seq", F.concat_ws("_", F.lit("stolen"), c("Case"), c("Vin")).alias("id"), F.when(plate, F.concat(F.lit("Stolen plate: "), "License")).otherwise(F.concat(F.lit("Stolen vehicle: "), what)).alias("title"),
        join_parts(" | ", c("Color"), c("Style"), c("License"), c("Vin")).alias("summary"), clean_agency(F.col("Agency")).alias("location"), F.col("Case").alias("case_id"),
    )
    return number_pages(rows, [F.col("seq")], size).drop("seq")


def bulletins(df: DataFrame, html: str = "html", order: str = "page_id", base: str = "") -> DataFrame:
    """(name, bulletin, image) of the media links with a picture in pages; of a repeated name, the last by order and place.

    The name is the link's title, else its file without ".pdf", in lower case; base is put before both addresses. Links outside
    /getmedia/ and those without a picture give none; null and empty pages neither.
    """
    attribute = lambda tag, name: F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*["']([^"']*)["']""", 1)
    links = df.select(F.col(order).alias("__o"), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\s[^>]*>.*?</a>"), 0)).alias("__p", "__a"))
    parts = links.select(F.struct("__o", "__p").alias("__at"), F.regexp_extract("__a", "(?is)^<a[^>]*>", 0).alias("__t"), F.regexp_extract("__a", r"(?is)<img\s[^>]*>", 0).alias("__i"))
    parts = parts.select("__at", F.trim(attribute(F.col("__t"), "title")).alias("__n"), attribute(F.col("__t"), "href").alias("__h"), "__i").filter(F.contains("__h", F.lit("/getmedia/")) & (F.col("__i") != ""))
    name = F.coalesce(F.nullif("__n", F.lit("")), F.replace(F.element_at(F.split("__h", "/"), -1), F.lit(".pdf"), F.lit("")))
    rows = parts.select("__at", F.lower(name).alias("name"), F.concat(F.lit(base), "__h").alias("bulletin"), F.concat(F.lit(base), attribute(F.col("__i"), "src")).alias("image"))
    return keep_last(rows, ["name"], "__at").select("name", "bulletin", "image")


def seasonal(as_of: Column) -> Column:
    """A synthetic notice by season; there is no data behind it."""
    m = F.month(as_of)
    return F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring").when(m.isin(6, 7, 8), "summer").otherwise("autumn")


def grant_deadline(cells: Column) -> Column:
    """The last cell of a row that looks like a date."""
    return F.try_element_at(F.filter(cells, lambda c: c.contains("/") | c.contains("202")), F.lit(-1))


def frame_flag(ocr: Column, brightness: Column, words: Sequence[str]) -> Column:
    """Whether a video frame is dark or shows one of words."""
    return (brightness < 10) | contains_any(F.lower(ocr), words)
