"""The signal schema, and the adapters that bring every producer's rows into it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import has_offset, parse_iso

#: Fields of a signal; ts and ts_has_offset are derived, timestamp keeps the producer's text.
SIGNAL = (
    "hash string, source string, category string, title string, link string, published string, summary string, dataTag string, sourceAttribution string, imageUrl string, timestamp string, "
    "impactScore int, region string, sector string, urgency string, entitySlugs array<string>, relatedSignalIds array<string>"
)
#: Where producers put what a signal calls otherwise, in order of preference.
ALIASES = {"hash": ["hash", "id"], "link": ["link", "articleUrl", "url"], "summary": ["summary", "content", "description"], "timestamp": ["timestamp", "published", "scraped_at"], "category": ["category", "topic", "section"]}

QUAKE = "struct<id:string,properties:struct<mag:double,place:string,time:long,updated:long,url:string,detail:string,status:string,tsunami:int,type:string,title:string,alert:string,felt:int,cdi:double,mmi:double,sig:int>,geometry:struct<type:string,coordinates:array<double>>>"
ALERT = (
    "struct<id:string,properties:struct<id:string,event:string,headline:string,description:string,severity:string,certainty:string,urgency:string,senderName:string,sent:string,effective:string,expires:string,"
    "areaDesc:string,category:string,response:string,instruction:string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>"
)


def _pick(df: DataFrame, names: Sequence[str]) -> Column:
    found = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def adapt(df: DataFrame, source: str | None = None, strict_link: bool = False) -> DataFrame:
    """df as signals. Fields a producer doesn't have are null; strict_link takes no other name for link. seq, the order of
    arrival, stays where df has it."""
    kinds = {f.name: f.dataType for f in df.sparkSession.createDataFrame([], SIGNAL).schema}
    out = {}
    for name, kind in kinds.items():
        names = ALIASES.get(name, [name])
        if name == "link" and strict_link:
            names = ["link"]
        if name in ALIASES:
            out[name] = _pick(df, names)
        else:
            out[name] = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
    if source:
        out["source"] = F.coalesce(out["source"], F.lit(source))
    if "seq" in df.columns:
        out["seq"] = F.col("seq").cast("long")
    return df.select(*[c.alias(n) for n, c in out.items()]).withColumns({"ts": parse_iso(F.col("timestamp")), "ts_has_offset": F.coalesce(has_offset(F.col("timestamp")), F.lit(False))})


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: str = SIGNAL) -> DataFrame:
    """Arrays of objects in whole files; a damaged file gives rows of nulls, not an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(paths if isinstance(paths, str) else list(paths))


def read_existing(spark: SparkSession, paths: Sequence[str], schema: str = SIGNAL) -> DataFrame:
    """The files among paths that are there; none is an empty table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def there(p: str) -> bool:
        at = jvm.org.apache.hadoop.fs.Path(p)
        return at.getFileSystem(conf).exists(at)

    found = [p for p in paths if there(p)]
    return read_json(spark, found, schema) if found else spark.createDataFrame([], schema)


def _features(df: DataFrame, text: str, feature: str) -> DataFrame:
    return df.select(F.explode(F.from_json(F.col(text), f"struct<features:array<{feature}>>")["features"]).alias("f"))


def quakes(df: DataFrame, text: str = "value", south: float = 50, north: float = 72, west: float = -180, east: float = -129, least: float = 1.5, most: int = 200) -> DataFrame:
    """Quakes of GeoJSON documents within a box and from a magnitude on, the newest most."""
    p, c = F.col("f.properties"), F.col("f.geometry.coordinates")
    rows = _features(df, text, QUAKE).select(
        F.col("f.id").alias("id"), p["mag"].alias("magnitude"), p["place"].alias("place"), F.timestamp_millis(p["time"]).alias("ts"), F.timestamp_millis(p["updated"]).alias("updated"), p["url"].alias("url"),
        (p["tsunami"] == 1).alias("tsunami"), p["alert"].alias("alert"), p["title"].alias("title"), F.get(c, F.lit(0)).alias("lng"), F.get(c, F.lit(1)).alias("lat"), F.get(c, F.lit(2)).alias("depth"),
    )
    near = F.col("lat").between(south, north) & F.col("lng").between(west, east) & (F.col("magnitude") >= least)
    return rows.filter(near).orderBy(F.desc("ts"), "id").limit(most)


def alerts(df: DataFrame, text: str = "value") -> DataFrame:
    """Weather alerts with the centroid of their polygon, texts cut to fixed lengths."""
    from ..functions.geo import centroid

    p = F.col("f.properties")
    ring = F.get(F.col("f.geometry.coordinates"), F.lit(0))
    rows = _features(df, text, ALERT).select(
        F.coalesce(p["id"], F.col("f.id")).alias("id"), *[p[k].alias(k) for k in ("event", "headline", "severity", "certainty", "urgency", "senderName", "sent", "effective", "expires", "areaDesc", "category", "response")],
        F.substring(p["description"], 1, 500).alias("description"), F.substring(p["instruction"], 1, 300).alias("instruction"), F.when(ring.isNotNull(), centroid(ring)).alias("at"),
    )
    return rows.withColumns({"lat": F.col("at.lat"), "lng": F.col("at.lng")}).drop("at")


def alert_signals(rows: DataFrame, quiet_events: Sequence[str] = (), quiet: Sequence[str] = ("Minor", "Moderate")) -> DataFrame:
    """Signals of alerts: quiet kinds of event go when they aren't severe; long area lists are statewide."""
    from ..operators.filters import alert_levels

    impact, urgency = alert_levels(F.col("severity"), F.col("urgency"))
    key = F.md5(F.col("id").cast("binary"))
    kept = rows.filter(~(F.col("event").isin(*quiet_events) & F.col("severity").isin(*quiet))) if quiet_events else rows
    region = F.when(F.length("areaDesc") > 50, "Statewide").otherwise(F.col("areaDesc"))
    return kept.select(key.alias("hash"), key.alias("id"), F.coalesce("headline", "event").alias("title"), F.when(F.length("description") > 400, F.concat(F.substring("description", 1, 397), F.lit("..."))).otherwise(F.col("description")).alias("summary"), F.col("sent").alias("timestamp"), impact.alias("impactScore"), urgency.alias("urgency"), region.alias("region"), "lat", "lng")


OBSERVATION = "struct<geometry:struct<coordinates:array<double>>,properties:struct<timestamp:string,textDescription:string,temperature:struct<value:double>,windSpeed:struct<value:double>,windDirection:struct<value:double>,relativeHumidity:struct<value:double>>>"


def _half_even(x: Column) -> Column:
    """To one decimal, by the double's own tenfold: 111.85000000000001 is 1118.5 tenths and goes to the even 1118."""
    return F.rint(x * 10) / 10


def observations(df: DataFrame, text: str = "value", station: str = "station") -> DataFrame:
    """Station readings in Fahrenheit and miles an hour, half-even to one decimal."""
    o = df.select(station, F.from_json(F.col(text), OBSERVATION).alias("o"))
    p = F.col("o.properties")
    return o.select(
        station, p["timestamp"].alias("timestamp"), p["textDescription"].alias("conditions"), _half_even(p["temperature"]["value"] * 9 / 5 + 32).alias("temp_f"), _half_even(p["windSpeed"]["value"] * 2.237).alias("wind_mph"),
        p["windDirection"]["value"].alias("wind_direction"), F.bround(p["relativeHumidity"]["value"], 0).alias("humidity"), F.get("o.geometry.coordinates", F.lit(1)).alias("lat"), F.get("o.geometry.coordinates", F.lit(0)).alias("lng"),
    )


INCIDENT = "struct<attributes:struct<IrwinID:string,OBJECTID:long,IncidentName:string,IncidentTypeCategory:string,FireCause:string,DailyAcres:double,CalculatedAcres:double,PercentContained:double,FireDiscoveryDateTime:long,ModifiedOnDateTime:long,POOCounty:string>,geometry:struct<x:double,y:double>>"


def fires(df: DataFrame, text: str = "value") -> DataFrame:
    """Fire incidents; acres are the first figure that isn't zero."""
    a = F.col("f.attributes")
    return _features(df, text, INCIDENT).select(
        F.coalesce(a["IrwinID"], a["OBJECTID"].cast("string")).alias("id"), a["IncidentName"].alias("name"), F.coalesce(a["FireCause"], F.lit("Unknown")).alias("cause"),
        F.coalesce(F.nullif(a["DailyAcres"], F.lit(0.0)), F.nullif(a["CalculatedAcres"], F.lit(0.0)), F.lit(0.0)).alias("acres"), F.coalesce(a["PercentContained"], F.lit(0.0)).alias("contained"),
        F.timestamp_millis(a["FireDiscoveryDateTime"]).alias("discovered"), F.timestamp_millis(a["ModifiedOnDateTime"]).alias("ts"), F.col("f.geometry.y").alias("lat"), F.col("f.geometry.x").alias("lng"),
    )


FIRE_POINT = "struct<properties:struct<NAME:string,RECORDNUMBER:string,OBJECTID:long,ESTIMATEDTOTALACRES:double,IASIZE:double,DISCOVERYDATETIME:long,OUTDATE:long,STATUS:string,GENERALCAUSE:string>,geometry:struct<coordinates:array<double>>>"


def fire_points(df: DataFrame, as_of: Column, text: str = "value", out_days: int = 7) -> DataFrame:
    """Named fires that aren't out for more than out_days."""
    p = F.col("f.properties")
    rows = _features(df, text, FIRE_POINT).select(
        F.coalesce(p["RECORDNUMBER"], p["OBJECTID"].cast("string")).alias("id"), p["NAME"].alias("name"), F.coalesce(F.nullif(p["ESTIMATEDTOTALACRES"], F.lit(0.0)), p["IASIZE"], F.lit(0.0)).alias("acres"), p["STATUS"].alias("status"),
        F.timestamp_millis(p["DISCOVERYDATETIME"]).alias("discovered"), F.timestamp_millis(p["OUTDATE"]).alias("out"), F.get("f.geometry.coordinates", F.lit(1)).alias("lat"), F.get("f.geometry.coordinates", F.lit(0)).alias("lng"),
    )
    gone = (F.col("status") == "Out") & (F.datediff(as_of, "out") > out_days)
    return rows.filter((F.coalesce("name", F.lit("")) != "") & ~F.coalesce(gone, F.lit(False)))


NOTICE = "array<struct<observatory:string,noticeNumber:string,volcanoName:string,content:string,alertLevel:string,aviationColorCode:string,issuedTime:string,volcanoes:array<struct<latitude:double,longitude:double>>>>"


def volcano_notices(df: DataFrame, text: str = "value", observatory: str = "AVO", most: int = 50) -> DataFrame:
    from ..operators.filters import volcano_score

    n = df.select(F.posexplode(F.slice(F.from_json(F.col(text), NOTICE), 1, most)).alias("i", "n")).filter(F.col("n.observatory") == observatory)
    calm = (F.upper("n.aviationColorCode") == "GREEN") & (F.upper("n.alertLevel") == "NORMAL")
    v = F.get("n.volcanoes", F.lit(0))
    key = F.md5(F.col("n.noticeNumber").cast("binary"))
    body = F.concat(F.substring(F.trim(F.regexp_replace("n.content", "<[^>]+>", "")), 1, 400), F.lit("..."))
    return n.filter(~F.coalesce(calm, F.lit(False))).select(key.alias("hash"), F.col("n.volcanoName").alias("title"), body.alias("summary"), F.col("n.issuedTime").alias("timestamp"), volcano_score(F.upper("n.aviationColorCode"), F.upper("n.alertLevel")).alias("impactScore"), v["latitude"].alias("lat"), v["longitude"].alias("lng"))


ROAD_EVENT = "struct<id:string,type:string,eventType:string,roadwayName:string,road:string,directionOfTravel:string,direction:string,description:string,headline:string,latitude:double,lat:double,longitude:double,lng:double,lon:double,startPoint:struct<latitude:double,longitude:double>,reported:string,startDate:string,created:string>"


def road_events(df: DataFrame, text: str = "value") -> DataFrame:
    """Road events of any of three wrappings (an array, events, features), with every name a field may have."""
    from ..operators.filters import region, road_levels

    one_id = F.replace(F.col(text), F.lit('"ID":'), F.lit('"id":'))
    doc = F.from_json(one_id, f"struct<events:array<{ROAD_EVENT}>,features:array<struct<properties:{ROAD_EVENT}>>>")
    plain = F.from_json(one_id, f"array<{ROAD_EVENT}>")
    every = F.coalesce(doc["events"], F.transform(doc["features"], lambda x: x["properties"]), plain)
    e = df.select(F.explode(F.filter(every, lambda x: x["id"].isNotNull())).alias("e"))
    c = lambda *names: F.coalesce(*[F.col(f"e.{n}") for n in names])
    urgency, impact = road_levels(c("type", "eventType"))
    described = F.coalesce(c("description", "headline"), F.lit(""))
    from ..functions.catalogs import ROAD_REGIONS

    return e.select(
        F.concat(F.lit("511-"), F.md5(c("id").cast("binary"))).alias("hash"), c("type", "eventType").alias("type"), F.concat_ws(" ", c("roadwayName", "road"), c("directionOfTravel", "direction")).alias("title"),
        F.when(F.length(described) > 300, F.concat(F.substring(described, 1, 297), F.lit("..."))).otherwise(described).alias("summary"), F.coalesce(c("latitude", "lat"), F.col("e.startPoint.latitude")).alias("lat"),
        F.coalesce(c("longitude", "lng", "lon"), F.col("e.startPoint.longitude")).alias("lng"), c("reported", "startDate", "created").alias("timestamp"), urgency.alias("urgency"), impact.alias("impactScore"),
        region(F.lower(F.concat_ws(" ", c("roadwayName", "road"), described)), ROAD_REGIONS).alias("region"),
    )


def cameras(df: DataFrame, text: str = "value") -> DataFrame:
    c = df.select(F.explode(F.from_json(F.col(text), "array<struct<id:string,name:string,description:string,latitude:double,longitude:double,views:array<struct<url:string>>>>")).alias("c"))
    return c.select("c.id", "c.name", F.col("c.latitude").alias("lat"), F.col("c.longitude").alias("lng"), F.get("c.views", F.lit(0))["url"].alias("url"))


def flight_restrictions(df: DataFrame, text: str = "value", state: str = "AK", south: float = 50, north: float = 72, west: float = -180, east: float = -129) -> DataFrame:
    t = df.select(F.explode(F.from_json(F.col(text), "array<struct<notam:string,notamNumber:string,type:string,description:string,reason:string,state:string,lat:string,latitude:string,lng:string,longitude:string>>")).alias("t"))
    lat, lng = F.coalesce(F.col("t.lat"), F.col("t.latitude")).try_cast("double"), F.coalesce(F.col("t.lng"), F.col("t.longitude")).try_cast("double")
    rows = t.select(F.coalesce("t.notam", "t.notamNumber").alias("id"), "t.type", F.coalesce("t.description", "t.reason").alias("description"), F.col("t.state").alias("state"), lat.alias("lat"), lng.alias("lng"))
    outside = F.col("lat").isNotNull() & F.col("lng").isNotNull() & ~(F.col("lat").between(south, north) & F.col("lng").between(west, east))
    return rows.filter(F.coalesce("state", F.lit("")).isin("", state) & ~outside)


def airport_status(airports: DataFrame, responses: DataFrame) -> DataFrame:
    """Every airport (code) with its response (code, http, delay, failed): no answer is normal, a failure unknown."""
    j = airports.join(responses, "code", "left")
    return j.select(*airports.columns, F.when(F.coalesce("failed", F.lit(False)), "unknown").when((F.col("http") == 200) & F.col("delay"), "delayed").otherwise("normal").alias("status"))


def municipal_notices(df: DataFrame, text: str = "value") -> DataFrame:
    r = df.select(F.explode(F.from_json(F.col(text), "struct<d:struct<results:array<struct<Id:long,Title:string,Created:string,PublicNoticeEventStart:string>>>>")["d"]["results"]).alias("r"))
    title = F.when(F.length("r.Title") > 150, F.concat(F.substring("r.Title", 1, 150), F.lit("..."))).otherwise(F.col("r.Title"))
    return r.select(F.md5(F.col("r.Id").cast("string").cast("binary")).alias("hash"), title.alias("title"), F.coalesce("r.PublicNoticeEventStart", "r.Created").alias("timestamp"))


def land_sales(df: DataFrame, known: DataFrame, text: str = "value", most_new: int = 10, cap: int = 500) -> DataFrame:
    """Open land sales that known (id, seq) doesn't have, at most most_new, before the known ones, cap in all."""
    p = F.col("f.properties")
    rows = _features(df, text, "struct<properties:struct<CASE_ID:string,FILENUMBER:string,CSSTTSDSCR:string,CSTMRNM:string>>").select(F.coalesce(p["FILENUMBER"], p["CASE_ID"]).alias("id"), p["CSTMRNM"].alias("name"), p["CSSTTSDSCR"].alias("status"))
    fresh = rows.filter(~F.coalesce(F.upper("status").rlike("CLOSED|EXPIRED|REJECTED"), F.lit(False))).join(known.select("id"), "id", "left_anti").orderBy("id").limit(most_new)
    return fresh.select("id", F.lit(0).alias("side"), F.lit(0).cast("long").alias("seq")).unionByName(known.select("id", F.lit(1).alias("side"), F.col("seq").cast("long").alias("seq"))).orderBy("side", "seq", "id").limit(cap).drop("side")
