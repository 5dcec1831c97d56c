"""Resolving places: mileposts, tiers of ever coarser guesses, and rows that have no place yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import tag_region
from ..session import settle
from .gazetteer import longest_name
from .joins import contained, first_part, nearest


def mileposts(df: DataFrame, posts: DataFrame, highway: Column, mile: Column, row: str = "id", reach: float = 2.0) -> DataFrame:
    """df with route, lat and lng of the milepost nearest to a whole mile (half-even) on its highway, within reach.

    posts: (route, mile, lat, lng). A highway that isn't a route takes the first route, by name, that contains it or that
    it contains; distinct names meet by their rarest grams, in both directions.
    """
    named = df.withColumns({"__hwy": geo.highway_name(highway), "__mile": F.bround(mile).cast("double")})
    routes = posts.select("route").distinct()
    names = named.select("__hwy").filter("__hwy IS NOT NULL").distinct()
    exact = names.join(routes.withColumnRenamed("route", "__hwy"), "__hwy", "left_semi").select("__hwy", F.col("__hwy").alias("route"))
    left = settle(names.join(exact.select("__hwy"), "__hwy", "left_anti"), "names")
    wider, narrower = contained(left, "__hwy", routes, "route"), contained(routes, "route", left, "__hwy")
    loose = wider.select(F.col("text").alias("__hwy"), F.col("word").alias("route")).unionByName(narrower.select(F.col("word").alias("__hwy"), F.col("text").alias("route")))
    loose = loose.groupBy("__hwy").agg(F.min("route").alias("route"))
    routed = named.join(exact.unionByName(loose), "__hwy", "left")
    at = posts.select("route", F.col("mile").cast("double").alias("__post"), F.col("lat").alias("post_lat"), F.col("lng").alias("post_lng"))
    found = nearest(routed, at, ["route"], "__mile", "__post", ["post_lat", "post_lng"], reach, row)
    return found.select(*df.columns, "route", F.col("post_lat").alias("lat"), F.col("post_lng").alias("lng"))


def midpoints(posts: DataFrame) -> DataFrame:
    """(route, lat, lng): the middle post of each route, by mile."""
    ordered = posts.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("mile", "lat", "lng"))).alias("p"))
    middle = F.get("p", F.floor(F.size("p") / 2).cast("int"))
    return ordered.select("route", middle["lat"].alias("lat"), middle["lng"].alias("lng"))


def resolve(df: DataFrame, posts: DataFrame, cities: DataFrame, row: str = "id", location: str = "location", region: str = "region", tag: str = "dataTag") -> DataFrame:
    """df with tier, lat and lng: highway and mile (within 5), the highway's middle, a city among the location's parts
    (name, lat, lng), or the center of the region, the row's own or its tag's. tier is null where nothing fits."""
    mile = F.regexp_extract(location, r"(?i)mile\s+(\d+)", 1).try_cast("double")
    text = F.lower(location)
    highway = F.nullif(F.trim(F.regexp_extract(text, r"([a-z]+ (?:highway|hwy))", 1)), F.lit(""))
    base = df.select(row, F.col(location).alias("location"), F.coalesce(F.nullif(F.col(region), F.lit("")), tag_region(F.col(tag))).alias("__region"), mile.alias("__m"), highway.alias("__h"))
    one = mileposts(base, posts, F.col("__h"), F.col("__m"), row, 5.0).select(row, "route", F.col("lat").alias("lat1"), F.col("lng").alias("lng1"))
    middle = midpoints(posts).select("route", F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    three = first_part(base.select(row, "location"), "location", cities.select("name", F.col("lat").alias("lat3"), F.col("lng").alias("lng3")), "name", ["lat3", "lng3"], row).select(row, "lat3", "lng3")
    joined = base.join(one, row, "left").join(middle, "route", "left").join(three, row, "left").withColumn("__c", geo.region_center(F.col("__region")))
    tiers = [("lat1", "lng1"), ("lat2", "lng2"), ("lat3", "lng3"), ("__c.lat", "__c.lng")]
    tier = F.coalesce(*[F.when(F.col(a).isNotNull(), F.lit(k + 1)) for k, (a, _) in enumerate(tiers)])
    found = joined.select(row, tier.alias("tier"), F.coalesce(*[F.col(a) for a, _ in tiers]).alias("lat"), F.coalesce(*[F.col(b) for _, b in tiers]).alias("lng"))
    return df.drop("tier", "lat", "lng").join(found, row, "left")


def fill_places(df: DataFrame, text: Column, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows without a place get that of the place named in text."""
    p = geo.place_of(text)
    missing = F.col(lat).isNull() | F.col(lng).isNull()
    return df.withColumn("__p", p).withColumns({lat: F.when(missing, F.col("__p.lat")).otherwise(F.col(lat)), lng: F.when(missing, F.col("__p.lng")).otherwise(F.col(lng))}).drop("__p")


def street_points(df: DataFrame, streets: DataFrame, row: str, text: str, step: float = 0.0016) -> DataFrame:
    """df with street, lat and lng of the longest street name in text (longest_name); "N00 block" moves the point west, a step
    for each hundred. streets: (name, lat, lng), a table of any size; of a repeated name, in any case, the least point.

    row must be unique. Rows without a street have null in all three; columns of df of these names are replaced.
    """
    points = streets.select(F.lower(F.trim("name")).alias("street"), F.struct("lat", "lng").alias("__p")).groupBy("street").agg(F.min("__p").alias("__p"))
    named = longest_name(df, streets, row, text).withColumnRenamed("name", "street").join(points, "street").select(F.col(row).alias("__row"), "street", "__p")
    block = F.regexp_extract(F.lower(F.col(text)), r"(\d{1,4})\s+block", 1).try_cast("double")
    kept = df.drop("street", "lat", "lng").withColumn("__moved", F.coalesce(block / 100 * step, F.lit(0.0)))
    joined = kept.join(named, F.col(row) == F.col("__row"), "left")
    return joined.select(*kept.drop("__moved").columns, "street", F.col("__p.lat").alias("lat"), (F.col("__p.lng") - F.col("__moved")).alias("lng"))
