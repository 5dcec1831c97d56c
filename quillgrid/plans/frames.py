"""Signals made of the test tables, in Spark and in SQL, so that every operator runs on shared rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import title_link_key

AS_OF = "2024-01-30 00:00:00"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def documents(spark: SparkSession, d: str) -> DataFrame:
    """Signals of documents: the first 60 characters are the title, the language is the category."""
    title, link = F.substring("text", 1, 60), F.concat(F.lit("https://example.org/"), "source", F.lit("/"), F.col("doc_id"))
    return table(spark, d, "documents").select(F.col("doc_id").alias("seq"), title.alias("title"), link.alias("link"), F.col("text").alias("summary"), F.col("lang").alias("category"), "source", title_link_key(title, link).alias("hash"))


DOCUMENTS = """(SELECT doc_id AS seq, substring(text,1,60) AS title, 'https://example.org/'||source||'/'||doc_id AS link, text AS summary, lang AS category, source,
  md5(substring(text,1,60)||'|'||'https://example.org/'||source||'/'||doc_id) AS hash FROM documents)"""


def events(spark: SparkSession, d: str) -> DataFrame:
    """Signals of events: sector by type, nine regions by user, places by plain arithmetic."""
    u, e = F.col("user_id"), F.col("event_id")
    return table(spark, d, "events").select(
        e.alias("seq"), F.md5(e.cast("string").cast("binary")).alias("hash"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("sector"),
        F.concat(F.lit("r"), u % 9).alias("region"), F.least(F.lit(100), F.greatest(F.lit(10), F.floor("value").cast("int"))).alias("impact"),
        (F.lit(60.0) + (u % 50) * 0.01 + (e % 7) * 0.001).alias("lat"), (F.lit(-150.0) + (u % 40) * 0.01).alias("lng"), u.alias("user_id"), F.col("value"), F.col("props"),
    )


EVENTS = """(SELECT event_id AS seq, md5(event_id::VARCHAR) AS hash, ts, event_type AS sector, 'r'||(user_id % 9) AS region,
  least(100, greatest(10, floor(value)::INT)) AS impact, 60.0::DOUBLE + (user_id % 50)*0.01::DOUBLE + (event_id % 7)*0.001::DOUBLE AS lat,
  -150.0::DOUBLE + (user_id % 40)*0.01::DOUBLE AS lng, user_id, value, props FROM events)"""
