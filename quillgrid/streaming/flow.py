"""Streams of signals: new ones only, late ones out, windows, and a micro-batch upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import priority_merge


def fresh(stream: DataFrame, key: str = "hash", ts: str = "ts", delay: str = "2 days") -> DataFrame:
    """The first of each key while the watermark remembers it; later than delay is late."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def counts(stream: DataFrame, by: str, ts: str = "ts", width: str = "1 hour", slide: str | None = None, delay: str = "2 hours") -> DataFrame:
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, delay).groupBy(w, by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def sessions(stream: DataFrame, by: str, ts: str = "ts", gap: str = "30 minutes", delay: str = "2 hours") -> DataFrame:
    return stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def upsert_batches(path: str, key: str = "hash", seq: str = "seq"):
    """For foreachBatch: each batch is merged into the newest version under path, and written as the next one.

    A version is a whole folder named by its batch, so a batch that runs again writes the same folder again, and readers
    never see a half. current(spark, path) reads the newest.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        old = current(spark, path, before=epoch)
        merged = priority_merge([old, batch] if old is not None else [batch], [key], seq, last_wins=True)
        merged.write.mode("overwrite").parquet(f"{path}/v={epoch:012d}")

    return run


def current(spark, path: str, before: int | None = None) -> DataFrame | None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    versions = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("v=") and fs.exists(s.getPath().suffix("/_SUCCESS")))
    versions = [v for v in versions if before is None or int(v[2:]) < before]
    return spark.read.parquet(f"{path}/{versions[-1]}") if versions else None
