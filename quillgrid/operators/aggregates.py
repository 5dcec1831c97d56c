"""Summaries of signals, feeds and archives."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import within


def summary_counts(df: DataFrame, *columns: str) -> DataFrame:
    """(kind, value, n): counts by each column and in all, in one pass over grouping sets."""
    grouped = df.groupingSets([[F.col(c)] for c in columns] + [[]], *[F.col(c) for c in columns]).agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"__{c}") for c in columns])
    kind, value = F.lit("total"), F.lit(None).cast("string")
    for c in columns:
        kind = F.when(F.col(f"__{c}") == 0, c).otherwise(kind)
        value = F.when(F.col(f"__{c}") == 0, F.col(c).cast("string")).otherwise(value)
    return grouped.select(kind.alias("kind"), value.alias("value"), "n")


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n): rows of each value, null among them."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def action_summary(df: DataFrame, kind: str = "type", bill: str = "bill") -> DataFrame:
    """(kind, value, n): actions in all, of each type, and of each bill mentioned, a row for each; null or '' is no bill."""
    named = df.select(F.col(kind).alias("type"), F.nullif(F.col(bill), F.lit("")).alias("bill"))
    return summary_counts(named, "type", "bill").filter("kind <> 'bill' OR value IS NOT NULL")


def delayed(df: DataFrame, status: str = "status") -> DataFrame:
    """One row: airports in all, and those delayed; 0 of an empty table."""
    return df.agg(F.count("*").alias("airports"), F.count_if(F.col(status) == "delayed").alias("delayed"))


def label_of(score: Column) -> Column:
    return F.when(score >= 70, "elevated").when(score >= 45, "normal").otherwise("low")


def pulse(df: DataFrame, groups: Mapping[str, Sequence[str]], as_of: Column, ts: str = "ts", sector: str = "sector", impact: str = "impact", seconds: int = 7 * 86_400) -> DataFrame:
    """(index, score, label): the whole part of the mean impact of recent rows of each group of sectors, 0 without any."""
    recent = df.filter(within(F.col(ts), as_of, seconds))
    score = lambda s: F.coalesce(F.floor(F.avg(F.when(F.col(sector).isin(*s), F.coalesce(impact, F.lit(30))))), F.lit(0))
    wide = recent.agg(*[score(s).cast("int").alias(k) for k, s in groups.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("index"), F.col(k).alias("score")) for k in groups]))
    return wide.select(rows.alias("x")).select("x.*").withColumn("label", label_of(F.col("score")))


def quake_extent(df: DataFrame, magnitude: str, tsunami: str) -> DataFrame:
    """Largest and least magnitude (0 and null don't count) and the number of tsunami flags."""
    m = F.when(F.col(magnitude) != 0, F.col(magnitude))
    return df.agg(F.max(m).alias("max_magnitude"), F.min(m).alias("min_magnitude"), F.count_if(F.col(tsunami)).alias("tsunamis"))


def fire_totals(df: DataFrame, acres: str, contained: str) -> DataFrame:
    return df.agg(F.count("*").alias("fires"), F.sum(F.coalesce(acres, F.lit(0.0))).alias("acres"), F.count_if(F.col(contained) >= 100).alias("contained"))


def coverage(df: DataFrame, present: Mapping[str, Column]) -> DataFrame:
    """(field, n, percent) of rows that have each field."""
    wide = df.agg(F.count("*").alias("__n"), *[F.count_if(c).alias(k) for k, c in present.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("n")) for k in present]))
    return wide.select("__n", rows.alias("x")).select("x.*", F.when(F.col("__n") > 0, F.floor(100 * F.col("x.n") / F.col("__n"))).otherwise(0).cast("long").alias("percent"))


def health(df: DataFrame, status: str = "status", probation: str = "probation") -> DataFrame:
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return df.agg(
        F.count("*").alias("total"), is_(status, "ok").alias("healthy"), is_(status, "warning").alias("warnings"), is_(status, "error").alias("errors"),
        F.when(F.count("*") > 0, F.bround(100 * is_(status, "ok") / F.count("*"), 1)).alias("health_score"),
        is_(probation, "approved").alias("approved"), is_(probation, "probation").alias("on_probation"), is_(probation, "failing").alias("failing"),
    )


def manifest(fingerprints: DataFrame, as_of: Column, ts: str = "ts", source: str = "source", days: int = 30) -> DataFrame:
    """(source, archived, recent) of each source."""
    recent = within(F.col(ts), as_of, days * 86_400)
    return fingerprints.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(F.count("*").alias("archived"), F.count_if(recent).alias("recent"))


def months(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The months that have rows, newest first."""
    return df.filter(F.col(ts).isNotNull()).select(F.date_format(ts, "yyyy/MM").alias("month")).distinct().orderBy(F.desc("month"))


def contents(df: DataFrame, page: str, *columns: str) -> DataFrame:
    """(page, entries): the rows of each page, a bounded number by construction."""
    return df.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("entries"))


def distinct_values(df: DataFrame, group: str, array: str) -> DataFrame:
    """Distinct values of an array column, sorted: counted by value first, so that a hot group stays small."""
    values = df.select(group, F.explode(array).alias("v")).distinct()
    return values.groupBy(group).agg(F.array_sort(F.collect_list("v")).alias("values"))


def longest(df: DataFrame, group: str, text: str, position: str) -> DataFrame:
    return df.groupBy(group).agg(F.max_by(text, F.struct(F.length(text), -F.col(position))).alias("longest"))


def by_period(df: DataFrame, compact: str) -> DataFrame:
    """Snapshots by the year of a compact time, with the first and the last."""
    return df.groupBy(F.substring(compact, 1, 4).alias("year")).agg(F.count("*").alias("n"), F.min(compact).alias("first"), F.max(compact).alias("last"))
