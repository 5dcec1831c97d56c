"""Top rows of groups, carried headings, pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def top_n(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most n rows of each group. Spark drops the rest before the shuffle (window group limit)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """df in ranges of order, with __p, the range, and __i, the place in it. Written once, so that every later read sees the
    same ranges: their bounds are sampled anew by each plan."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__m": F.monotonically_increasing_id()})
    return settle(dealt.withColumn("__i", F.col("__m") - F.shiftleft(F.col("__p").cast("long"), 33)).drop("__m"), "ranged")


def fill_forward(df: DataFrame, columns: Sequence[str], order: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Each null gets the last value above it, of its group if there are groups (null is a group too).

    A segmented scan: rows are dealt by ranges of groups and order, so that neither the whole table nor a hot group goes
    through one task; the last values of each range, one row for a range and group, are carried to the next ones.
    """
    ranged = _ranged(df, [F.col(c) for c in [*groups, *order]])
    lasts = ranged.groupBy(*groups, "__p").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__i"))).alias(f"__c{k}") for k, c in enumerate(columns)])
    above = Window.partitionBy(*groups).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    carried = [f"__c{k}" for k in range(len(columns))]
    named = lasts.select(F.col("__p").alias("__q"), *[F.col(g).alias(f"__g{k}") for k, g in enumerate(groups)], *[F.last(c, ignorenulls=True).over(above).alias(c) for c in carried])
    named = named.filter(reduce(or_, [F.col(c).isNotNull() for c in carried]))  # few groups reach over ranges
    same = F.col("__p") == F.col("__q")
    for k, g in enumerate(groups):
        same &= ranged[g].eqNullSafe(F.col(f"__g{k}"))
    own = Window.partitionBy(*groups, "__p").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(own), F.col(f"__c{k}")) for k, c in enumerate(columns)}
    return ranged.join(named, same, "left").withColumns(filled).select(*df.columns)


def pages(df: DataFrame, order: Sequence[Column], size: int = 10) -> DataFrame:
    """Page numbers from 1 over all rows in order.

    A total order without one big task: rows are dealt by ranges, counted by range, and each range starts at the sum of
    those before it. Only one count for each range goes through one task.
    """
    numbered = _ranged(df, order)
    counts = numbered.groupBy("__p").agg(F.count("*").alias("__c"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = numbered.join(F.broadcast(before.select("__p", "__before")), "__p")  # a row for each range
    return placed.withColumn("page", (F.floor((F.col("__before") + F.col("__i")) / size) + 1).cast("long")).drop("__p", "__i", "__before")


def newest(df: DataFrame, ts: str, tie: str, n: int) -> DataFrame:
    """The n newest rows, unreadable times last, ties by their first position."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tie)).limit(n)
