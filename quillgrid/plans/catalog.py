"""The registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import finds, producers, registers, sites, tables  # noqa: F401  they register their queries
from . import queries as q


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.ingest_summary(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)
