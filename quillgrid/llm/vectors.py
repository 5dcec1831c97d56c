"""Rows of integer vectors, which the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest magnitude of an integer component: sums of products over 4096 of them stay below 2^63.
LARGEST = 1 << 24


def finite(vector: str) -> Column:
    """Whether a vector isn't null, and none of its components is null, NaN or infinite. Never null."""
    v = F.col(vector)
    whole = (F.size(F.array_compact(v)) == F.size(v)) & (F.array_max(v) < float("inf")) & (F.array_min(v) > float("-inf"))
    return v.isNotNull() & ((F.size(v) == 0) | F.coalesce(whole, F.lit(False)))


def small(vector: str, scale: int) -> Column:
    """Whether all components, times scale, stay within LARGEST. Not null for finite vectors."""
    return (F.size(vector) > 0) & (F.array_max(vector) * float(scale) < LARGEST) & (F.array_min(vector) * float(scale) >= -LARGEST)


def usual_size(rows: DataFrame, vector: str, multiple: int = 1) -> int:
    """The most frequent size that is a positive multiple of multiple, the smallest of equal ones; 0 where there is none."""
    sizes = rows.select(F.size(vector).alias("size")).filter((F.col("size") > 0) & (F.col("size") % multiple == 0)).groupBy("size")
    row = sizes.count().orderBy(F.desc("count"), "size").first()
    return row["size"] if row else 0


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """A column of lists of size numbers each, without nulls, as rows of an array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
