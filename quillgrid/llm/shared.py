"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove as _remove
from ..session import shared_folder, ship

#: Rows of one Arrow batch handed to Python: bounds what a worker holds when texts are long.
ROWS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Before Python runs on the executors: they get this package, and Arrow batches small enough for long texts (a
    smaller setting of the user's stays)."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and lost executors cost nothing that came before."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quillgrid-{uuid.uuid4().hex}/{name}"
    # The frame runs this once, so its shuffle files can go as soon as the table is written.
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, None)
    spark.conf.set(clean, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(clean) if before is None else spark.conf.set(clean, before)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a settled table that nothing reads any more."""
    for path in df.inputFiles()[:1]:
        _remove(df.sparkSession, path.rpartition("/")[0])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once: a lambda variable is bound, where a repeated expression is run again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Strings of an Arrow column, null as empty; bytes that are no UTF-8 become U+FFFD."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [(x or b"").decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_rows(df: DataFrame, columns: list[str], schema: str, rows: Callable[..., Iterable[dict | None]]) -> DataFrame:
    """df's columns, then those of schema, from rows(*Arrow columns) which gives one dict for each row of a batch.

    A column of df whose name clashes with one of schema gives way to it.
    """
    prepare(df.sparkSession)
    added = df.sparkSession.createDataFrame([], schema).schema
    names = {f.name for f in added}
    kept = [f for f in df.schema if f.name not in names]
    used = [c for c in columns if c not in {f.name for f in kept}]
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], *[F.col(f"`{c}`").alias(f"__in_{c}") for c in used])
    at = {c: (f"__in_{c}" if c in used else c) for c in columns}
    n = len(kept)
    arrow = {f.name: _arrow_type(f.dataType) for f in added}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = list(rows(*[batch.column(batch.schema.get_field_index(at[c])) for c in columns]))
            cols = [pa.array([r[k] for r in made], t) for k, t in arrow.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *cols], [*batch.schema.names[:n], *arrow])

    schema_out = type(added)([*kept, *added.fields])
    return source.mapInArrow(run, schema_out)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
