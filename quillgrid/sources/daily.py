"""Daily files, YYYY/MM/YYYY-MM-DD.json, each an array of objects: written day by day, read with days pruned by predicates on day."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from datetime import date

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..session import ship

SCHEMA = "day date, position int, item string, error string"
_NAME = re.compile(r"(\d{4})/(\d{2})/(\1-\2-\d{2})\.json$")
#: Predicates on day that choose files; Spark applies all others, and these are whole days, so nothing is left to check.
_CHOOSE: dict[type, Callable[[date, object], bool]] = {
    EqualTo: lambda day, v: day == v, GreaterThan: lambda day, v: day > v, GreaterThanOrEqual: lambda day, v: day >= v,
    LessThan: lambda day, v: day < v, LessThanOrEqual: lambda day, v: day <= v, In: lambda day, v: day in v,
}


def _system(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Day(InputPartition):
    def __init__(self, day: date, name: str):
        self.day, self.name = day, name


class DailyReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.filters = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _CHOOSE and f.attribute == ("day",) and f.value is not None:
                self.filters.append(f)
            else:
                yield f

    def _wanted(self, day: date) -> bool:
        return all(_CHOOSE[type(f)](day, f.value) for f in self.filters)

    def partitions(self) -> list[_Day]:
        system, root = _system(self.path)
        found = []
        for f in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if f.type == fs.FileType.File and (m := _NAME.search(f.path)):
                try:
                    day = date.fromisoformat(m[3])
                except ValueError:  # no day of the calendar
                    continue
                if self._wanted(day):
                    found.append(_Day(day, f.path))
        return sorted(found, key=lambda p: p.day) or [_Day(date.min, "")]

    def read(self, partition: _Day) -> Iterator[tuple]:
        if not partition.name:
            return
        try:
            with _system(self.path)[0].open_input_stream(partition.name) as f:
                items = json.loads(f.read())
            for k, item in enumerate(items if isinstance(items, list) else [items]):
                yield partition.day, k, json.dumps(item, ensure_ascii=False, separators=(",", ":")), None
        except (OSError, ValueError) as e:
            yield partition.day, None, None, f"{type(e).__name__}: {e}"


class Daily(DataSource):
    """Option path: the folder above the years."""

    @classmethod
    def name(cls) -> str:
        return "daily"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return DailyReader(self.options["path"])


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """(day, position, item, error) of daily files, a task for each. Files of days that a filter on day leaves out aren't
    opened; a file that can't be read is a row with its error."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Daily)
    return spark.read.format("daily").load(path)


def write_daily(df: DataFrame, path: str, day: str, order: str, columns: list[str]) -> None:
    """The rows of each day as one file, in order; files of other days stay. A file is written row by row and under another
    name first, so a task holds one row and a lost one leaves no half file. Rows without day go nowhere."""
    ship(df.sparkSession)
    root = path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _system(root)
        now, out = None, None

        def done() -> None:
            if out is not None:
                out.write(b"]")
                out.close()
                system.move(f"{at}/{now[:4]}/{now[5:7]}/.{now}.tmp", f"{at}/{now[:4]}/{now[5:7]}/{now}.json")

        for batch in batches:
            for text, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text != now:
                    done()
                    now = text
                    system.create_dir(f"{at}/{now[:4]}/{now[5:7]}", recursive=True)
                    out = system.open_output_stream(f"{at}/{now[:4]}/{now[5:7]}/.{now}.tmp")
                    out.write(b"[")
                else:
                    out.write(b",")
                out.write(item.encode())
        done()
        yield pa.RecordBatch.from_pylist([], pa.schema([("n", pa.int64())]))

    rows = df.filter(F.col(day).isNotNull()).select(F.date_format(day, "yyyy-MM-dd").alias("d"), F.to_json(F.struct(*columns)).alias("j"), F.col(order).alias("o"))
    rows.repartition("d").sortWithinPartitions("d", "o").select("d", "j").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
