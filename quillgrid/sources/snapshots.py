"""Backfill from a web archive, snapshot by snapshot: a stream over a manifest, whose checkpoint says how far it got.

The offset of the stream is the last entry taken, by stamp and address, not a count: entries that are added to the manifest later are
read if they come after it. A batch takes the next entries; they are fetched in the executors, some in each task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions import extract as X
from ..functions.text import clean_text
from ..functions.times import compact_time, posted_time
from ..session import ship
from .feeds import http_fetch

SCHEMA = "stamp string, original string, status int, body string, error string"
#: Entries (stamp, address) to (status, body) each, in their order; what it raises becomes the entry's error.
Fetch = Callable[[list[tuple[str, str]]], Iterable[tuple[int, str]]]


def one_by_one(address: Callable[[str, str], str] = lambda stamp, original: original, timeout: float = 20.0) -> Fetch:
    """Fetches address(stamp, original) over HTTP."""

    def fetch(entries: list[tuple[str, str]]) -> Iterator[tuple[int, str]]:
        for stamp, original in entries:
            yield http_fetch(address(stamp, original), timeout)

    return fetch


class _Entries(InputPartition):
    def __init__(self, entries: list[tuple[str, str]]):
        self.entries = entries


def read_manifest(path: str) -> list[tuple[str, str]]:
    """(stamp, address) in order, each once, of JSON lines with these fields in a file or the files of a folder."""
    files, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    found = files.get_file_info(at)
    names = [at] if found.type == fs.FileType.File else [f.path for f in files.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    entries = set()
    for name in names:
        with files.open_input_stream(name) as f:
            entries |= {(r["stamp"], r["original"]) for line in f.read().decode().splitlines() if line.strip() for r in [json.loads(line)]}
    return sorted(entries)


def _reads(fetch: Fetch, partition: _Entries) -> Iterator[tuple]:
    """A row for each entry: an error becomes its row, and the fetch starts again behind it."""
    left = list(partition.entries)
    while left:
        answers = iter(fetch(list(left)))
        try:
            while left:
                status, body = next(answers)
                yield *left.pop(0), status, body, None
        except StopIteration:
            yield *left.pop(0), None, None, "no answer"
        except Exception as e:  # noqa: BLE001  told in the row
            yield *left.pop(0), None, None, f"{type(e).__name__}: {e}"


def snapshot_source(fetch: Fetch, manifest: str, per_batch: int = 1, per_task: int = 16) -> type[DataSource]:
    """A data source over a manifest, as a table or as a stream that takes per_batch entries at a time."""

    class Table(DataSourceReader):
        def partitions(self):
            entries = read_manifest(manifest)
            return [_Entries(entries[k : k + per_task]) for k in range(0, len(entries), per_task)] or [_Entries([])]

        def read(self, partition: _Entries) -> Iterator[tuple]:
            return _reads(fetch, partition)

    class Stream(DataSourceStreamReader):
        def __init__(self):
            self.at = ["", ""]

        def initialOffset(self) -> dict:
            return {"stamp": "", "original": ""}

        def _reached(self, offset: dict) -> None:
            self.at = max(self.at, [offset["stamp"], offset["original"]])

        def latestOffset(self) -> dict:
            """The end of the next batch; the same as before when there is nothing new."""
            following = [e for e in read_manifest(manifest) if list(e) > self.at][:per_batch]
            if following:
                self.at = list(following[-1])
            return dict(zip(("stamp", "original"), self.at))

        def partitions(self, start: dict, end: dict):
            # After a restart, the first call tells what was planned or done before.
            self._reached(end)
            low, high = (tuple(o[k] for k in ("stamp", "original")) for o in (start, end))
            entries = [e for e in read_manifest(manifest) if low < e <= high]
            return [_Entries(entries[k : k + per_task]) for k in range(0, len(entries), per_task)]

        def commit(self, end: dict) -> None:
            self._reached(end)

        def read(self, partition: _Entries) -> Iterator[tuple]:
            return _reads(fetch, partition)

    class Snapshots(DataSource):
        @classmethod
        def name(cls) -> str:
            return "snapshots"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Table()

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Stream()

    return Snapshots


def backfill(spark: SparkSession, fetch: Fetch, manifest: str, path: str, checkpoint: str, per_batch: int = 1, batches: int | None = None, per_task: int = 16, rows: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Add rows of the snapshots that checkpoint hasn't seen to the Parquet table at path, per_batch at a time; at most batches
    batches, all that are left if None. What was stopped goes on where it stopped: each snapshot is in the table once."""
    ship(spark)
    spark.dataSource.register(snapshot_source(fetch, manifest, per_batch, per_task))
    entries = len(read_manifest(manifest))
    for _ in range(-(-entries // per_batch) if batches is None else batches):
        stream = rows(spark.readStream.format("snapshots").load())
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if not query.recentProgress or query.recentProgress[-1]["numInputRows"] == 0:
            break


#: The link of an incident, and the fields of its text.
INCIDENT = r"incidentNumber=(AK\d+)"
CONTAINER = r"(?is)<(li|tr|td|section|div)\b(?:(?!</?(?:li|tr|td|section|div)\b).)*?incidentNumber=AK\d+(?:(?!</?(?:li|tr|td|section|div)\b).)*"


def snapshot_incidents(df: DataFrame, body: str = "body", stamp: str = "stamp", least: int = 500) -> DataFrame:
    """Incidents of archived pages: (hash, incident, location, type, text, posted, ts, officer, entities). ts is the time of
    posting, or the snapshot's day. Pages that failed or have under least characters, and texts under 20, give none."""
    good = df.filter((F.col("status") == 200) & (F.length(body) >= least))
    blocks = good.select(stamp, F.explode(F.regexp_extract_all(F.col(body), F.lit(CONTAINER), F.lit(0))).alias("block"))
    lines = F.regexp_replace("block", r"(?s)<[^>]+>", "\n")
    found = blocks.select(stamp, F.regexp_extract("block", INCIDENT, 1).alias("incident"), F.trim(F.regexp_replace(lines, r"\s*\n\s*", "\n")).alias("__t"))
    field = lambda p, default: F.coalesce(F.nullif(F.trim(F.regexp_extract("__t", p, 1)), F.lit("")), default)
    text = clean_text(field(r"(?i)Dispatch Text[:\s]+([\s\S]+?)(?:Posted on|$)", F.substring("__t", 1, 600)))
    posted = field(r"(?i)Posted on ([^\n]+)", F.lit(""))
    rows = found.select(
        F.md5(F.col("incident").cast("binary")).alias("hash"), "incident", field(r"(?i)Location[:\s]+([^\n]+)", F.lit("Alaska")).alias("location"), field(r"(?i)Type[:\s]+([^\n]+)", F.lit("Incident")).alias("type"),
        text.alias("text"), posted.alias("posted"), F.nullif(F.regexp_extract(posted, r"(?i)by\s+DPS\\+(.+?)$", 1), F.lit("")).alias("officer"), _day(F.col(stamp)).alias("__day"),
    )
    return rows.filter(F.length("text") >= 20).withColumns({"ts": F.coalesce(posted_time(F.col("posted")), "__day"), "entities": X.entities(F.col("text"))}).drop("__day")


def _day(stamp: Column) -> Column:
    return F.date_trunc("day", compact_time(stamp))
