"""Sending rows to an ingest endpoint in batches, so that what runs again sends nothing twice.

Batches are made by the rows alone: dealt by a hash of the row, ordered, cut at a size. A batch's idempotency key is a hash of
its place and content, so a task, a job or the next run that comes to the same batch has the same key. A batch that the
endpoint has taken is noted in a ledger, a small file in a shared folder, and is not sent again; if a task dies between the
answer and the note, the batch goes out again under the same key, which tells the endpoint.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..session import ship

#: Rows of a batch.
SIZE = 50
#: (idempotency key, JSON text) to the status of the answer.
Send = Callable[[str, str], int]


def ingest_batches(df: DataFrame, size: int = SIZE, digits: int = 2) -> DataFrame:
    """(batch, rows, payload): rows of df as JSON arrays of size rows each, fewer at the end of each of 16 ** digits deals."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    deal = F.substring(F.md5(F.col("__j").cast("binary")), 1, digits)
    placed = df.select(row.alias("__j")).withColumn("__d", deal).withColumn("__n", F.row_number().over(Window.partitionBy("__d").orderBy("__j")) - 1)
    grouped = placed.groupBy("__d", F.floor(F.col("__n") / size).alias("__b")).agg(F.count("*").alias("rows"), F.array_sort(F.collect_list(F.struct("__n", "__j"))).alias("__r"))
    payload = F.concat(F.lit("["), F.array_join(F.transform("__r", lambda r: r["__j"]), ","), F.lit("]"))
    return grouped.withColumn("payload", payload).select(F.sha2(F.concat_ws("/", "__d", "__b", "payload"), 256).alias("batch"), "rows", "payload")


def http_post(url: str, headers: dict[str, str] | None = None, timeout: float = 30.0) -> Send:
    def send(key: str, payload: str) -> int:
        from urllib.request import Request, urlopen

        request = Request(url, payload.encode(), {"Content-Type": "application/json", "Idempotency-Key": key, **(headers or {})}, method="POST")
        with urlopen(request, timeout=timeout) as r:  # noqa: S310
            return r.status

    return send


@dataclass
class Sent(WriterCommitMessage):
    sent: int
    skipped: int
    rows: int


class Ledger:
    """Which batches were taken: an empty file for each, below path."""

    def __init__(self, path: str):
        self.path = path

    def _open(self):
        files, at = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        files.create_dir(at, recursive=True)
        return files, at

    def has(self, name: str) -> bool:
        files, at = self._open()
        return files.get_file_info(f"{at}/{name}").type == fs.FileType.File

    def note(self, name: str, text: str = "") -> None:
        files, at = self._open()
        with files.open_output_stream(f"{at}/{name}") as f:
            f.write(text.encode())


class IngestWriter(DataSourceWriter):
    def __init__(self, send: Send, ledger: str):
        self.send, self.ledger = send, Ledger(ledger)

    def write(self, rows: Iterator) -> Sent:
        out = Sent(0, 0, 0)
        for row in rows:
            if self.ledger.has(row.batch):
                out.skipped += 1
                continue
            status = self.send(row.batch, row.payload)
            if not 200 <= status < 300:
                raise RuntimeError(f"batch {row.batch}: status {status}")
            self.ledger.note(row.batch)
            out.sent, out.rows = out.sent + 1, out.rows + row.rows
        return out

    def _sum(self, messages: list) -> str:
        got = [m for m in messages if m is not None]
        return json.dumps({k: sum(getattr(m, k) for m in got) for k in ("sent", "skipped", "rows")})

    def commit(self, messages: list) -> None:
        self.ledger.note("_last", self._sum(messages))

    def abort(self, messages: list) -> None:
        """What was taken stays noted: the next run sends the rest."""
        self.ledger.note("_aborted", self._sum(messages))


def post_batches(df: DataFrame, send: Send, ledger: str, size: int = SIZE) -> None:
    """Send df's rows in batches. ledger is a folder that driver and executors share; it may serve many runs."""
    ship(df.sparkSession)

    class Ingest(DataSource):
        @classmethod
        def name(cls) -> str:
            return "ingest"

        def schema(self) -> str:
            return "batch string, rows long, payload string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return IngestWriter(send, ledger)

    df.sparkSession.dataSource.register(Ingest)
    ingest_batches(df, size).write.format("ingest").mode("append").save()
