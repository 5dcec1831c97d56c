"""Tables in files that may be replaced while they are read.

Every write goes to a new folder. A version of a table is a manifest, a small JSON file that names the folders of its parts,
and the manifest with the highest number is the table: it is written under another name and renamed, last of all. So readers
see a whole version, a job may read the table that it replaces, and a job that dies before the rename changes nothing.
Two writers that start from one version can't both rename to the next one: the later one gets a Conflict and may start anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import files
from .merge import priority_merge


class Conflict(RuntimeError):
    """Another writer was first."""


class Store:
    """A table below path, in a Spark format that needs no schema of its own or takes the one that the manifest keeps."""

    def __init__(self, spark: SparkSession, path: str, kind: str = "parquet"):
        self.spark, self.path, self.kind = spark, path.rstrip("/"), kind

    def versions(self) -> list[int]:
        fs, at = files(self.spark, f"{self.path}/_manifest")
        if not fs.exists(at):
            return []
        return sorted(int(name[:-5]) for s in fs.listStatus(at) if (name := s.getPath().getName()).endswith(".json") and name[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """{version, schema, parts: {name: folder}}; None where there is no table yet."""
        version = max(self.versions(), default=None) if version is None else version
        if version is None:
            return None
        rows = self.spark.read.text(f"{self.path}/_manifest/{version:012d}.json", wholetext=True).collect()
        return json.loads(rows[0][0])

    def read(self, schema: StructType | str | None = None, parts: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """The table, or only some of its parts: other folders aren't opened. schema is that of a table not yet written."""
        found = self.manifest(version)
        folders = [f"{self.path}/{folder}" for name, folder in (found or {"parts": {}})["parts"].items() if parts is None or name in parts]
        if found:
            schema = StructType.fromJson(found["schema"])
        elif schema is None:
            raise ValueError(f"no table at {self.path}, and no schema for an empty one")
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.kind).schema(schema).load(folders)

    def replace(self, df: DataFrame) -> int:
        """df as the whole table; df may read this table. The new version."""
        before, folder = self.manifest(), f"data/{uuid.uuid4().hex}"
        df.write.format(self.kind).save(f"{self.path}/{folder}")
        return self._commit(before, df.schema, {"": folder})

    def replace_parts(self, df: DataFrame, name: str, before: dict | None) -> int:
        """The parts that df has rows of, by column name, replaced in the version before; all others stay the same files."""
        folder = f"data/{uuid.uuid4().hex}"
        df.filter(F.col(name).isNotNull()).write.format(self.kind).partitionBy(name).save(f"{self.path}/{folder}")
        fs, at = files(self.spark, f"{self.path}/{folder}")
        written = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
        parts = {w.partition("=")[2]: f"{folder}/{w}" for w in written if w.startswith(f"{name}=")}
        kept = before["parts"] if before else {}
        return self._commit(before, df.drop(name).schema, kept | parts)

    def upsert_months(self, new: DataFrame, keys: Sequence[str], ts: str = "ts", seq: str | None = None) -> int:
        """Bring new into the months (yyyy-MM) of ts: of each key in a month the last row stays, new ones after those held,
        then by seq. Only months that new has are read and written. Rows without time or key have no place. The new version.
        """
        before, month = self.manifest(), F.date_format(ts, "yyyy-MM")
        months = [r[0] for r in new.select(month).distinct().collect() if r[0]]  # bounded by the calendar
        held = self.read(new.schema, months, before and before["version"])
        order = seq or "__none"
        frames = [f.withColumns({"__month": month} | ({} if seq else {order: F.lit(0)})) for f in (held, new)]
        merged = priority_merge(frames, ["__month", *keys], order, last_wins=True)
        return self.replace_parts(merged if seq else merged.drop(order), "__month", before)

    def _commit(self, before: dict | None, schema: StructType, parts: dict[str, str]) -> int:
        version = (before["version"] if before else 0) + 1
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, staged = files(self.spark, f"{self.path}/_manifest/.{uuid.uuid4().hex}")
        out = fs.create(staged, False)
        out.write(json.dumps({"version": version, "schema": schema.jsonValue(), "parts": parts}).encode())
        out.close()
        _, target = files(self.spark, f"{self.path}/_manifest/{version:012d}.json")
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, none)
        except Exception as e:
            fs.delete(staged, False)
            if fs.exists(target):
                raise Conflict(f"version {version} of {self.path} is there already") from e
            raise
        return version

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the folders and manifests that the last keep versions don't name; the folders' names. Not while a writer
        is at work: its folder has no manifest yet."""
        versions = self.versions()
        used = {f.split("/")[1] for v in versions[-keep:] for f in self.manifest(v)["parts"].values()}
        fs, at = files(self.spark, f"{self.path}/data")
        gone = sorted(name for s in (fs.listStatus(at) if fs.exists(at) else []) if (name := s.getPath().getName()) not in used)
        for path in [f"{self.path}/data/{g}" for g in gone] + [f"{self.path}/_manifest/{v:012d}.json" for v in versions[:-keep]]:
            fs.delete(files(self.spark, path)[1], True)
        return gone
