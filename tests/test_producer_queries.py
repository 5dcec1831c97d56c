"""Queries of single producers against their SQL, and the operators that they don't reach."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from quillgrid.operators import merge, publish
from quillgrid.plans import catalog, producers

from .conftest import DATA

NAMES = [n for n, f in catalog.queries().items() if f.__module__ == producers.__name__] + ["merge_json_lines", "merge_every_json_line", "probation_fold"]


def rounded(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, name):
    folder = DATA / "sf0.001"
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    got = catalog.queries()[name](spark, str(folder))
    found = con.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted((repr(tuple(map(rounded, r))) for r in found.fetchall()))
    assert sorted(repr(tuple(rounded(r[c]) for c in names)) for r in got.collect()) == want and want


def test_first_line_of_a_key_is_the_first_in_its_file(spark):
    lines = lambda *rows: spark.createDataFrame(rows, "value string, position long")
    old = lines(('{"hash":"a","t":"z first"}', 1), ('{"hash":"a","t":"a second"}', 2), ("broken", 3), ('{"hash":""}', 4))
    new = lines(('{"hash":"a","t":"0"}', 0), ('{"hash":"b","t":"y"}', 9), ('{"hash":"b","t":"x"}', 10))
    assert sorted(r.value for r in merge.merge_lines(old, new).collect()) == sorted(['{"hash":"a","t":"z first"}', '{"hash":"b","t":"y"}', "broken"])


def test_prune_snapshots(spark, tmp_path):
    for day in ("2022-01-01", "2023-06-01", "latest"):
        publish.write_snapshot(spark.range(1), f"{tmp_path}/s", day)
    assert publish.prune_snapshots(spark, f"{tmp_path}/s", F.lit("2023-12-01").cast("timestamp")) == ["snapshot_date=2022-01-01"]
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["snapshot_date=2023-06-01", "snapshot_date=latest"]
    assert publish.prune_snapshots(spark, f"{tmp_path}/none", F.lit("2023-12-01").cast("timestamp")) == []
