"""Tables replaced while they are read, carried values, batches against a history."""

import random

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import merge, ranking
from quillgrid.operators.store import Conflict, Store
from quillgrid.plans.engine import SignalEngine
from quillgrid.sources.signals import adapt

from .test_whole_tables import held_to_sql

SCHEMA = "hash string, ts timestamp, seq long, v string"


def rows(spark, *values):
    df = spark.createDataFrame(values, "hash string, t string, seq long, v string")
    return df.select("hash", F.col("t").cast("timestamp").alias("ts"), "seq", "v")


def content(df):
    return sorted((r.hash, r.ts and r.ts.strftime("%Y-%m"), r.v) for r in df.collect())


@pytest.mark.parametrize("name", ["archive_store", "rolling_store", "carried_headings", "new_against_history"])
def test_held_to_sql(spark, name):
    assert held_to_sql(spark, name)


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_months_are_merged_and_others_stay_the_same_files(spark, tmp_path, kind):
    store = Store(spark, str(tmp_path / "t"), kind)
    assert store.manifest() is None
    with pytest.raises(ValueError, match="no table"):
        store.read()
    first = rows(spark, ("a", "2024-01-05 00:00:00", 1, "a1"), ("b", "2024-01-09 00:00:00", 2, "b1"), ("a", "2024-02-01 00:00:00", 3, "a2"))
    assert store.upsert_months(first, ["hash"], seq="seq") == 1
    february = store.manifest()["parts"]["2024-02"]
    again = rows(spark, ("a", "2024-01-06 00:00:00", 9, "new"), ("a", "2024-01-07 00:00:00", 4, "older"), ("c", "2024-03-01 00:00:00", 5, "c"), (None, "2024-03-01 00:00:00", 6, "nameless"), ("d", None, 7, "timeless"))
    assert store.upsert_months(again, ["hash"], seq="seq") == 2
    assert content(store.read()) == [("a", "2024-01", "new"), ("a", "2024-02", "a2"), ("b", "2024-01", "b1"), ("c", "2024-03", "c")]
    assert store.manifest()["parts"]["2024-02"] == february
    assert content(store.read(parts=["2024-02"])) == [("a", "2024-02", "a2")]
    assert len(content(store.read(version=1))) == 3


def test_a_write_that_dies_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "t"))
    store.replace(rows(spark, ("a", "2024-01-05 00:00:00", 1, "old")))
    reading = store.read()
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            store.replace(store.read().withColumn("v", F.lit("half")))
    assert content(store.read()) == content(reading) == [("a", "2024-01", "old")]
    # A task that fails while it writes leaves no version either.
    with pytest.raises(Exception, match="broken"):
        store.replace(store.read().withColumn("v", F.raise_error(F.lit("broken")).cast("string")))
    assert store.versions() == [1]
    assert store.replace(store.read().withColumn("v", F.lit("whole"))) == 2
    assert content(store.read()) == [("a", "2024-01", "whole")] and content(reading) == [("a", "2024-01", "old")]
    assert len(store.vacuum(keep=1)) >= 2 and store.versions() == [2]
    assert content(store.read()) == [("a", "2024-01", "whole")]


def test_the_later_of_two_writers_is_told(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    df = rows(spark, ("a", "2024-01-05 00:00:00", 1, "x"))
    store.replace(df)
    before = store.manifest()
    store.replace(df.withColumn("v", F.lit("first")))
    with pytest.raises(Conflict):
        store.replace_parts(df.withColumn("m", F.lit("late")), "m", before)
    assert content(store.read()) == [("a", "2024-01", "first")]
    assert not [p for p in (tmp_path / "t" / "_manifest").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_empty_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    none = spark.createDataFrame([], SCHEMA)
    store.upsert_months(none, ["hash"])
    assert content(store.read()) == []
    store.replace(none)
    assert content(store.read()) == []


def test_engine_merges_by_arrival(spark):
    engine = SignalEngine("2024-01-30 00:00:00")
    frame = lambda *r: adapt(spark.createDataFrame([(h, f"https://x.org/{h}", t, ts, s) for h, t, ts, s in r], "hash string, link string, title string, timestamp string, seq long"))
    old = frame(("a", "archived", "2024-01-29T00:00:00Z", 99), ("b", "only old", "2024-01-01T00:00:00Z", 1))
    new = frame(("a", "first", "2024-01-28T00:00:00Z", 1), ("a", "second", "2024-01-02T00:00:00Z", 2))
    got = {r.hash: r.title for r in engine.merge(old, new).collect()}
    assert got == {"a": "second", "b": "only old"}


def test_engine_archives(spark, tmp_path):
    engine, store = SignalEngine("2024-01-30 00:00:00"), Store(spark, str(tmp_path / "t"))
    frame = adapt(spark.createDataFrame([("a", "https://x.org/a", "one", "2024-01-05T00:00:00Z"), ("b", "https://x.org/b", "two", "not a time")], "hash string, link string, title string, timestamp string"))
    engine.archive(store, frame)
    engine.archive(store, store.read().withColumn("title", F.lit("again")))
    assert [(r.hash, r.title) for r in store.read().collect()] == [("a", "again")]


@pytest.fixture
def many_ranges(spark):
    """Adaptive execution would make one range of a small table."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_fill_forward_is_the_loop(spark, groups, many_ranges):
    rng = random.Random(7)
    rows = [(rng.choice([None, "x", "y"]) if i > 300 else "hot", i, rng.choice([None, None, None, i]), rng.choice([None] * 40 + ["z"])) for i in range(600)]
    want, last = {}, {}
    for g, i, a, b in sorted(rows, key=lambda r: r[1]):
        key = g if groups else 0
        kept = last.get(key, (None, None))
        last[key] = (a if a is not None else kept[0], b if b is not None else kept[1])
        want[i] = last[key]
    df = spark.createDataFrame(rows, "g string, i long, a long, b string").repartition(7)
    filled = ranking.fill_forward(df, ["a", "b"], ["i"], groups)
    assert {r.i: (r.a, r.b) for r in filled.collect()} == want and filled.columns == df.columns


def test_no_rows_go_through_one_task(spark, many_ranges):
    df = spark.range(0, 20_000, numPartitions=8).withColumn("v", F.when(F.col("id") % 7_000 == 0, F.col("id")))
    filled = ranking.fill_forward(df, ["v"], ["id"])
    assert filled.filter("v <> floor(id / 7000) * 7000 OR v IS NULL").count() == 0
    sizes = [r["count"] for r in ranking._ranged(df, [F.col("id")]).groupBy("__p").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 15_000
    # Only the last values, one row for each range, go through one task.
    plan = filled._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    below = plan[plan.index("Exchange SinglePartition") :].splitlines()[1]
    assert len(single) == 1 and "Aggregate" in below and "max_by" in below


def test_pages_over_many_ranges(spark, many_ranges):
    df = spark.range(0, 5000, numPartitions=6).select((F.col("id") * 7919 % 5000).alias("id"))
    assert ranking.pages(df, [F.col("id")], 10).filter("page <> floor(id / 10) + 1").count() == 0


@pytest.mark.parametrize("words", [1, 64, 1 << 21])
def test_new_of_history(spark, words):
    rng = random.Random(3)
    batch = [(f"k{rng.randrange(400)}", i) for i in range(500)] + [(None, 1000), (None, 999)]
    history = [(f"k{rng.randrange(0, 4000)}",) for _ in range(3000)] + [(None,)]
    b, h = spark.createDataFrame(batch, "hash string, seq long"), spark.createDataFrame(history, "hash string")
    want = sorted((r.hash or "", r.seq) for r in merge.only_new(b, h, ["hash"]).collect())
    got = merge.only_new_of_history(b, h, ["hash"], most_words=words)
    assert sorted((r.hash or "", r.seq) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_few_keys_of_history_pass(spark):
    b = spark.range(1000).select(F.col("id").cast("string").alias("hash"), F.col("id").alias("seq"))
    h = spark.range(500, 200_500).select(F.col("id").cast("string").alias("hash"))
    got = merge.only_new_of_history(b, h, ["hash"])
    assert got.count() == 500
    accepted = got._jdf.queryExecution().optimizedPlan().toString()
    assert accepted.count("Join LeftAnti") == 1
    assert merge.only_new_of_history(spark.createDataFrame([], "hash string, seq long"), h, ["hash"]).count() == 0
