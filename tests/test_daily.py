"""Daily files."""

from datetime import date

from pyspark.sql import functions as F

from quillgrid.sources import daily

from .test_whole_tables import held_to_sql


def test_held_to_sql(spark):
    assert held_to_sql(spark, "daily_files")


def test_only_wanted_days_are_opened(spark, tmp_path):
    rows = [(k, f"v{k}é", date(2023, 12, 20 + k % 12)) for k in range(60)] + [(99, "no day", None)]
    df = spark.createDataFrame(rows, "id int, v string, day date")
    daily.write_daily(df, str(tmp_path), "day", "id", ["id", "v"])
    assert len(list(tmp_path.rglob("2023/12/*.json"))) == 12 and not list(tmp_path.rglob("*.tmp"))
    for name in ("2023/12/2023-12-20.json", "2023/12/2023-12-31.json"):
        (tmp_path / name).write_text("[broken")
    (tmp_path / "2023/12/notes.json").write_text("[1]")
    (tmp_path / "2023/12/2023-12-99.json").write_text("[1]")
    read = daily.read_daily(spark, str(tmp_path))
    some = read.filter((F.col("day") > "2023-12-20") & (F.col("day") <= "2023-12-23") & (F.col("position") >= 1))
    # A task opens a file: three of fourteen.
    assert some.rdd.getNumPartitions() == 3
    assert sorted((r.day, r.position) for r in some.collect()) == [(date(2023, 12, d), p) for d in (21, 22, 23) for p in range(1, 5)]
    assert read.filter(F.col("day").isin(date(2023, 12, 25), date(2020, 1, 1))).count() == 5
    broken = read.filter("error IS NOT NULL").collect()
    assert sorted(r.day.day for r in broken) == [20, 31]
    assert read.filter("day = DATE '2000-01-01'").count() == 0 and daily.read_daily(spark, str(tmp_path / "none")).count() == 0
    assert read.filter("day = DATE '2023-12-24'").orderBy("position").first().item == '{"id":4,"v":"v4é"}'


def test_a_day_is_replaced_and_others_stay(spark, tmp_path):
    one = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, day date")
    daily.write_daily(one, str(tmp_path), "day", "id", ["id"])
    daily.write_daily(one.filter("id = 2").withColumn("id", F.lit(7)), str(tmp_path), "day", "id", ["id"])
    assert sorted(r.item for r in daily.read_daily(spark, str(tmp_path)).collect()) == ['{"id":1}', '{"id":7}']
