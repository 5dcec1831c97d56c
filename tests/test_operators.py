import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import aggregates, joins, linking, merge, publish, ranking
from quillgrid.streaming import flow, state


def miles(a, b):
    p1, p2, dl = math.radians(a[0]), math.radians(b[0]), math.radians(b[1] - a[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 3959.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cluster_is_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [(f"h{i}", i, rng.choice([None, 10, 20, 30, 90]), 61 + rng.random() * 0.06, -150 + rng.random() * 0.12, start + timedelta(minutes=rng.randint(0, 200))) for i in range(150)]
    rows += [("h3", 200, 100, 61.0, -150.0, start), (None, 201, 5, 61.0, -150.0, start), ("z", 202, 5, None, -150.0, start)]
    best = {}
    for r in sorted(rows, key=lambda r: (-(r[2] or 0), r[1])):
        if r[0] is not None:
            best.setdefault(r[0], r)
    want, leaders = {}, []
    for r in sorted(best.values(), key=lambda r: (-(r[2] or 0), r[1])):
        near = next((q for q in leaders if None not in (q[3], r[3]) and miles(q[3:5], r[3:5]) <= 1.5 and abs((q[5] - r[5]).total_seconds()) <= 2700), None)
        want[r[0]] = near[0] if near else r[0]
        if not near:
            leaders.append(r)
    df = spark.createDataFrame(rows, "hash string, seq int, impact int, lat double, lng double, ts timestamp")
    got = {r.hash: r.leader for r in linking.cluster(df).collect()}
    assert got == want
    folded = linking.fold_clusters(df.dropDuplicates(["hash"]), linking.cluster(df)).collect()
    assert sum(r.reports for r in folded) == len(want) and all((r.attribution is None) == (r.reports == 1) for r in folded)


@pytest.mark.parametrize("reach", [1.5, 400.0, 9000.0])
def test_near_pairs_at_the_seam_and_the_poles(spark, reach):
    rng = random.Random(4)
    rows = [(0, 52.0, 179.995), (1, 52.0, -179.995), (2, 89.99, 0.0), (3, 89.99, 180.0), (4, -89.99, 10.0), (5, -89.99, -120.0), (6, 52.0, 180.0), (7, 52.0, -180.0)]
    for lat, wide in [(52, 0.1), (0, 0.1), (-30, 0.1), (85, 0.5), (88.5, 3), (-89.5, 30), (89.9, 360)]:
        rows += [(len(rows) + i, min(90.0, max(-90.0, lat + rng.uniform(-0.05, 0.05))), (180 + rng.uniform(-wide, wide) + 180) % 360 - 180) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, lat double, lng double").withColumn("ts", F.timestamp_seconds(F.lit(0)))
    got = sorted((r.a, r.b) for r in linking.near_pairs(df, "k", "lat", "lng", "ts", reach, 60).collect())
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and miles(a[1:], b[1:]) <= reach)
    assert (0, 1) in want and got == want


def test_near_pairs_meet_as_places_before_they_are_spread_out(spark):
    n = 30_000  # 700 million near pairs: before, each was measured, in the tasks of few cells
    df = spark.range(n).select(F.col("id").alias("k"), (F.lit(61.0) + F.col("id") % 3 * 0.015).alias("lat"), F.lit(-150.0).alias("lng"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))
    places, most = 3, linking.CHUNK
    points = linking.near_points(df, "k", "lat", "lng", "ts", 1.5, 60)
    got = points.agg(F.count("*").alias("n"), F.max(F.greatest(F.size("ks"), F.size("oks"))).alias("most"), F.sum(F.size("ks").cast("long") * F.size("oks")).alias("pairs")).first()
    chunks = -(-n // places // most)
    near = 7 * (n // places) ** 2  # all but the first place and the third, which are 2.07 miles apart
    assert (got.n, got.most, got.pairs) == (7 * chunks**2, most, near)
    few = df.filter("k < 1700")
    a, b = few.alias("a"), few.alias("b")
    want = a.join(b, F.expr("a.k <> b.k AND abs(a.k % 3 - b.k % 3) <= 1")).select("a.k", "b.k")
    got = linking.near_pairs(few, "k", "lat", "lng", "ts", 1.5, 60)
    h = lambda d: d.toDF("a", "b").agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    assert h(got) == h(want)


def test_cluster_takes_the_first_leader_decided_late(spark):
    start = datetime(2024, 1, 1)
    rows = [(k, i, impact, 61 + i * 0.02, -150.0, start) for i, (k, impact) in enumerate([("p", 90), ("x", 50), ("a", 34), ("f", 5), ("l", 10)])]
    df = spark.createDataFrame(rows, "hash string, seq int, impact int, lat double, lng double, ts timestamp")
    assert {r.hash: r.leader for r in linking.cluster(df).collect()} == {"p": "p", "x": "p", "a": "a", "f": "a", "l": "l"}


@pytest.mark.parametrize("reach", [1.5, 300.0, 9000.0])
def test_cluster_at_the_seam_and_the_poles(spark, reach):
    rng = random.Random(int(reach))
    rows = []
    for lat, wide in [(52, 0.1), (0, 0.1), (85, 0.5), (89.9, 360), (-89.9, 360), (-30, 180)]:
        rows += [(f"h{len(rows) + i}", len(rows) + i, rng.choice([10, 20, 90]), min(90.0, max(-90.0, lat + rng.uniform(-0.05, 0.05))), (180 + rng.uniform(-wide, wide) + 180) % 360 - 180, datetime(2024, 1, 1)) for i in range(25)]
    want, leaders = {}, []
    for r in sorted(rows, key=lambda r: (-r[2], r[1])):
        near = next((q for q in leaders if miles(q[3:5], r[3:5]) <= reach), None)
        want[r[0]] = near[0] if near else r[0]
        if not near:
            leaders.append(r)
    df = spark.createDataFrame(rows, "hash string, seq int, impact int, lat double, lng double, ts timestamp")
    assert {r.hash: r.leader for r in linking.cluster(df, miles=reach).collect()} == want


def test_a_hot_cell_is_no_table_of_pairs(spark):
    n = 100_000
    df = spark.range(n).select(F.col("id").cast("string").alias("hash"), F.col("id").alias("seq"), (F.col("id") % 7).cast("int").alias("impact"), (F.lit(61.0) + F.col("id") % 10 * 0.001).alias("lat"), F.lit(-150.0).alias("lng"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 100).alias("ts"))
    got = linking.cluster(df).groupBy("leader").count().collect()
    assert [(r.leader, r["count"]) for r in got] == [("6", n)]


def test_cluster_writes_rows_and_no_pairs(spark):
    n, written = 600, []
    df = spark.range(n).select(F.col("id").cast("string").alias("hash"), F.col("id").alias("seq"), F.lit(1).alias("impact"), (F.lit(61.0) + F.col("id") % 25 * 0.0004).alias("lat"), (F.lit(-150.0) + F.col("id") % 24 * 0.0008).alias("lng"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 4).alias("ts"))

    def settle(frame, name="table"):
        out = linking.settled(frame, name)
        written.append(out.count())
        return out

    assert linking.cluster(df, settle=settle).count() == n
    assert max(written) <= n  # before, every row with all candidates near it
    row = spark.createDataFrame([(0.3, 0.4, 5_000_000)], "y double, x double, t long")
    assert linking.Cells(1.5, 2700).near(row).count() <= 8  # before, 27


def test_cluster_decides_rows_of_equal_place_and_time_once(spark):
    n, written = 400, []
    at = F.col("id") % 5
    lat = F.when(at == 4, F.lit(float("nan"))).otherwise(F.lit(61.0) + at * 0.02)
    df = spark.range(n).select(F.col("id").cast("string").alias("hash"), F.col("id").alias("seq"), (F.col("id") % 3).cast("int").alias("impact"), lat.alias("lat"), F.lit(-150.0).alias("lng"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))

    def settle(frame, name="table"):
        out = linking.settled(frame, name)
        written.append(out.count())
        return out

    got = {int(r.hash): int(r.leader) for r in linking.cluster(df, settle=settle).collect()}
    # In order of impact the rows 2, 5, 8, 11 lead or follow: the places are 1.38 miles apart, of which two lead, and no number leads alone.
    want, leaders = {}, []
    for i in sorted(range(n), key=lambda i: (-(i % 3), i)):
        want[i] = next((q for q in leaders if i % 5 != 4 and q % 5 != 4 and abs(i % 5 - q % 5) <= 1), i)
        if want[i] == i:
            leaders.append(i)
    assert got == want
    assert written[0] == n and max(written[1:]) <= 4  # before, all rows in the first round


def test_cluster_of_nothing(spark):
    df = spark.createDataFrame([], "hash string, seq int, impact int, lat double, lng double, ts timestamp")
    assert linking.cluster(df).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_related_is_the_nested_loop(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [(i, f"h{i}", start + timedelta(hours=rng.randint(0, 300)) if rng.random() > 0.1 else None, rng.choice(["a", "b", "", None]), rng.choice(["s", "t"]), rng.sample(["x", "y", "z", "w"], rng.choice([0, 0, 0, 1, 2]))) for i in range(160)]
    want = {}
    for i, h, t, r, s, e in rows:
        out = []
        for _, h2, t2, r2, s2, e2 in rows:
            near = t and t2 and abs((t - t2).total_seconds()) < 172_800
            if h2 != h and ((r and r == r2 and s == s2 and near) or set(e) & set(e2)):
                out.append(h2)
        want[i] = out[:5]
    df = spark.createDataFrame(rows, "seq int, hash string, ts timestamp, region string, sector string, e array<string>")
    for hot in (64, 0):
        assert {r.seq: r.related for r in linking.related(df, entities="e", hot=hot).collect()} == want


def test_related_in_a_burst(spark):
    start = datetime(2024, 1, 1)
    rng = random.Random(3)
    rows = [(i, f"h{i % 90}", start + timedelta(seconds=s)) for i, s in enumerate(rng.choice([0, 1, 7, 8, 9, 10, 11]) + rng.choice([0.0, 0.000001]) for _ in range(150))]
    want = {}
    for i, h, t in rows:
        out = [h2 for _, h2, t2 in rows if h2 != h and abs((t - t2).total_seconds()) < 8]
        want[i] = list(dict.fromkeys(out))[:5]
    df = spark.createDataFrame(rows, "seq int, hash string, ts timestamp").withColumns({"region": F.lit("r"), "sector": F.lit("s")})
    for hot in (64, 3):
        assert {r.seq: r.related for r in linking.related(df, seconds=8, hot=hot).collect()} == want


def test_related_makes_one_list_for_a_moment(spark, monkeypatch):
    seen, settled = {}, linking.settled
    monkeypatch.setattr(linking, "settled", lambda df, name="table": seen.setdefault(name, settled(df, name)))
    n = 4000
    df = spark.range(n).select(F.col("id").alias("seq"), F.concat(F.lit("h"), "id").alias("hash"), F.timestamp_seconds(F.col("id") % 40 * 5000).alias("ts"), F.lit("r").alias("region"), F.lit("s").alias("sector"))
    assert linking.related(df).filter("size(related) = 5").count() == n
    assert seen["reach"].count() == 40 and seen["heads"].count() == 240  # before, 13 cells for each row and as many pairs


def test_related_with_repeated_keys(spark):
    start = datetime(2024, 1, 1)
    keys = ["a"] * 8 + ["b"] * 7 + ["c", "d", "e", "f", "g"]
    rows = [(i, h, start, "r", "s", []) for i, h in enumerate(keys)] + [(100 + i, h, None, None, None, ["x"]) for i, h in enumerate(keys)]
    df = spark.createDataFrame(rows, "seq int, hash string, ts timestamp, region string, sector string, e array<string>")
    got = {r.seq: r.related for r in linking.related(df, entities="e").collect()}
    assert got == {r[0]: [k for k in "abcdefg" if k != r[1]][:5] for r in rows}


def test_merges(spark):
    a = spark.createDataFrame([("k1", 1, "a"), ("k1", 2, "b"), (None, 3, "c")], "hash string, seq int, v string")
    b = spark.createDataFrame([("k1", 1, "x"), ("k2", 2, "y")], "hash string, seq int, v string")
    assert {(r.hash, r.v) for r in merge.priority_merge([a, b], ["hash"]).collect()} == {("k1", "a"), ("k2", "y")}
    assert {(r.hash, r.v) for r in merge.priority_merge([a, b], ["hash"], last_wins=True).collect()} == {("k1", "x"), ("k2", "y")}
    once = merge.keep_first(b, ["hash"])
    assert sorted(map(tuple, merge.keep_first(once.unionByName(b), ["hash"]).collect())) == sorted(map(tuple, once.collect()))
    filled = merge.fill_defaults(a.drop("v"), {"v": "d", "seq": 9})
    assert {r.v for r in filled.collect()} == {"d"}


def test_pages_and_fill(spark):
    df = spark.range(0, 1005).withColumn("x", (F.col("id") * 7919) % 1005).repartition(7)
    got = {r.x: r.page for r in ranking.pages(df, [F.col("x")]).collect()}
    assert got == {i: i // 10 + 1 for i in range(1005)}
    rows = spark.createDataFrame([(1, "h"), (2, None), (3, "i"), (4, None)], "n int, h string")
    assert [r.h for r in ranking.fill_forward(rows, ["h"], ["n"]).orderBy("n").collect()] == ["h", "h", "i", "i"]


def test_nearest_and_contains(spark):
    rows = spark.createDataFrame([(1, "a", 10.0), (2, "a", 100.0), (3, "b", 10.0)], "id int, k string, v double")
    points = spark.createDataFrame([("a", 8.0, "p"), ("a", 12.0, "q"), ("a", 103.0, "r")], "k string, m double, name string")
    got = {r.id: r.name for r in joins.nearest(rows, points, ["k"], "v", "m", ["name"], 2.0).collect()}
    assert got == {1: "p", 2: None, 3: None}
    copies = spark.createDataFrame([("a", 9.0, f"c{i}") for i in range(40, 9, -1)], "k string, m double, name string").repartition(5)
    assert joins.nearest(rows, copies, ["k"], "v", "m", ["name"], 2.0).filter("id = 1").first().name == "c10"
    names = spark.createDataFrame([(1, "smith"), (2, "ab"), (3, ""), (4, None), (5, "zz")], "id int, n string")
    words = spark.createDataFrame([("goldsmith", 1, 10), ("smith", 2, 20), ("xaby", 3, 30)], "w string, o int, p int")
    assert {r.id: r.p for r in joins.contains_first(names, words, "n", "w", "o", "id", exact="n").collect()} == {1: 20, 2: 30, 3: None, 4: None, 5: None}


def slow_probation(checks):
    s = {"status": "probation", "ok": 0, "bad": 0, "run": 0, "added": None}
    for at, ok in checks:
        s["added"] = s["added"] or at
        if ok:
            s["ok"] += 1
            s["run"] = 0
        else:
            s["bad"] += 1
            s["run"] += 1
        if s["status"] == "probation":
            if (at - s["added"]).days >= 14 and s["ok"] >= 10 and s["bad"] / (s["ok"] + s["bad"]) <= 0.3:
                s["status"] = "approved"
            elif s["run"] >= 20:
                s["status"] = "failing"
        elif s["status"] == "approved":
            if s["run"] >= 30:
                s["status"] = "failing"
        elif s["run"] == 0 and s["ok"] >= 5:
            s["status"] = "probation"
    return s["status"], s["ok"], s["bad"], s["run"]


def checks(seed):
    rng = random.Random(seed)
    rows, start = [], datetime(2024, 1, 1)
    for feed in range(12):
        p, n = rng.choice([0.02, 0.2, 0.5]), 0
        for k in range(120):
            down = 40 <= k < 80 and feed % 3 == 0
            rows.append((f"f{feed}", not down and rng.random() > p, start + timedelta(hours=6 * k), n))
            n += 1
    rng.shuffle(rows)
    return rows


def test_probation_batch_and_stream(spark, tmp_path):
    rows = checks(1)
    want = {f"f{i}": slow_probation([(at, ok) for f, ok, at, _ in sorted(rows, key=lambda r: r[2]) if f == f"f{i}"]) for i in range(12)}
    df = spark.createDataFrame(rows, "feed string, ok boolean, at timestamp, seq int")
    tell = lambda rs: {r.feed: (r.status, r.success_count, r.failure_count, r.consecutive_failures) for r in rs}
    assert tell(state.probation(df).collect()) == want
    assert {v[0] for v in want.values()} >= {"approved", "failing"} or len({v[0] for v in want.values()}) > 1
    ordered = sorted(rows, key=lambda r: r[2])
    for k in range(3):
        spark.createDataFrame(ordered[k * 480 : (k + 1) * 480], df.schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    out = {}

    def keep(batch, epoch):
        out.update(tell(batch.collect()))

    q = state.probation_stream(stream).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").foreachBatch(keep).trigger(availableNow=True).start()
    q.awaitTermination()
    assert out == want


def test_stream_dedup_and_upsert(spark, tmp_path):
    t = datetime(2024, 1, 1)
    schema = "hash string, seq int, ts timestamp, v string"
    for k, rows in enumerate([[("a", 1, t, "x"), ("b", 2, t, "y"), ("a", 3, t, "z")], [("a", 4, t, "w"), ("c", 5, t, "v")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = flow.fresh(read()).writeStream.format("memory").queryName("fresh").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.hash for r in spark.table("fresh").collect()) == ["a", "b", "c"]
    q = read().writeStream.foreachBatch(flow.upsert_batches(f"{tmp_path}/out")).option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.hash, r.v) for r in flow.current(spark, f"{tmp_path}/out").collect()} == {("a", "w"), ("b", "y"), ("c", "v")}
    q = flow.counts(read(), "hash").writeStream.format("memory").outputMode("complete").queryName("n").option("checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r.n for r in spark.table("n").collect()) == 5


def test_publishing(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-02 00:00:00", "a", 1), ("2024-02-02 00:00:00", "b", 2)], "t string, v string, n int").withColumn("ts", F.col("t").cast("timestamp"))
    publish.write_archive(df, f"{tmp_path}/a")
    publish.write_archive(df.filter("n = 2").withColumn("v", F.lit("c")), f"{tmp_path}/a")
    assert {(r.v, r.month) for r in spark.read.json(f"{tmp_path}/a").collect()} == {("a", 1), ("c", 2)} or {(r.v, str(r.month)) for r in spark.read.json(f"{tmp_path}/a").collect()} == {("a", "01"), ("c", "02")}
    assert publish.write_snapshot(df, f"{tmp_path}/s", "2024-01-01") and not publish.write_snapshot(df, f"{tmp_path}/s", "2024-01-01")
    assert '"count":2' in publish.snapshot(df.select("v", "n"), {"kind": "x"}, [F.col("v")]).first().value
    rss = publish.rss(spark.createDataFrame([("a<b", "http://x", None)], "title string, link string, description string"), "t", "http://y", [F.col("link")]).first().value
    assert "<title>a&lt;b</title>" in rss
    publish.jsonl_files(df, f"{tmp_path}/j", "v")
    assert spark.read.json(f"{tmp_path}/j").count() == 2


def test_summaries_of_actions_airports_and_values(spark):
    rows = spark.createDataFrame([("floor", "HB 1"), ("floor", "HB 1"), (None, ""), ("passage", None)], "type string, bill string")
    got = {tuple(r) for r in aggregates.action_summary(rows).collect()}
    assert got == {("total", None, 4), ("type", "floor", 2), ("type", None, 1), ("type", "passage", 1), ("bill", "HB 1", 2)}
    assert {tuple(r) for r in aggregates.histogram(rows, "type").collect()} == {("floor", 2), (None, 1), ("passage", 1)}
    airports = spark.createDataFrame([("delayed",), ("normal",), (None,)], "status string")
    assert tuple(aggregates.delayed(airports).first()) == (3, 1)
    assert tuple(aggregates.delayed(airports.limit(0)).first()) == (0, 0)
    assert aggregates.histogram(rows.limit(0), "type").count() == 0
