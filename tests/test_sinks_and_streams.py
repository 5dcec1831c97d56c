"""Batches for an endpoint, and a backfill that is stopped and goes on."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quillgrid.operators import ingest
from quillgrid.sources import snapshots

from .test_whole_tables import held_to_sql


@pytest.mark.parametrize("name", ["ingest_payloads", "backfilled_snapshots"])
def test_held_to_sql(spark, name):
    assert held_to_sql(spark, name)


@pytest.fixture
def endpoint():
    """Records what it gets; answers 500 to each request while down(number of the request) is true."""
    got, down = [], [lambda n: False]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            n = len(got)
            bad = down[0](n)
            got.append((self.headers["Idempotency-Key"], json.loads(body), not bad))
            self.send_response(500 if bad else 201)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/", got, down
    server.shutdown()


def taken(got):
    return [r["id"] for _, rows, ok in got if ok for r in rows]


def test_every_row_is_sent_once_though_the_endpoint_fails(spark, endpoint, tmp_path):
    url, got, down = endpoint
    df = spark.range(0, 700, numPartitions=5).withColumn("t", F.lit('q"é\n'))
    down[0] = lambda n: n == 6
    with pytest.raises(Exception, match="500"):
        ingest.post_batches(df, ingest.http_post(url), str(tmp_path / "ledger"), 20)
    assert 0 < len(taken(got)) < 700 and (tmp_path / "ledger" / "_aborted").exists()
    down[0] = lambda n: False
    # The same rows in another order and other partitions come to the same batches.
    again = df.orderBy(F.desc("id")).repartition(3)
    ingest.post_batches(again, ingest.http_post(url), str(tmp_path / "ledger"), 20)
    assert sorted(taken(got)) == list(range(700))
    assert all(len(rows) <= 20 and rows[0]["t"] == 'q"é\n' for _, rows, _ in got)
    n = len(got)
    ingest.post_batches(df, ingest.http_post(url), str(tmp_path / "ledger"), 20)
    assert len(got) == n and json.loads((tmp_path / "ledger" / "_last").read_text())["sent"] == 0


def test_a_task_that_runs_again_sends_nothing_twice(tmp_path):
    sent, fail = [], [False]

    def send(key, payload):
        sent.append(key)
        return 200

    rows = [Row(batch=f"b{k}", rows=2, payload="[]") for k in range(4)]
    writer = ingest.IngestWriter(send, f"file://{tmp_path}/ledger")
    note = writer.ledger.note

    def dies(name, text=""):
        if name == "b2" and not fail[0]:
            fail[0] = True
            raise OSError("executor lost")
        note(name, text)

    writer.ledger.note = dies
    with pytest.raises(OSError, match="lost"):
        writer.write(iter(rows))
    message = writer.write(iter(rows))
    # b2 was taken and not noted: it goes out again under the same key, nothing else does.
    assert sent == ["b0", "b1", "b2", "b2", "b3"] and (message.sent, message.skipped, message.rows) == (2, 2, 4)


def test_batches_of_copies_and_of_nothing(spark, tmp_path):
    same = spark.range(130).select(F.lit("x").alias("v"), F.lit(None).cast("string").alias("n"))
    rows = ingest.ingest_batches(same).collect()
    assert sorted(r.rows for r in rows) == [30, 50, 50] and len({r.batch for r in rows}) == 3
    assert ingest.ingest_batches(spark.createDataFrame([], "v string")).count() == 0
    ingest.post_batches(spark.createDataFrame([], "v string"), lambda k, p: 200, str(tmp_path / "ledger"))


def fetch_pages(entries):
    for stamp, original in entries:
        if original == "/bad":
            raise OSError("gone")
        yield 200, f"{stamp}{original}"


def manifest(path, entries):
    path.write_text("".join(json.dumps({"stamp": s, "original": o}) + "\n" for s, o in entries))
    return str(path)


def test_backfill_stops_and_goes_on(spark, tmp_path):
    entries = [(f"2020010{k}", o) for k in range(1, 6) for o in ("/a", "/b")] + [("20200103", "/bad")]
    at = manifest(tmp_path / "manifest", entries)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda batches, per_batch=2: snapshots.backfill(spark, fetch_pages, at, out, mark, per_batch, batches)
    read = lambda: [tuple(r) for r in spark.read.parquet(out).orderBy("stamp", "original").collect()]
    run(2)
    assert [r[:2] for r in read()] == sorted(entries)[:4]
    run(1, per_batch=3)
    assert [r[:2] for r in read()] == sorted(entries)[:7]
    run(None)
    done = read()
    assert [r[:2] for r in done] == sorted(entries)
    assert [r[4] for r in done if r[4]] == ["OSError: gone"] and done[0][2:4] == (200, "20200101/a")
    run(None)
    assert read() == done
    # Later snapshots are read when the manifest has them.
    manifest(tmp_path / "manifest", [*entries, ("20200201", "/late")])
    run(None)
    assert [r[:2] for r in read()] == [*sorted(entries), ("20200201", "/late")]


def test_backfill_reads_a_batch_again_that_was_planned_only(spark, tmp_path):
    entries = [(f"2020010{k}", "/a") for k in range(1, 5)]
    at = manifest(tmp_path / "manifest", entries)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def broken(entries):
        raise SystemExit("worker dies")

    snapshots.backfill(spark, fetch_pages, at, out, mark, 1, 1)
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of a dead worker
        snapshots.backfill(spark, broken, at, out, mark, 1, 1)
    snapshots.backfill(spark, fetch_pages, at, out, mark, 1)
    assert [tuple(r)[:2] for r in spark.read.parquet(out).orderBy("stamp").collect()] == entries


def test_the_manifest_as_a_table(spark, tmp_path):
    at = manifest(tmp_path / "manifest", [("20200101", f"/{k}") for k in range(40)])
    spark.dataSource.register(snapshots.snapshot_source(fetch_pages, at))
    df = spark.read.format("snapshots").load()
    assert df.count() == 40 and df.rdd.getNumPartitions() == 3
    empty = manifest(tmp_path / "none", [])
    spark.dataSource.register(snapshots.snapshot_source(fetch_pages, empty))
    assert spark.read.format("snapshots").load().count() == 0


def test_incidents_of_a_snapshot(spark):
    pad = "x" * 500
    page = f"""<ul><li><a href="/DisplayIncident?incidentNumber=AK24000001">1</a><p>Location: Kenai</p>Type: Assault<br>Dispatch Text: On a date a man of 44 was
    arrested.<br>Posted on 1/2/2024 3:04:05 PM by DPS\\someone</li><li><a href="?incidentNumber=AK24000002">2</a> Dispatch Text: short</li>
    <li>no link</li><li><a href="?incidentNumber=AK24000003">3</a>A plain text that is long enough for a row</li></ul>{pad}"""
    df = spark.createDataFrame([("20230506120000", 200, page), ("20230506", 404, page), ("20230506", 200, "short"), ("20230506", 200, None)], "stamp string, status int, body string")
    rows = {r.incident: r for r in snapshots.snapshot_incidents(df).collect()}
    assert sorted(rows) == ["AK24000001", "AK24000003"]
    one, three = rows["AK24000001"], rows["AK24000003"]
    assert (one.location, one.type, one.officer, str(one.ts)) == ("Kenai", "Assault", "someone", "2024-01-02 15:04:05") and "was arrested" in one.text
    assert (three.location, three.type, three.officer, str(three.ts)) == ("Alaska", "Incident", None, "2023-05-06 00:00:00")
