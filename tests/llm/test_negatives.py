import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.llm import negatives as hn
from tests.conftest import DATA
from tests.llm.common import as_table

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, every=50, shift=True):
    kept = []
    for i, v, label in rows:
        if i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, (label + 1) % 10 if shift and i % 7 == 0 else label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    out = []
    for a, la, va in kept:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in kept if i != a), key=lambda r: r[:2])
        for ps, p, _ in [s for s in scored if s[2] == la][:5]:
            window = [s for s in scored if s[2] != la and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(window[:3])]
    return sorted(out)


def random_rows(n, size, seed, labels=10, hot=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (labels, size))
    label = np.where(rng.random(n) < hot, 0, rng.integers(0, labels, n))
    return [(i, [float(np.float32(x)) for x in centres[rng.integers(labels)] + rng.normal(0, 0.1, size)], int(label[i])) for i in range(n)]


def query(spark, rows, folder):
    return sorted(map(tuple, hn.op13_hard_negatives(spark, as_table(spark, spark.createDataFrame(rows, SCHEMA), folder, "embeddings")).collect()))


@pytest.mark.parametrize("size", [1, 7, 64])
def test_bounds_hold(size):
    rng = np.random.default_rng(size)
    rows, anchors = rng.integers(-90, 90, (400, size)), rng.integers(-90, 90, (30, size))
    rows[:, 0] = 5
    cells = hn.Cells(rows[:50], rows.min(0), rows.max(0))
    code = cells.of(rows)
    lower, upper = hn.bounds(cells.products(anchors), code)
    exact = rows @ anchors.T
    assert (lower <= exact).all() and (exact <= upper).all()


def test_first_keeps_the_best_over_parts():
    rng = np.random.default_rng(4)
    key, score, row = rng.integers(0, 9, 500), rng.integers(0, 30, 500), rng.permutation(500)
    first = hn.First(9, 4)
    for k in range(0, 500, 37):
        on = slice(k, k + 37)
        first.add(key[on], score[on], np.zeros(len(key[on]), np.int64), row[on])
    want = sorted((int(a), -int(b), int(c)) for a, b, c in zip(key, score, row))
    want = [w for k in range(9) for w in [x for x in want if x[0] == k][:4]]
    assert sorted(zip(first.held[0].tolist(), (-first.held[1]).tolist(), first.held[3].tolist())) == want


def test_most_rows_are_not_scored(monkeypatch):
    rng = np.random.default_rng(6)
    rows = np.floor(rng.normal(0, 32, (8000, 64))).astype(np.int64)
    cells, scored = hn.Cells(rows[:4000], rows.min(0), rows.max(0)), []
    group = hn.Group([(k, k, 0, rows[k].tolist(), [9000, 8000]) for k in range(20)], cells)
    kind = hn.Negatives(group, 3, hn.WINDOW)
    plain = group.scores
    group.scores = lambda r, row, anchor: scored.append(len(row)) or plain(r, row, anchor)
    code = cells.of(rows)
    for k in range(0, 8000, 1000):
        kind.take(np.arange(k, k + 1000), np.ones(1000, np.int64), rows[k : k + 1000], code[k : k + 1000])
    assert sum(scored) < 0.3 * 8000 * 20


@pytest.mark.parametrize(("n", "size"), [(300, 16), (700, 3)])
def test_query_against_brute_force(spark, tmp_path, n, size):
    rows = random_rows(n, size, n)
    want = slow(rows)
    assert query(spark, rows, tmp_path) == want and len(want) > 20


def test_many_grid_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "ROWS", 100)
    rows = random_rows(1000, 8, 9)
    assert query(spark, rows, tmp_path) == slow(rows)


def test_ties(spark, tmp_path):
    rows = [(i, [0.5, 0.25 * (1 + i % 3)], i % 4) for i in range(120)]
    want = slow(rows)
    assert query(spark, rows, tmp_path) == want and want


def test_awkward_rows(spark, tmp_path):
    rows = random_rows(200, 6, 3)
    bad = [(None, [1.0] * 6, 1), (250, None, 1), (300, [1.0] * 5 + [None], 1), (350, [float("nan")] * 6, 1), (400, [float("-inf")] + [1.0] * 5, 2), (450, [1.0] * 6, None)]
    odd = [(500, [], 1), (550, [1.0] * 5, 1), (600, [3e30] * 6, 1)]
    assert query(spark, rows + bad + odd, tmp_path) == slow(rows)


def test_far_components(spark):
    rows = [(0, [60000.0, 60000.0], 0), (1, [60000.0, 60000.0], 0), (2, [60000.0, 30000.0], 1), (3, [-60000.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in hn.hard_negatives(frame, F.col("vec_id") == 0).collect()] == slow(rows, every=100, shift=False)


def test_repeated_rows(spark):
    v = [1.0, 1.0]
    rows = [(0, v, 0), (0, v, 0), (3, [1.0, 0.9], 0), (4, [0.9, 0.9], 1), (4, [0.9, 0.9], 1)]
    got = sorted(map(tuple, hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()))
    assert [r[:4] for r in got] == [(0, 3, 1, 4), (0, 3, 1, 4), (0, 3, 2, 4), (0, 3, 2, 4)]


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(none, F.lit(True)).collect() == []
    rows = spark.createDataFrame(random_rows(60, 4, 1), SCHEMA)
    assert hn.hard_negatives(rows, F.lit(False)).collect() == []
    clash = rows.withColumn("vector", F.lit(1)).withColumn("rank", F.lit("x")).withColumn("key", F.lit(2)).withColumn("anchor", F.lit(9))
    both = [sorted(map(tuple, hn.hard_negatives(f, F.col("vec_id") % 10 == 0).collect())) for f in (rows, clash)]
    assert both[0] == both[1] and both[0]


def test_query_against_sql(spark):
    got = hn.op13_hard_negatives(spark, str(DATA / "sf0.1")).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{DATA}/sf0.1/embeddings.parquet'")
    want = con.sql(hn.ORACLE).select(*got[0].asDict()).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
