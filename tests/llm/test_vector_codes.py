import hashlib

import duckdb
import numpy as np
import pytest

from quillgrid.llm import vector_codes as vc
from tests.conftest import DATA

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, scale=1024, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error, digest) by full comparison in Python integers; rows of one size."""
    kept = [(i, [int(np.floor(scale * np.float64(np.float32(x)))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]

    def assign(v):
        out = []
        for p, q in enumerate(cut(v)):
            d = [sum((a - b) ** 2 for a, b in zip(q, e)) for e in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = [assign(v) for _, v, _ in kept]
        after = []
        for p in range(parts):
            new = []
            for e, entry in enumerate(books[p]):
                members = [cut(v)[p] for (_, v, _), g in zip(kept, got) if g[p][0] == e]
                new.append([sum(c) // len(members) for c in zip(*members)] if members else entry)
            after.append(new)
        books = after
    got = [assign(v) for _, v, _ in kept]
    errors = [sum(d for _, d in g) for g in got]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c, _ in g), e, by_label[label], sha) for (i, _, label), g, e in zip(kept, got, errors)), key=str)


def run(spark, rows, **options):
    return sorted((tuple(r) for r in vc.vector_codes(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=str)


def random_rows(n, size, seed, near=None):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 0.1, (near or n, size))
    return [(i, [float(np.float32(x)) for x in base[i % len(base)] + (rng.normal(0, 0.01, size) if near else 0)], [None, 0, 1][i % 3]) for i in range(n)]


@pytest.mark.parametrize("n", [1, 5, 256, 300])
def test_bounds_hold_and_nearest_is_first(n):
    rng = np.random.default_rng(n)
    entries, queries = rng.integers(-9, 9, (n, 6)), rng.integers(-12, 12, (500, 6))
    book = vc.Codebook(entries)
    distance = ((queries[None] - entries[:, None]) ** 2).sum(2)
    lower, upper = book.bounds(queries)
    assert (lower <= distance).all() and (distance <= upper).all()
    code, least = book.nearest(queries)
    assert (code == distance.argmin(0)).all() and (least == distance.min(0)).all()


def test_far_components():
    entries = np.array([[1 << 24, -(1 << 24)], [0, 0]], np.int64)
    code, least = vc.Codebook(entries).nearest(np.array([[-(1 << 24), 1 << 24]], np.int64))
    assert code.tolist() == [1] and least.tolist() == [2 << 48]


def test_few_entries_left_by_filtering():
    rows = random_rows(400, 64, 1, near=60)
    parts = np.floor(np.array([r[1] for r in rows]) * 1024).astype(np.int64)[:, :16]
    lower, upper = vc.Codebook(parts[:256]).bounds(parts)
    assert (lower <= upper.min(0)).mean() < 0.25


@pytest.mark.parametrize("near", [None, 12])
def test_against_full_comparison(spark, near):
    rows = random_rows(90, 8, 5, near)
    assert run(spark, rows, entries=16) == slow(rows, entries=16)


def test_ties_and_fewer_rows_than_entries(spark):
    rows = [(i, [0.5, 0.5, 0.0, 0.0, -0.001, 0.0, 1.0, 0.25], 1) for i in range(5)] + [(9, [0.0] * 8, None)]
    assert run(spark, rows) == slow(rows)


def test_dropped_and_odd_rows(spark):
    good = random_rows(20, 8, 2)
    bad = [(100, None, 1), (101, [1.0, None] * 4, 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] + [0.0] * 7, 0)]
    odd = [(104, [], 7), (105, [1.0] * 4, 0), (106, [1.0] * 7, 0), (107, [3e38] * 8, 0)]
    got = {r[0]: r[1:] for r in run(spark, good + bad + odd, entries=8)}
    want = {r[0]: r[1:] for r in slow(good, entries=8)}
    assert {k: v for k, v in got.items() if k < 100} == want
    assert sorted(k for k in got if k >= 100) == [104, 105, 106, 107]
    assert all(got[k][:2] == (None, None) for k in (104, 105, 106, 107)) and got[104][2] is None


def test_repeated_and_null_ids_and_no_rows(spark):
    v = [float(np.float32(x)) for x in (0.1, 0.2, 0.3, 0.4)]
    assert [r[0] for r in run(spark, [(1, v, 0), (1, v, 0), (None, v, 0)])] == [1, 1, None]
    assert run(spark, []) == []
    assert run(spark, [(1, None, 0), (2, [], 0)])[0][:4] == (2, None, None, None)


def test_clashing_columns_and_no_label(spark):
    frame = spark.createDataFrame([(1, [0.5] * 4, "x", 2.0)], "vec_id string, embedding array<double>, code string, error double")
    row = vc.vector_codes(frame, label=None).first()
    assert (row.vec_id, row.code, row.error, row.label_error) == ("1", "00000000", 0, 0)


def test_query_against_sql(spark):
    got = vc.op12_vector_codes(spark, str(DATA / "sf0.001")).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{DATA}/sf0.001/embeddings.parquet'")
    want = con.sql(vc.ORACLES["op12_vector_codes"])
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in want.select(*got[0].asDict()).fetchall())
