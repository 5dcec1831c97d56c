import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from quillgrid.llm import simhash
from tests.llm.common import AWKWARD, as_table, docs_frame


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """{doc_id: least doc_id reachable} of distinct doc_ids, by all pairs."""
    fps = {i: slow_fingerprint(t) for i, t in rows}
    least = {i: i for i in fps}
    links = [(a, b) for a, b in combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return {i: (f"{fps[i]:016x}", least[i]) for i in fps}


def run(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_near_dedup(frame).collect()), key=str)


def test_fingerprint():
    texts = [*AWKWARD, "One", "one TWO", "one two Three", "a b c d", "É é É"]
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_pieces(monkeypatch):
    text = "some Words that\tgo on\n" * 500
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text.encode()) == whole == slow_fingerprint(text)


@pytest.mark.parametrize("spread", [4, 12, 40])
def test_forest(spread, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(spread)
    fps = np.unique(rng.integers(0, 1 << spread, 300, dtype=np.uint64))
    ordered, label = simhash.forest(fps)
    want = list(range(len(ordered)))
    changed = True
    while changed:
        changed = False
        for a, b in combinations(range(len(ordered)), 2):
            if (int(ordered[a]) ^ int(ordered[b])).bit_count() <= 2 and want[a] != want[b]:
                want[a] = want[b] = min(want[a], want[b])
                changed = True
    assert label.tolist() == want


def test_buckets_hold_every_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", 20)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [int(x) ^ (1 << int(i)) ^ (1 << int(j)) for x in base for i, j in rng.integers(0, 64, (6, 2))]
    dense = [int(base[0]) ^ k for k in range(64)]
    fps = sorted({*map(int, base), *near, *dense})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    groups = {}
    for r in simhash.buckets(spark.createDataFrame([(x,) for x in signed], "fp long")).collect():
        groups.setdefault((r.bucket, r.part), set()).add(r.fp % (1 << 64))
    assert any(p >= 0 for _, p in groups) and any(p < 0 for _, p in groups)
    together = {(a, b) for g in groups.values() for a, b in combinations(sorted(g), 2)}
    assert all((a, b) in together for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 2)


def test_awkward(spark):
    rows = list(enumerate([*AWKWARD, "one two three four", "one two three four", "One two\nthree four", None]))
    assert run(docs_frame(spark, rows)) == sorted(((i, *v) for i, v in slow_components(rows).items()), key=str)


def test_repeated_and_null_ids(spark):
    frame = docs_frame(spark, [(5, "a b c"), (5, "x y z"), (None, "x y z"), (None, "q r s"), (2, "a b c")])
    fp = {t: f"{slow_fingerprint(t):016x}" for t in ("a b c", "x y z", "q r s")}
    assert run(frame) == sorted([(5, fp["a b c"], 2), (2, fp["a b c"], 2), (5, fp["x y z"], 5), (None, fp["x y z"], 5), (None, fp["q r s"], None)], key=str)


def test_empty_and_clashing_columns(spark):
    assert run(docs_frame(spark, [])) == []
    frame = spark.createDataFrame([(1, "a b c", 7, 8), (2, "a b c", 9, 9)], "doc_id long, text string, fp long, component long")
    assert [r[2] for r in run(frame)] == [1, 1]


def test_query_against_all_pairs(spark, tmp_path):
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(60):
        text = [words[k] for k in rng.integers(0, 300, 120)]
        for copy in range(4):
            rows.append((len(rows), " ".join(text)))
            text = [*text]
            text[int(rng.integers(120))] = "changed"
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op11_simhash_near_dedup(spark, as_table(spark, docs_frame(spark, rows), tmp_path)).collect()}
    want = slow_components(rows)
    assert got == want
    assert any(v[1] != i for i, v in want.items())
