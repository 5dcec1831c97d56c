import random

import numpy as np
import pytest

from quillgrid.llm import ngram_join as nj
from quillgrid.llm.components import components
from quillgrid.llm.ngram_join import least_matches, ngram_join, shingle_sets, signature, stage_near_duplicates

from .common import AWKWARD, docs_frame


def brute_sets(text):
    words = (text or "").lower().encode().split()
    words = [w for w in (text or "").lower().replace("\x0b", " ").replace("\x0c", " ").translate({9: 32, 10: 32, 13: 32}).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute(rows):
    sets = [brute_sets(t) for _, t in rows]
    n = len(rows)
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            a, b = sets[i], sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[root(j)] = root(i)
    least = {}
    for i in range(n):
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], least[root(i)], links[i]) for i in range(n))


def corpus(seed, groups, size, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 200))]
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((n, " ".join(words)))
            n += 1
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = corpus(1, 25, 12, 6)
    rows += [(1000 + i, t) for i, t in enumerate(AWKWARD)] + [(2000, "a"), (2001, "a"), (2002, "A b"), (2003, "a  b\n")]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join(docs_frame(spark, rows).selectExpr("*", "1 AS class_id", "2 AS component")).collect())
    assert got == brute(rows)


def test_large_component_is_dealt_in_blocks(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join(docs_frame(spark, rows)).collect())
    assert got == brute(rows)


def test_repeated_rows_in_a_class(spark):
    rows = corpus(5, 3, 4, 3)
    rows += rows[:5]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join(docs_frame(spark, rows)).collect())
    assert got == brute(rows)


def test_one_id_with_several_texts(spark):
    rows = [(i % 7 if i % 3 else i, t) for i, t in corpus(6, 8, 6, 4)]
    rows += [rows[0], rows[0], rows[1], (3, None), (3, ""), (3, "one two")]
    frame = docs_frame(spark, rows)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join(frame.selectExpr("*", "1 AS th", "2 AS first", "'x' AS node")).collect())
    assert got == brute(rows)
    # A class keeps one text: the least id and, of that id's texts in it, one.
    kept = [(r.doc_id, r.text) for r in stage_near_duplicates(spark, frame, "").collect()]
    assert len(set(kept)) == len(kept) and set(kept) <= set(rows)
    sets = {t: brute_sets(t) for _, t in rows}
    texts = [t for _, t in kept if sets[t]]
    alike = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    assert not any(alike(sets[a], sets[b]) for i, a in enumerate(texts) for b in texts[:i])
    assert {(3, None), (3, "")} <= set(kept)
    by: dict = {}
    for doc, text in sorted(set((i, t) for i, t in rows if sets[t])):
        near = {root for root in by if any(alike(sets[text], sets[t]) for _, t in by[root])}
        by[(doc, text)] = [(doc, text)] + [x for root in near for x in by.pop(root)]
    assert len(texts) == len(by)
    assert sorted(i for i, t in kept if sets[t]) == sorted(min(i for i, _ in group) for group in by.values())


def test_a_chain_costs_as_much_as_its_links(spark):
    rng = random.Random(7)
    sent = {}
    for n in (500, 2000):
        words = [f"w{rng.randrange(10**9)}" for _ in range(100 + 5 * n)]
        rows = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(n)]
        got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join(docs_frame(spark, rows)).collect())
        assert got == [(i, 0, min(i, 2) + min(n - 1 - i, 2)) for i in range(n)]
        sets = docs_frame(spark, rows).selectExpr("doc_id", "xxhash64(text) AS th", "text").mapInArrow(nj._hash_documents, nj.HASHED)
        sent[n] = nj.meetings(sets.withColumnRenamed("doc_id", "node")).selectExpr("sum(size(pairs)) AS n").first().n
    assert sent[2000] < 5 * sent[500] and sent[2000] < 40 * 2000


def test_null_ids_repeats_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (6, None), (6, None)]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join(docs_frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, None, 0), (5, 5, 1), (5, 5, 1), (6, 6, 0), (6, 6, 0)], key=str)
    assert ngram_join(docs_frame(spark, [])).count() == 0
    kept = stage_near_duplicates(spark, docs_frame(spark, rows), "").collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([None, 5, 6], key=str)


def test_pruning_keeps_links():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    lost = 0
    for _ in range(200):
        a = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 95, dtype=np.uint64)]))
        sig = np.array([signature(a), signature(b)])
        left, _ = nj.survivors(sig, np.array([len(a), len(b)]), np.array([0]), np.array([1]))
        lost += not len(left)
    assert lost == 0
    assert least_matches(24) < least_matches(240) and least_matches(240) > 100


def test_exact_by_both_ways():
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(240, 290), replace=False)) for _ in range(30)]
    left, right = np.triu_indices(30, 1)
    want = [5 * len(set(sets[a]) & set(sets[b])) >= 4 * len(set(sets[a]) | set(sets[b])) for a, b in zip(left, right)]
    assert list(nj.exact(sets, left, right)) == want
    assert [bool(nj.exact(sets, left[k : k + 1], right[k : k + 1])[0]) for k in range(50)] == want[:50]


def test_shingle_counts():
    for text in AWKWARD:
        assert len(shingle_sets([text or ""])[0]) == len(brute_sets(text))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = sorted((r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == sorted((x, root(x)) for x in parent)
