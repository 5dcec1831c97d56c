import hashlib
import random
from collections import Counter

import pytest

from quillgrid.llm import suffix_dedup as sd

from .common import AWKWARD, docs_frame


def brute(rows, length=400):
    """(n_bytes, n_removed, n_spans, sha256) of each row."""
    raws = [(t or "").encode() for _, t in rows]
    times = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        on = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if times[r[i : i + length]] > 1:
                on[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(on) if x and (i == 0 or not on[i - 1]))
        out.append((len(r), sum(on), spans, hashlib.sha256(bytes(b for b, x in zip(r, on) if not x)).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdé fgh\n") for _ in range(n))
    passages = [prose(n) for n in (390, 399, 400, 401, 450, 700, 1500)]
    texts = [prose(rng.randint(0, 900)) + rng.choice(passages)[rng.randint(0, 30) :] + prose(rng.randint(0, 700)) for _ in range(60)]
    texts += [texts[0], texts[1], texts[1], passages[6], passages[6] * 2, "ab" * 700, "x" * 401, "x" * 400, "ab" * 300, "Word " * 300, "Word " * 200 + passages[3], "x" * 5000, "long line of words\n" * 90]
    base = prose(1500)
    for _ in range(25):
        t = list(base)
        for _ in range(rng.randint(1, 4)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    return list(enumerate(texts + AWKWARD))


def check(got, rows, length=400):
    want = brute(rows, length)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for (i, _), w in zip(rows, want):
        r = by[i]
        removed = sum(s.end - s.start for s in r.spans)
        assert (r.n_bytes, removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == w, i


@pytest.mark.parametrize(("seed", "group"), [(1, sd.GROUP), (2, 3)])
def test_against_brute_force(spark, seed, group):
    rows = [(i, t) for i, t in corpus(seed) if len(t or "") < 40_000]
    check(sd.suffix_dedup(docs_frame(spark, rows).selectExpr("*", "'clash' AS spans", "1 AS key", "2 AS kh"), group=group).collect(), rows)


@pytest.mark.parametrize(("seed", "group"), [(3, sd.GROUP), (4, 2)])
def test_the_stage_s_shape_against_brute_force(spark, seed, group):
    rows = [(i, t) for i, t in corpus(seed) if len(t or "") < 40_000]
    check(sd.suffix_dedup(docs_frame(spark, rows), group=group, shape=sd.PASSAGE).collect(), rows, sd.PASSAGE.length)


@pytest.mark.parametrize(("seed", "group"), [(5, sd.GROUP), (6, 2)])
def test_two_lengths_at_once_against_brute_force(spark, seed, group):
    rows = [(i, t) for i, t in corpus(seed) if len(t or "") < 40_000]
    got = sd.suffix_dedup_twice(docs_frame(spark, rows), group=group).collect()
    check(got, rows)
    short = {i: w for (i, _), w in zip(rows, brute(rows, sd.PASSAGE.length))}
    alone = {r.doc_id: bytes(r.kept) for r in sd.suffix_dedup(docs_frame(spark, rows), whole=True, shape=sd.PASSAGE).collect()}
    for r in got:
        assert (sum(s.end - s.start for s in r.passages), len(r.passages)) == short[r.doc_id][1:3]
        assert bytes(r.rest) == alone[r.doc_id]


def test_two_lengths_with_repeated_rows_null_ids_and_an_empty_table(spark):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b = prose(700), prose(300)
    rows = [(1, a), (1, b + prose(200)), (1, prose(400)), (2, b), (2, b), (2, None), (None, a), (None, prose(500)), (3, "")]
    got = sd.suffix_dedup_twice(docs_frame(spark, rows)).collect()
    assert sorted((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == sorted(brute(rows))
    assert sorted((r.n_bytes, sum(s.end - s.start for s in r.passages), len(r.passages), hashlib.sha256(bytes(r.rest)).hexdigest()) for r in got) == sorted(brute(rows, 200))
    assert sd.suffix_dedup_twice(docs_frame(spark, [])).count() == 0


def test_query_s_text_lacks_passages_of_over_fifty_words_and_its_counts_are_of_400_bytes(spark, tmp_path):
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choices("abcdefghé", k=rng.randint(2, 7))) for _ in range(n))
    passage, clean = words(55), words(120)
    assert 200 < len(passage.encode()) < 400
    heads, tails = [f"{words(40)} {i}" for i in range(3)], [f"{i} {words(30)}" for i in range(3)]
    rows = [(i, f"{h}{passage}{t}") for i, (h, t) in enumerate(zip(heads, tails))] + [(7, clean), (8, None)]
    docs_frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in sd.op7_suffix_dedup(spark, str(tmp_path)).collect()}
    for i, (h, t) in enumerate(zip(heads, tails)):
        assert got[i].text == f"{h}{t}" and got[i].n_passages == 1
    assert (got[7].text, got[7].n_passages, got[8].text, got[8].n_passages) == (clean, 0, None, 0)
    for (i, _), want in zip(rows, brute(rows)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want and got[i].n_removed == 0


def test_one_id_with_three_texts(spark):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = prose(600)
    texts = [passage + prose(100), prose(50) + passage, prose(900), prose(300)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[2]), (1, texts[2]), (2, texts[3]), (2, None), (2, None), (None, texts[0]), (None, texts[3] + texts[3])]
    got = sorted(((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in sd.suffix_dedup(docs_frame(spark, rows)).collect()))
    assert got == sorted(brute(rows))


def test_anchors_with_colliding_hashes_are_told_apart():
    shape = sd.Shape(8, 4)
    contexts = [(4, 1, b"abcdGRAM"), (4, 1, b"abcdgram"), (4, 2, b"abcdGRAMx")]
    assert sd.repeated_windows(contexts, shape) == [[(0, 1)], [], [(0, 1)]]


def test_long_texts_in_parts(spark):
    rng = random.Random(9)
    part = "".join(rng.choice("abcdefgh") for _ in range(3000))
    filler = "".join(rng.choices("ijklmnop", k=sd.CHUNK - 1500))
    rows = [(1, filler + part), (2, part[500:2500]), (3, "ß" * 600_000)]
    got = {r.doc_id: r for r in sd.suffix_dedup(docs_frame(spark, rows)).collect()}
    assert [(s.start, s.end) for s in got[1].spans] == [(sd.CHUNK - 1500 + 500, sd.CHUNK - 1500 + 2500)]
    assert bytes(got[2].kept) == b"" and bytes(got[3].kept) == b""


def test_null_ids_repeats_and_empty_table(spark):
    long = "abc " * 120
    rows = [(None, long), (None, long), (5, "q" * 10), (5, "q" * 10), (6, None), (None, None)]
    got = sd.suffix_dedup(docs_frame(spark, rows)).collect()
    assert len(got) == 6 and all(bytes(r.kept) == (b"" if r.text == long else (r.text or "").encode()) for r in got)
    assert sd.suffix_dedup(docs_frame(spark, [])).count() == 0


def test_stage_cuts_no_character(spark):
    passage = "é" * 300
    rows = [(1, "a" + passage + "b" * 50), (2, passage[1:] + "ü")]
    got = {r.doc_id: r for r in sd.stage_suffix_dedup(spark, docs_frame(spark, rows), "").collect()}
    assert got[1].text == "a" + "b" * 50 and got[1].n_chars == 51


def test_stage_keeps_replacement_characters_of_the_source(spark):
    rng = random.Random(6)
    passage = "".join(rng.choice("éüabc") for _ in range(500))
    rows = [(1, "x\ufffdy\u00e8" + passage + "\u00ea\ufffd"), (2, "z\u0128" + passage + "\u00eb")]
    got = {r.doc_id: r for r in sd.stage_suffix_dedup(spark, docs_frame(spark, rows), "").collect()}
    assert got[1].text == "x\ufffdy\ufffd" and got[1].n_chars == 4


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deep_shallow_sort(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab") for _ in range(60))
    strings = [base[: rng.randint(0, 60)] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 8))) for _ in range(200)] + [b"", b"", base, base]
    order = sd.deep_shallow_sort(strings)
    assert sorted(order) == list(range(len(strings))) and [strings[i] for i in order] == sorted(strings)


def test_common_prefix():
    rng = random.Random(4)
    for _ in range(300):
        a, b = (bytes(rng.choice(b"\0\1") for _ in range(rng.randint(0, 12))) for _ in range(2))
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert sd._common(a, b) == n
