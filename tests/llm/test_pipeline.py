import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers
import pytest
from tokenizers import Tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from quillgrid.llm.suffix_dedup import PASSAGE  # noqa: E402
from quillgrid.llm.toxicity import fit, score_text  # noqa: E402

from .common import AWKWARD, as_table, docs_frame  # noqa: E402
from .test_ngram_join import brute_sets  # noqa: E402
from .test_quality import brute_kept  # noqa: E402

COMMON = "the of and to a in is that for it was on with as be by this are".split()
BAD = ["blorg", "frenkish", "snarlode", "vilkemort"]


def prose(rng, n, extra=()):
    words = [rng.choice(COMMON) if rng.random() < 0.45 else "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)]
    for w in extra:
        words.insert(rng.randrange(len(words)), w)
    return " ".join(words)


def corpus():
    rng = random.Random(11)
    passage = prose(rng, 90)
    rows, labels = [], []
    for i in range(260):
        toxic = i % 5 == 0
        text = prose(rng, rng.randint(60, 160), [rng.choice(BAD) for _ in range(4)] if toxic else ())
        if i % 40 == 7:
            text += " " + passage + " " + prose(rng, 20)
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    for i in range(20):
        words = rows[i + 1][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((300 + i, " ".join(words) if i % 2 else rows[i + 1][1]))
    rows += [(400 + i, t) for i, t in enumerate(AWKWARD)] + [(500, "a b c d e " * 30), (1, rows[1][1]), (None, prose(rng, 70))]
    return rows, labels


def brute(rows, labels):
    """The stages in plain Python, to {doc_id: text}; rows without an id come in a list."""
    kept = [(i, t) for i, t in rows if brute_kept(t)]
    by = dict(rows)
    train = [(by[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5]
    model = fit(train)
    kept = [(i, t) for i, t in kept if not score_text(model, t)["predicted"]]
    named = sorted({(i, t) for i, t in kept if i is not None})
    sets = [brute_sets(t) for _, t in named]
    parent = list(range(len(named)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(named)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    kept = [named[k] for k in range(len(named)) if root(k) == k] + [(i, t) for i, t in kept if i is None]
    raws = [(i, t.encode()) for i, t in kept]
    length = PASSAGE.length
    times = Counter(r[k : k + length] for _, r in raws for k in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        on = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if times[r[k : k + length]] > 1:
                on[k : k + length] = b"\1" * length
        out.append((i, bytes(b for b, x in zip(r, on) if not x).decode()))
    return out


def test_against_brute_force(spark, tmp_path):
    rows, labels = corpus()
    as_table(spark, docs_frame(spark, rows), tmp_path)
    as_table(spark, spark.createDataFrame(labels, "doc_id long, quality long, toxic long"), tmp_path, "labels")
    want = brute(rows, labels)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    pieces = []
    for i, t in want:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        pieces += [(i, k, s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes())) for k, s in enumerate(range(0, len(ids), 1024))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(pieces, key=str)
    assert len(want) < len(rows) - 50
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_keep_the_columns(spark, tmp_path):
    as_table(spark, spark.createDataFrame([], "doc_id long, quality long, toxic long"), tmp_path, "labels")
    docs = docs_frame(spark, [(1, prose(random.Random(1), 80)), (2, None)]).selectExpr("*", "1 AS score", "'x' AS kept", "2 AS spans")
    as_table(spark, docs, tmp_path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
