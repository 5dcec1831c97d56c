import itertools
import random

import numpy as np
import pytest

from quillgrid.llm.langid import fit, identify, label_words, language_id, training_rows, viterbi

from .common import AWKWARD, docs_frame

WORDS = {
    "en": "the of and to in is that for was with this house river".split(),
    "de": "der die und nicht ein ist schön straße auch über haus fluß".split(),
    "ru": "это как дом река когда очень хорошо день".split(),
}


def text(lang, n, rng):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return fit([(text(k, 100, rng), k) for k in WORDS for _ in range(20)])


def slow_viterbi(scores, switch):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        s = sum(scores[i, k] for i, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
        best = s if best is None or s > best else best
    return best


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(2)
    for _ in range(60):
        scores = rng.normal(0, 3, (rng.integers(1, 7), 3))
        for path in (viterbi(scores, 2.0), label_words(scores, 2.0)):
            s = sum(scores[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
            assert s == pytest.approx(slow_viterbi(scores, 2.0))


def test_held_out_accuracy_and_spans(model):
    rng = random.Random(3)
    test = [(k, text(k, 12, rng)) for k in WORDS for _ in range(40)]
    got = identify(model, [t for _, t in test])
    assert sum(g["lang_pred"] == k for g, (k, _) in zip(got, test)) >= 118
    a, b = text("en", 60, rng), text("de", 20, rng)
    (mixed,) = identify(model, [f"{a} {b}"])
    assert mixed["lang_pred"] == "en" and [s["lang"] for s in mixed["spans"]] == ["en", "de"]
    assert abs(mixed["spans"][1]["start"] - len(a) - 1) <= 8


def test_operator(spark, model):
    rows = [*enumerate(AWKWARD), (None, "the house"), (None, "the house"), (90, "12 34 !?"), (91, "İİ the 𝒳")]
    got = language_id(docs_frame(spark, rows).selectExpr("*", "'clash' AS score"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        has = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") != has and 0 <= r.score <= 1
    assert language_id(docs_frame(spark, []), model).count() == 0
    assert identify(fit([]), ["the house"])[0]["lang_pred"] == "und"


def test_sample_is_bounded_and_leaves_out_held_out_rows(spark):
    from quillgrid.llm.langid import held_out

    docs = docs_frame(spark, [(i, f"t{i}", None if i % 5 == 0 else "en" if i % 2 else "de") for i in range(400)])
    rows = training_rows(docs, rows=40)
    out = {r.text for r in docs.filter(held_out()).collect()}
    assert 0 < len(rows) <= 60 and not out & {t for t, _ in rows} and all(k for _, k in rows)
    assert training_rows(docs.limit(0)) == []


def test_the_sample_does_not_depend_on_the_order_of_rows(spark):
    docs = docs_frame(spark, [(i, f"t{i}", "en" if i % 2 else "de") for i in range(300)])
    assert training_rows(docs, rows=30) == training_rows(docs.repartition(7), rows=30)
