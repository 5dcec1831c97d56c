import math
import random

import pytest
from pyspark.sql import functions as F

from quillgrid.llm.toxicity import Model, fit, fitted, score_text, toxicity, training_rows, words_of

from .common import AWKWARD, as_table, docs_frame

CLEAN = "the house on a hill was old and the river ran by it under trees where birds sing all day".split()
BAD = ["blorg", "frenkish", "snarlode", "vilkemort"]


def sample(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.randint(5, 200))]
        label = i % 3 == 0
        if label:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randint(0, len(words)), rng.choice(BAD) + rng.choice(["", "ish", "er"]))
        out.append((" ".join(words), int(label)))
    return out


@pytest.fixture(scope="module")
def model():
    return fit(sample(400, 1))


def test_held_out_accuracy_and_offsets(model):
    test = sample(300, 2)
    wrong = 0
    for text, label in test:
        got = score_text(model, text)
        wrong += got["predicted"] != label
        for o in got["offsets"]:
            assert any(text[o["start"] : o["end"]].startswith(b) for b in BAD)
        assert label == 0 or got["offsets"]
    assert wrong <= 3


def test_offsets_where_lower_case_is_longer(model):
    text = "\u0130stanbul the house " + "blorg frenkish snarlode vilkemort " * 3 + "on a hill"
    got = score_text(model, text)
    assert got["predicted"] == 1 and got["offsets"]
    assert all(text[o["start"] : o["end"]].startswith(tuple(BAD)) for o in got["offsets"])


def brute_marginals(model, scores):
    """Sum over all labellings."""
    n, total, on = len(scores), 0.0, [0.0] * len(scores)
    for bits in range(1 << n):
        y = [bits >> k & 1 for k in range(n)]
        w = math.exp(sum(s * b for s, b in zip(scores, y)) + sum(model.transition[a][b] for a, b in zip(y, y[1:])))
        total += w
        for k, b in enumerate(y):
            on[k] += w * b
    return [x / total for x in on]


def test_marginals_against_enumeration():
    rng = random.Random(4)
    for _ in range(20):
        m = Model(transition=((rng.gauss(0, 1), rng.gauss(0, 1)), (rng.gauss(0, 1), rng.gauss(0, 1))))
        scores = [rng.gauss(0, 2) for _ in range(rng.randint(1, 9))]
        assert m.marginals(scores) == pytest.approx(brute_marginals(m, scores), abs=1e-12)


def test_long_runs_are_folded_exactly(model):
    rng = random.Random(5)
    emissions = [6.0 if rng.random() < 0.004 else None for _ in range(5000)]
    _, expected, largest = model.tag(emissions)
    whole = model.marginals([model.bias + (x or 0.0) for x in emissions])
    assert expected == pytest.approx(sum(p for p, x in zip(whole, emissions) if x is not None), abs=1e-9) and largest == pytest.approx(max(whole), abs=1e-12)


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_any_field_are_folded_exactly(seed):
    rng = random.Random(seed)
    stick = [0.5, 3.0, 6.0][seed % 3]
    m = Model(bias=rng.gauss(-1, 1), transition=((stick + rng.random(), -rng.random() * stick), (-rng.random() * stick, stick + rng.random())))
    emissions = [rng.gauss(2, 3) if rng.random() < 0.003 else None for _ in range(6000)]
    tagged, expected, largest = m.tag(emissions)
    whole = m.marginals([m.bias + (x or 0.0) for x in emissions])
    assert all(p == pytest.approx(whole[i], abs=1e-9) for i, p in tagged)
    assert expected == pytest.approx(sum(p for p, x in zip(whole, emissions) if x is not None), abs=1e-9) and largest == pytest.approx(max(whole), abs=1e-9)
    at = [i for i, _ in tagged]
    assert all(abs(whole[k] - whole[a]) < 1e-9 and abs(whole[k] - whole[b]) < 1e-9 for a, b in zip(at, at[1:]) for k in range(a + 1, b))


def test_scores_of_a_whole_table_against_all_tokens(spark, model):
    rows = [(i, t) for i, (t, _) in enumerate(sample(60, 9))] + [(100 + i, t) for i, t in enumerate(AWKWARD)]
    for r in toxicity(docs_frame(spark, rows), model).collect():
        words = words_of(r.text or "")
        emissions = [model.emission(w) for w in words]
        whole = model.marginals([model.bias + (x or 0.0) for x in emissions])
        score = model.score(len(words), sum(p for p, x in zip(whole, emissions) if x is not None), max(whole, default=0.0))
        assert r.score == pytest.approx(score, abs=1e-9) and r.predicted == (score >= 0.5)
        on = [p >= 0.5 for p in whole]
        assert len(r.offsets) == sum(x and not (k and on[k - 1]) for k, x in enumerate(on))


def test_the_sample_does_not_depend_on_the_order_of_rows(spark):
    docs = docs_frame(spark, [(i, f"t{i}") for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic long")
    first = training_rows(docs, labels, rows=20)
    assert first == training_rows(docs.repartition(7), labels.orderBy(F.desc("doc_id")).repartition(5), rows=20)


def test_operator_and_sample(spark, model):
    rows = [*enumerate(AWKWARD), (None, "x"), (None, "x")]
    got = toxicity(docs_frame(spark, rows).selectExpr("*", "'clash' AS score"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert toxicity(docs_frame(spark, []), model).count() == 0
    docs = docs_frame(spark, [(i, f"t{i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1, 0), (3, None), (None, 1)], "doc_id long, toxic long")
    rows = training_rows(docs, labels, rows=20)
    assert 20 <= len(rows) <= 40 and all(int(t[1:]) % 2 == y for t, y in rows)
    assert training_rows(docs, labels.limit(0)) == []
    assert score_text(fit([]), "x")["predicted"] in (0, 1)


def test_training_keeps_no_tokens(spark, tmp_path):
    import tracemalloc

    rows = [(" ".join(f"word{(i * 37 + k * k) % 500}" for k in range(6000)) + (" vile" if i % 2 else ""), i % 2) for i in range(40)]
    tracemalloc.start()
    whole = fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * 40 * 6000  # 40 bytes a token; as strings in lists they took over 60
    docs = docs_frame(spark, [*enumerate(t for t, _ in rows), (50, None), (51, "")])
    as_table(spark, docs, tmp_path)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(50, 0), (51, 1)], "doc_id long, toxic int")
    as_table(spark, labels, tmp_path, "labels")
    assert fitted(spark, str(tmp_path)) == fit(training_rows(docs, labels)) != whole
