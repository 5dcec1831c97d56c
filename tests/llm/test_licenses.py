import re
import time

import pytest

from quillgrid.llm import licenses
from quillgrid.llm.licenses import BASE_PHRASES, MORE_PHRASES, PERMITTED, evaluate_expression, license_scan, op2_license_scan, parse_expression

from ..conftest import DATA
from .common import AWKWARD, docs_frame


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    at = [(i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_against_brute_force(spark):
    rows = [*AWKWARD, "MIT License MIT-license mit  license.", "éMIT License", "Released under the MIT\nLicense, CC BY 4.0; ccby", "the GNU General Public License or Apache License", "ÀMIT LICENSE and À MIT LICENSE"]
    got = {r.doc_id: r for r in license_scan(docs_frame(spark, enumerate(rows))).collect()}
    for i, text in enumerate(rows):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), i
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize(
    ("text", "rpn", "ok"),
    [
        ("MIT", "mit", True),
        ("Classpath-exception-2.0", "classpath-exception-2.0", False),
        ("LLVM-exception", "llvm-exception", False),
        ("MIT+ AND Apache-2.0+", "mit+ apache-2.0+ and", True),
        ("GPL-2.0+", "gpl-2.0+", False),
        ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", "gpl-2.0-only classpath-exception-2.0 with mit or", True),
        ("GPL-3.0-only AND MIT", "gpl-3.0-only mit and", False),
        ("(MIT OR GPL-3.0-only) AND ISC", "mit gpl-3.0-only or isc and", True),
        ("MIT AND", None, None),
        ("OR MIT", None, None),
        ("(MIT", None, None),
        ("MIT */ int x;", "mit", True),
        ("", None, None),
    ],
)
def test_expressions(text, rpn, ok):
    found = parse_expression(text)
    assert found == (rpn.split() if rpn else None)
    if found:
        assert evaluate_expression(found) is ok


def test_tags_and_empty_table(spark):
    got = license_scan(docs_frame(spark, [(1, "x\n// SPDX-License-Identifier: Apache-2.0 OR MIT\ncode"), (2, "SPDX-License-Identifier:")])).orderBy("doc_id").collect()
    assert got[0].labels == "spdx:apache-2.0,spdx:mit" and got[0].permitted and got[0].score == 1.0
    assert got[1].labels == "" and got[1].permitted is None
    assert license_scan(docs_frame(spark, [])).count() == 0
    clash = docs_frame(spark, [(1, "mit license")]).selectExpr("*", "'x' AS labels", "3 AS __in_text")
    assert license_scan(clash).first().labels == "mit"


def slow_expression(text):
    """(names, permitted) of a licence expression by recursive descent over whole tokens; None if it is malformed."""
    tokens = [t if t in "()" else t.lower() for t in re.findall(r"[()]|[A-Za-z0-9.+\-:]+", text)]
    # Prose after the expression is cut where an operand follows an operand, or a bracket closes that none opened.
    depth, end, operand = 0, len(tokens), False
    for k, t in enumerate(tokens):
        if t in ("and", "or", "with"):
            operand = False
        elif t == "(":
            if operand:
                end = k
                break
            depth += 1
        elif t == ")":
            if operand and not depth:
                end = k
                break
            depth -= 1
        else:
            if operand:
                end = k
                break
            operand = True
    tokens = tokens[:end]
    names = []

    def level(k, words):
        if not words:
            if k < len(tokens) and tokens[k] == "(":
                k, value = level(k + 1, ("or", "and", "with"))
                if k >= len(tokens) or tokens[k] != ")":
                    raise ValueError
                return k + 1, value
            if k >= len(tokens) or tokens[k] in ("and", "or", "with", "(", ")"):
                raise ValueError
            names.append(tokens[k].rstrip("."))
            return k + 1, names[-1].rstrip("+") in PERMITTED
        k, value = level(k, words[1:])
        while k < len(tokens) and tokens[k] == words[0]:
            k, other = level(k + 1, words[1:])
            value = value or other if words[0] == "or" else value and other if words[0] == "and" else value
        return k, value

    try:
        k, value = level(0, ("or", "and", "with"))
        return (names, value) if k == len(tokens) else None
    except ValueError:
        return None


def slow_scan(text):
    """The whole query's row for a text."""
    base = brute(text)
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    phrases = MORE_PHRASES | BASE_PHRASES
    labels, score, found = set(), 0.0, []
    for i in range(len(words)):
        for phrase, label in phrases.items():
            if words[i : i + len(phrase.split())] == phrase.split():
                labels.add(label)
                score = max(score, 0.9 if {w.decode() for w in licenses.NOTICE_WORDS} & set(words[max(0, i - 6) : i]) else 0.6)
    for m in re.finditer(r"spdx-license-identifier[ \t]*:[ \t]*([^\n]*)", low):
        if got := slow_expression(m[1]):
            found.append(got)
            labels |= {f"spdx:{n}" for n in got[0]}
            score = 1.0
    return (*base, ",".join(sorted(labels)), len(found), all(ok for _, ok in found) if found else None, score)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in op2_license_scan(spark, f"{DATA}/sf0.01").collect()}
    assert len(got) == len(docs)
    for r in docs:
        assert got[r.doc_id] == slow_scan(r.text), r.doc_id


def test_expressions_against_recursive_descent(spark):
    texts = ["SPDX-License-Identifier: " + e for e in ("(MIT OR GPL-3.0-only) AND (ISC OR x) WITH y. prose", "MIT AND ISC OR GPL-2.0 AND MIT)", "((MIT)", "a WITH b WITH c", "MIT OR OR", "(MIT AND) ISC", "MIT (x)", "WITH MIT", "mit\nSPDX-License-Identifier:\tISC+ or")]
    texts += ["under the terms of a b c BSD License. SPDX-License-Identifier: none", "licensed a b c d e f mit license", "licensed a b c d e mit license"]
    got = {r.doc_id: r for r in license_scan(docs_frame(spark, enumerate(texts))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, len(r.expressions), r.permitted, r.score) == slow_scan(t), t


def test_a_long_text_of_phrases_takes_time_in_proportion():
    chosen = tuple(sorted({**MORE_PHRASES, **BASE_PHRASES}.items()))
    text = b"mit license the gnu lesser general public license apache license cc by " * 14_000
    began = time.process_time()
    found = licenses.scan_text(text, chosen)
    assert len(text) > 990_000 and time.process_time() - began < 2
    assert found["n_base"] == 3 * 14_000 and (found["first_word"], found["last_word"]) == (0, 12 * 14_000 - 2)


def test_phrases_that_overlap(monkeypatch):
    phrases = (("a b c", "long"), ("b", "mid"), ("b c", "end"), ("c a", "next"))
    found = licenses.scan_text(b"a b c a b c", phrases)
    words = "a b c a b c".split()
    want = sorted((i, label) for phrase, label in phrases for i in range(6) if words[i : i + len(phrase.split())] == phrase.split())
    assert [(p["word"], p["label"]) for p in found["places"]] == want
