import math
import re
import unicodedata

from quillgrid.llm.quality import CLASS_SHARES, COMMON_WORDS, QualityRules, quality_rules

from .common import AWKWARD, docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def distance(p, q):
    """Jensen-Shannon distance, base 2."""
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x > 0)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))


def brute_divergence(text):
    """(class distance, word distance) to the nearest reference, None where the text is too short."""
    text, r = text or "", QualityRules()
    kinds = [0] * 7
    for c in text:
        k = unicodedata.category(c)
        kinds[0 if k == "Ll" else 1 if c in "\x20\x09\x0a\x0b\x0c\x0d" else 2 if k == "Lu" else 3 if c in "0123456789" else 4 if c in ".,;:!?'\"()-" else 5 if c in "#*$%&|<>" else 6] += 1
    n = len(text)
    a = min(distance([k / n for k in kinds], [x / sum(q) for x in q]) for q in CLASS_SHARES.values()) if n >= r.min_chars else None
    words = [w.rstrip(".,;:!?").lower() for w in WORD.findall(text)]
    b = None
    if len(words) >= r.min_hist_words:
        b = 9.0
        for own in COMMON_WORDS.values():
            p = [words.count(w) / len(words) for w in own]
            b = min(b, distance([*p, 1 - sum(p)], [*own.values(), 1 - sum(own.values())]))
    return a, b


def brute_kept(text):
    a, b = brute_divergence(text)
    r = QualityRules()
    return not brute(text)[5] and not round(a or 0, 6) > r.max_class_distance and not round(b or 0, 6) > r.max_word_distance


def test_divergence_against_brute_force(spark):
    rows = [*AWKWARD, "The cat and the dog of that town! " * 20, "DER DIE DAS ### 123 " * 30, "x | y | " * 60, "el gato y la casa de los que se fue con " * 12]
    for r in quality_rules(docs_frame(spark, enumerate(rows))).collect():
        if len(rows[r.doc_id] or "") > 50_000:
            continue
        for got, want in zip((r.class_distance, r.word_distance), brute_divergence(rows[r.doc_id])):
            assert (got is None) == (want is None) and (got is None or abs(got - want) < 2e-6)
        assert r.kept == brute_kept(rows[r.doc_id])


def test_against_brute_force(spark):
    rows = [*AWKWARD, "one two three four five six one two three four five six", "a b c d e x a b c d e y z w v u t s r q p o n", "###$$$ <b>|</b>"]
    got = {r.doc_id: r for r in quality_rules(docs_frame(spark, enumerate(rows))).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), (i, (text or "")[:50])


def test_divergence_rejects_junk_and_keeps_prose(spark):
    prose = "The house of the old man was on the hill and it is said that he came to the town in the spring with a dog. " * 1
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = [(1, prose * 1 + "And the river by the road was as wide as the sea for all of this."), (2, " ".join(w.upper() + "!!" for w in words)), (3, " | ".join(words)), (4, "kurz und gut")]
    got = {r.doc_id: r for r in quality_rules(docs_frame(spark, rows), QualityRules(repeat_percent=100)).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept
    assert got[4].class_distance is None and got[4].word_distance is None


def test_empty_table_repeats_and_clashing_columns(spark):
    assert quality_rules(docs_frame(spark, [])).count() == 0
    frame = docs_frame(spark, [(1, "a b"), (1, "a b"), (None, None)]).selectExpr("*", "'x' AS kept", "1 AS n_words")
    got = quality_rules(frame).collect()
    assert len(got) == 3 and not any(r.kept for r in got)
