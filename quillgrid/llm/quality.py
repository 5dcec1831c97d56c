"""Quality rules: word statistics, and divergence from language references.

Everything is a DataFrame expression over one row; no shuffle, no Python on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import let, table

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5

#: Share of each character class in running text (lower case, white space, upper case, digits, plain
#: punctuation, symbols, rest); the class order is that of CLASSES.
CLASSES = ("lower", "space", "upper", "digit", "punct", "symbol", "rest")
CLASS_SHARES = {
    "en": (0.800, 0.160, 0.017, 0.004, 0.018, 0.0005, 0.0005),
    "fr": (0.795, 0.165, 0.016, 0.004, 0.019, 0.0005, 0.0005),
    "de": (0.790, 0.145, 0.040, 0.004, 0.020, 0.0005, 0.0005),
    "es": (0.800, 0.165, 0.014, 0.004, 0.016, 0.0005, 0.0005),
}
#: Common words of each language with their usual share of all words.
COMMON_WORDS = {
    "en": {"the": 0.062, "of": 0.034, "and": 0.029, "to": 0.026, "a": 0.022, "in": 0.020, "is": 0.012, "that": 0.011, "for": 0.010, "it": 0.010, "was": 0.009, "on": 0.008, "with": 0.007, "as": 0.007, "be": 0.006, "by": 0.006, "this": 0.005, "are": 0.005},
    "fr": {"de": 0.058, "la": 0.034, "le": 0.030, "et": 0.026, "les": 0.024, "des": 0.020, "en": 0.016, "un": 0.013, "du": 0.013, "une": 0.012, "que": 0.011, "est": 0.010, "pour": 0.009, "qui": 0.009, "dans": 0.009, "par": 0.008, "au": 0.006, "sur": 0.006},
    "de": {"der": 0.036, "die": 0.035, "und": 0.030, "in": 0.019, "den": 0.013, "von": 0.012, "zu": 0.012, "das": 0.012, "mit": 0.010, "sich": 0.009, "des": 0.009, "auf": 0.009, "für": 0.008, "ist": 0.008, "im": 0.008, "dem": 0.008, "nicht": 0.008, "ein": 0.007},
    "es": {"de": 0.062, "la": 0.038, "que": 0.030, "el": 0.029, "en": 0.026, "y": 0.025, "a": 0.020, "los": 0.017, "se": 0.013, "del": 0.012, "las": 0.011, "un": 0.010, "por": 0.009, "con": 0.009, "no": 0.008, "una": 0.008, "para": 0.007, "es": 0.007},
}


@dataclass(frozen=True)
class QualityRules:
    """min_words, repeat_percent: the base rule. min_chars, min_hist_words: shorter texts are not compared at all, as their
    histograms are noise. max_class_distance, max_word_distance: Jensen-Shannon distances (square root, base 2, so 0 to 1)
    to the nearest language reference above which a text is rejected."""

    min_words: int = 10
    repeat_percent: int = 20
    min_chars: int = 200
    min_hist_words: int = 60
    max_class_distance: float = 0.30
    max_word_distance: float = 0.36


def _half(p: Column, q: Column) -> Column:
    """Twice what one bin adds to the Jensen-Shannon divergence, in nats."""
    m = (p + q) / 2
    term = lambda x: F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))
    return term(p) + term(q)


def _distance(total: Column) -> Column:
    return F.sqrt(F.greatest(total, F.lit(0.0)) / (2 * math.log(2)))


def repeated_words(words: Column, n_words: Column) -> Column:
    """Words in 5-word windows that occur at least twice in the array, first occurrences included.

    Windows are compared by 64-bit hashes within one text. Texts without a repeated window stop after a hash-set pass; the
    others sort (hash, position), so the cost is n log n for any text.
    """

    def covered(hashes: Column) -> Column:
        paired = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        flagged = lambda s: F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        starts = let(paired, lambda s: F.array_sort(F.transform(flagged(s), lambda x: x["i"])))
        return let(starts, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    hashes = F.transform(F.sequence(F.lit(1), n_words - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n_words <= WINDOW, F.lit(0)).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and class_hist and common_hist (counts).

    Null text counts as empty: all counts 0. Columns of docs with these names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    common = sorted({w for words in COMMON_WORDS.values() for w in words})
    # Each class is removed from what the former left, so that only the first pass sees the whole text.
    df = docs.withColumn("__t", t).withColumn("__words", F.filter(F.split("__t", f"{SPACE}+"), lambda w: w != ""))
    df = df.withColumn("__r1", F.regexp_replace("__t", r"\p{Ll}+", "")).withColumn("__r2", F.regexp_replace("__r1", f"{SPACE}+", ""))
    df = df.withColumn("__r3", F.regexp_replace("__r2", r"\p{Lu}+", "")).withColumn("__r4", F.regexp_replace("__r3", r"[0-9]+", ""))
    df = df.withColumn("__r5", F.regexp_replace("__r4", r"[.,;:!?'\x22()\-]+", "")).withColumn("__r6", F.regexp_replace("__r5", r"[#*$%&|<>]+", ""))
    n = [F.length(c) for c in ("__t", "__r1", "__r2", "__r3", "__r4", "__r5", "__r6")]
    counts = [a - b for a, b in zip(n, n[1:])]
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(WORD))
    df = df.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": (F.length("__t") - counts[1]).cast("long"),
            "n_symbols": counts[5].cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            # Never null; a filter on what is derived from it stays above, instead of a copy of all this per use.
            "class_hist": F.when(F.monotonically_increasing_id() >= 0, F.array(*[c.cast("double") for c in (*counts, n[6])])),
            "__common": F.filter(F.transform("__words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))), lambda w: w.isin(*common)),
        }
    ).withColumn("n_repeat_words", repeated_words(F.col("__words"), F.size("__words")))
    found = F.array_distinct("__common")
    hist = F.map_from_arrays(found, F.transform(found, lambda w: F.size("__common") - F.size(F.array_remove("__common", w))))
    df = df.withColumn("common_hist", F.when(F.monotonically_increasing_id() >= 0, hist))
    return df.drop("__t", "__words", "__common", *[f"__r{k}" for k in range(1, 7)])


def judge(measured: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """What measure() gives, with class_distance, word_distance (null under the length guards), base_failed and kept."""
    total = F.aggregate("class_hist", F.lit(0.0), lambda a, x: a + x)
    with_total = measured.withColumn("__total", total)
    n = F.col("n_words").cast("double")
    arrays = lambda values: F.array(*[F.lit(float(x)) for x in values])
    divergence = lambda p, q: F.aggregate(F.zip_with(p, q, _half), F.lit(0.0), lambda a, x: a + x)
    shares = F.transform("class_hist", lambda x: x / F.col("__total"))
    by_class = let(shares, lambda p: F.array_min(F.array(*[divergence(p, arrays(q / sum(own) for q in own)) for own in CLASS_SHARES.values()])))

    def by_words(words: dict[str, float]) -> Column:
        found = F.transform(F.array(*[F.lit(w) for w in words]), lambda w: F.coalesce(F.try_element_at("common_hist", w), F.lit(0)) / n)
        bins = lambda p: F.concat(p, F.array(F.aggregate(p, F.lit(1.0), lambda a, x: a - x)))
        return let(found, lambda p: divergence(bins(p), arrays((*words.values(), 1 - sum(words.values())))))

    df = with_total.withColumn("class_distance", F.when(F.col("__total") >= rules.min_chars, F.round(_distance(by_class), 6)))
    df = df.withColumn("word_distance", F.when(F.col("n_words") >= rules.min_hist_words, F.round(_distance(F.array_min(F.array(*[by_words(w) for w in COMMON_WORDS.values()]))), 6)))
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    far = F.coalesce(F.col("class_distance") > rules.max_class_distance, F.lit(False)) | F.coalesce(F.col("word_distance") > rules.max_word_distance, F.lit(False))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far).drop("__total", "class_hist", "common_hist")


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept")


def quality_rules(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """docs with COLUMNS; own columns of these names are replaced. Null and empty texts fail the base rule (no words);
    repeated rows get the same verdict each; an empty table gives an empty table."""
    return judge(measure(docs.drop(*COLUMNS), text), rules, text)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *COLUMNS)


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with the columns they came with."""
    return quality_rules(docs.withColumn("__row", F.struct("*"))).filter("kept").select("__row.*")


def _sql() -> str:
    ln2 = 2 * math.log(2)

    def half(p: str, q: float) -> str:
        m = f"(({p}+{q!r})/2)"
        return f"(CASE WHEN {p}>0 THEN {p}*ln({p}/{m}) ELSE 0 END + {q!r}*ln({q!r}/{m}))"

    by_class = [" + ".join(half(f"p{k}", q / sum(shares)) for k, q in enumerate(shares)) for shares in CLASS_SHARES.values()]

    def by_words(words: dict[str, float]) -> str:
        count = lambda w: f"len(list_filter(lw, lambda x: x='{w}'))"
        seen = "(" + " + ".join(count(w) for w in words) + ")"
        return " + ".join(half(f"({count(w)}/n_words)", q) for w, q in words.items()) + " + " + half(f"(1-{seen}/n_words)", 1 - sum(words.values()))

    r = QualityRules()
    common = ",".join(f"'{w}'" for w in sorted({w for words in COMMON_WORDS.values() for w in words}))
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(text,'') AS t FROM documents
), split AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x<>'') AS w,
    length(t) - length(regexp_replace(t, '\\p{{Ll}}+', '', 'g')) AS c0,
    length(t) - length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS c1,
    length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS c2,
    length(t) - length(regexp_replace(t, '[0-9]+', '', 'g')) AS c3,
    length(t) - length(regexp_replace(t, '[.,;:!?''\\x22()\\-]+', '', 'g')) AS c4,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS c5,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM base
), windows AS (
  SELECT doc_id, i, w[i:i+4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w)-3)) AS i FROM split)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), counted AS (
  SELECT doc_id, t, len(w) AS n_words, length(t) - c1 AS word_chars, c5 AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    c0/length(t) AS p0, c1/length(t) AS p1, c2/length(t) AS p2, c3/length(t) AS p3, c4/length(t) AS p4, c5/length(t) AS p5,
    (length(t)-c0-c1-c2-c3-c4-c5)/length(t) AS p6,
    list_filter(list_transform(w, lambda x: lower(rtrim(x, '.,;:!?'))), lambda x: x IN ({common})) AS lw
  FROM split LEFT JOIN covered USING (doc_id)
), scored AS (
  SELECT *,
    CASE WHEN length(t) >= {r.min_chars} THEN round(sqrt(greatest(least({", ".join(by_class)}), 0)/{ln2!r}), 6) END AS class_distance,
    CASE WHEN n_words >= {r.min_hist_words} THEN round(sqrt(greatest(least({", ".join(by_words(w) for w in COMMON_WORDS.values())}), 0)/{ln2!r}), 6) END AS word_distance,
    n_words < {r.min_words} OR 100*n_repeat_words > {r.repeat_percent}*n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, class_distance, word_distance, base_failed,
  NOT base_failed AND NOT coalesce(class_distance > {r.max_class_distance}, false) AND NOT coalesce(word_distance > {r.max_word_distance}, false) AS kept
FROM scored
"""


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES = {"op1_quality_rules": _sql()}
