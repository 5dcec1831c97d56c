"""Language identification: scripts narrow the candidates, Viterbi over word scores labels spans of mixed texts."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_rows, table, texts

UNKNOWN = "und"
#: Rows of the training sample, and code points up to which a text may be in it: the sample's bounds.
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 20_000
#: Slots of the trigram table, what each count is raised by, and nats that a change of language costs.
SLOTS, SMOOTHING, SWITCH = 1 << 18, 0.1, 12.0
#: A script is a language's if so much of its training letters are in it.
SCRIPT_SHARE = 0.001
#: Code points of a chunk of texts that are scored together.
CHUNK = 1_000_000

#: First code points of ranges of scripts (Unicode blocks), with the script that begins there.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"),
    (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0x10000, "other"), (0x20000, "han"),
)

_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: itself in lower case where that is one code point, 32 where it is no letter; its script."""
    if not _TABLES:
        lower = np.full(sys.maxunicode + 1, 32, np.uint32)
        for c in range(sys.maxunicode + 1):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        names = sorted({name for _, name in SCRIPTS})
        script = np.zeros(sys.maxunicode + 1, np.uint8)
        for (a, name), b in zip(SCRIPTS, [*(x for x, _ in SCRIPTS[1:]), sys.maxunicode + 1]):
            script[a:b] = names.index(name)
        _TABLES.extend((lower, script))
    return _TABLES[0], _TABLES[1]


N_SCRIPTS = len({name for _, name in SCRIPTS})


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _slots(codes: np.ndarray) -> np.ndarray:
    """The trigram slot of each inner code point of codes, which begin and end with 32."""
    with np.errstate(over="ignore"):
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        h = a * np.uint32(0x9E3779B1) ^ (b * np.uint32(0x85EBCA6B) + (c * np.uint32(0xC2B2AE35) >> np.uint32(3)))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        return (h >> np.uint32(14)) & np.uint32(SLOTS - 1)


@dataclass
class Model:
    """languages; scores[slot, language]; allowed[script, language]."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray


def fit(rows: Iterable[tuple[str, str]]) -> Model:
    """A model of (text, language) rows; without rows it knows no language."""
    lower, script = _tables()
    rows = [(t, lang) for t, lang in rows if t and lang]
    languages = sorted({lang for _, lang in rows})
    counts, letters = np.zeros((SLOTS, len(languages))), np.zeros((N_SCRIPTS, len(languages)))
    for text, lang in rows:
        k = languages.index(lang)
        raw = code_points(text)
        codes = np.concatenate([[32], lower[raw], [32]]).astype(np.uint32)
        is_letter = codes[1:-1] != 32
        np.add.at(counts[:, k], _slots(codes)[is_letter], 1)
        letters[:, k] += np.bincount(script[raw[is_letter]], minlength=N_SCRIPTS)
    log = np.log(counts + SMOOTHING) - np.log(counts.sum(0) + SMOOTHING * SLOTS)
    if languages:
        log -= log.mean(1, keepdims=True)
    allowed = letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(0))
    allowed |= ~allowed.any(1, keepdims=True)
    return Model(languages, log.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> list[int]:
    """The best language for each word, where each change of language costs switch; ties keep the former language."""
    rows = scores.tolist()
    best, back = list(rows[0]), []
    for row in rows[1:]:
        top = max(best)
        at = best.index(top)
        moved = top - switch
        back.append([k if b >= moved else at for k, b in enumerate(best)])
        best = [r + (b if b >= moved else moved) for r, b in zip(row, best)]
    path = [best.index(max(best))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1]


def label_words(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """viterbi(), without its loop where one language provably is best throughout.

    Let k be the language of the largest sum. If no run of words is better by more than switch / 2 in another language,
    each stretch outside k gains less than the changes that it needs cost.
    """
    k = int(np.argmax(scores.sum(0)))
    gain = np.cumsum(scores - scores[:, k : k + 1], axis=0, dtype=np.float64)
    before = np.vstack([np.zeros((1, scores.shape[1])), gain[:-1]])
    if float((gain - np.minimum.accumulate(before, axis=0)).max()) < switch / 2:
        return np.full(len(scores), k)
    return np.array(viterbi(scores, switch))


def identify(model: Model, batch: list[str], switch: float = SWITCH) -> list[dict]:
    """lang_pred, score and spans of each text."""
    out: list[dict] = []
    at = 0
    while at < len(batch):
        size, end = 0, at
        while end < len(batch) and (end == at or size + len(batch[end]) <= CHUNK):
            size += len(batch[end]) + 1
            end += 1
        out += _identify(model, batch[at:end], switch)
        at = end
    return out


def _identify(model: Model, batch: list[str], switch: float) -> list[dict]:
    lower, script = _tables()
    raw = code_points(" ".join(["", *batch, ""]))
    codes = lower[raw]
    letter = codes != 32
    edges = np.diff(letter.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    none = {"lang_pred": UNKNOWN, "score": 0.0, "spans": []}
    if not len(starts) or not model.languages:
        return [dict(none) for _ in batch]
    inner = _slots(codes)[letter[1:-1]]
    lengths = ends - starts
    words = np.add.reduceat(model.scores[inner], np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
    words = np.where(model.allowed[script[raw[starts]]], words, words - np.float32(50))
    first = np.cumsum([1, *(len(t) + 1 for t in batch)])
    of = np.searchsorted(starts, first)
    out = []
    for i in range(len(batch)):
        a, b = of[i], of[i + 1]
        if a == b:
            out.append(dict(none))
            continue
        path = label_words(words[a:b], switch)
        share = np.bincount(path, lengths[a:b], len(model.languages))
        k = int(np.argmax(share))
        cuts = np.flatnonzero(np.diff(path)) + 1
        spans = [{"start": int(starts[a + s] - first[i]), "end": int(ends[a + e - 1] - first[i]), "lang": model.languages[path[s]]} for s, e in zip([0, *cuts], [*cuts, b - a])]
        mean = words[a:b].sum(0) / math.sqrt(b - a)
        sure = 1 / float(np.exp(np.clip(mean - mean[k], -50, 50)).sum())
        out.append({"lang_pred": model.languages[k], "score": float(share[k] / share.sum()) * min(1.0, sure), "spans": spans})
    return out


SCHEMA = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def language_id(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """docs with lang_pred, score and spans (code points); own columns of these names are replaced.

    Null texts and texts without a letter: und, score 0, no spans; so is all where the model knows no language. Repeated
    rows get the same result each; an empty table gives an empty table. The model sent to the executors has a fixed size.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.scores, model.allowed))

    def rows(column: pa.Array):
        return identify(Model(*sent.value), texts(column), switch)

    return map_rows(docs, [text], SCHEMA, rows)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(text, lang) of about rows documents with a language that aren't held out, evenly chosen by a hash for each
    language; rows / 2 more at most. The choice depends on the rows alone, not on their order."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & (F.length("text") <= chars))
    counts = [(r.lang, r.n) for r in docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("lang").agg(F.count("*").alias("n")).collect()]
    if not counts:
        return []
    each = max(1, rows // len(counts))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(math.ceil(1_000_000 * min(1.0, each / n)))) for lang, n in counts])
    return [(r.text, r.lang) for r in usable.filter(place < share).orderBy(place, "doc_id", F.xxhash64("text", "lang")).select("text", "lang").limit(rows * 3 // 2).collect()]


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs.select("doc_id", "text", "lang")))
    done = language_id(docs.select("doc_id", "text"), model)
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


QUERIES = {"op10_language_id": op10_language_id}
ORACLES: dict[str, str] = {}
