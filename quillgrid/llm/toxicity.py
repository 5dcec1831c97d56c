"""Toxicity: a linear-chain conditional random field tags toxic spans; its marginals give scores and offsets.

Labels are of documents, so tokens are labelled first: a token of a toxic document is toxic if its word, or a prefix of
it, is far likelier in toxic documents than in clean ones. The field learns from windows around such tokens and from
windows of clean documents; a logistic function of the marginals, fitted on the labelled documents, is the score.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_rows, settle, table, texts

WORD = re.compile(r"[^\W\d_]+")
#: Rows of each label in the training sample, and code points up to which a text may be in it: the sample's bounds.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 20_000
#: Lengths of prefixes that are features.
PREFIXES = (4, 5, 6, 7, 8)
#: Toxic documents that must have a feature, and how much likelier it must be in them, for it to mark tokens as toxic.
LEAST_DOCS, LEAST_LOG_ODDS = 6, 1.5
#: Tokens of a training window, and how many of a document's tokens with a feature, the first ones, get a window.
WINDOW, WINDOWED = 24, 8
#: Runs of tokens without a feature are folded to what is alike but for this share (see Model.edge).
ALIKE = 2.0**-60
#: Parts in which the sample comes to the driver.
PARTS = 16
#: Training windows that are in floating point at a time.
BLOCK = 4096
#: A worker forgets words beyond so many.
REMEMBERED = 200_000


@dataclass
class Model:
    """weights: feature to index into emission; transition[a, b]: from a to b; document: of (1, max, log count, share)."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    transition: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    document: tuple[float, ...] = (-4.0, 4.0, 0.0, 0.0)

    def __post_init__(self):
        self._known: dict[str, float | None] = {}
        self._edge = self.edge()

    def edge(self) -> int:
        """Tokens without a feature after which the passes don't depend on what came before, but for ALIKE.

        The odds of the two states go through x -> e (t01 + t11 x) / (t00 + t10 x) at each such token (backward: the like
        with t01 and t10 in other places). This map has an attracting fixed point p > 0 and a repelling one q < 0, and
        w = (x - p) / (x - q) shrinks by the same factor each time. |w| is at most max(1, p / -q) for odds x >= 0.
        """
        (t00, t01), (t10, t11) = ((math.exp(x) for x in row) for row in self.transition)
        e = math.exp(self.bias)
        steps = 1
        for a, b, c, d in ((e * t01, e * t11, t00, t10), (t10, e * t11, t00, e * t01)):  # x -> (a + b x) / (c + d x)
            root = math.sqrt((c - b) ** 2 + 4 * a * d)
            # Of a quadratic's two roots the stable form gives one, their product -a / d the other.
            far = (b - c + root) / (2 * d) if b >= c else (b - c - root) / (2 * d)
            p, q = max(far, -a / d / far), min(far, -a / d / far)
            factor = abs(b * c - a * d) / (c + d * p) ** 2
            if factor >= 1 - 1e-12:
                return 1 << 60
            if factor > 0:
                steps = max(steps, math.ceil(math.log(ALIKE / max(1.0, -p / q)) / math.log(factor)) + 1)
        return steps

    def emission(self, word: str) -> float | None:
        """What a word adds to the score of the toxic state; None without a feature."""
        found = self._known.get(word, self)
        if found is self:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            own = [self.weights[f] for f in features(word) if f in self.weights]
            found = self._known[word] = sum(own) if own else None
        return found

    def marginals(self, scores: list[float]) -> list[float]:
        """Probability of the toxic state at each token, by forward and backward passes; scores: bias and emission."""
        (t00, t01), (t10, t11) = ((math.exp(x) for x in row) for row in self.transition)
        e = [math.exp(s) for s in scores]
        forward, a, b = [], 0.5, 0.5
        for k, x in enumerate(e):
            na, nb = (a * t00 + b * t10, (a * t01 + b * t11) * x) if k else (1.0, x)
            z = na + nb
            a, b = na / z, nb / z
            forward.append((a, b))
        out = [0.0] * len(e)
        ba, bb = 1.0, 1.0
        for k in range(len(e) - 1, -1, -1):
            fa, fb = forward[k]
            pa_, pb = fa * ba, fb * bb
            out[k] = pb / (pa_ + pb)
            na, nb = t00 * ba + t01 * e[k] * bb, t10 * ba + t11 * e[k] * bb
            z = na + nb
            ba, bb = na / z, nb / z
        return out

    def tag(self, emissions: list[float | None]) -> tuple[list[tuple[int, float]], float, float]:
        """((position, marginal) of tokens, expected toxic tokens among those with a feature, largest marginal).

        Long runs without a feature are left out but for their ends and one token between: inside, the marginals are alike.
        How long the ends are follows from the field's own transitions, so that a sticky field folds less or nothing.
        """
        n, edge = len(emissions), self._edge
        if not n:
            return [], 0.0, 0.0
        at = [i for i, x in enumerate(emissions) if x is not None]
        keep: list[int] = []
        for lo, hi in zip([-1, *at], [*at, n]):
            run = range(lo + 1, hi)
            keep += [*run[:edge], run[len(run) // 2], *run[-edge:]] if len(run) > 2 * edge + 1 else run
            if hi < n:
                keep.append(hi)
        p = self.marginals([self.bias + (emissions[i] or 0.0) for i in keep])
        return list(zip(keep, p)), sum(x for i, x in zip(keep, p) if emissions[i] is not None), max(p)

    def score(self, n: int, expected: float, largest: float) -> float:
        x = (1.0, largest, math.log1p(expected), expected / n if n else 0.0)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(a * b for a, b in zip(self.document, x))))))


def features(word: str) -> list[str]:
    """The word itself, and its prefixes."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def _rng(seed: str) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.sha256(seed.encode()).digest()[:8], "big"))


def fit(rows: Iterable[tuple[str, int]]) -> Model:
    """A model of (text, 0 or 1) rows; equal rows count once, as copies say nothing new.

    The document score is fitted on marginals of a field that hasn't seen the document (two folds). Without rows of both
    labels the model scores every text with the label's share.
    """
    return _fit(*encoded(sorted({(t or "", int(y)) for t, y in rows})))


def encoded(rows: Iterable[tuple[str, int]]) -> tuple[list[tuple[np.ndarray, int]], list[str]]:
    """(words as numbers, label) of each row, and the word of each number: four bytes for a token, and no texts are kept."""
    number: dict[str, int] = {}
    docs = [(np.fromiter((number.setdefault(w.lower(), len(number)) for w in WORD.findall(t)), np.int32), y) for t, y in rows]
    return docs, list(number)


def _fit(docs: list[tuple[np.ndarray, int]], names: list[str]) -> Model:
    n = Counter(y for _, y in docs)
    if not n[0] or not n[1]:
        share = (n[1] + 0.5) / (n[0] + n[1] + 1)
        return Model(document=(math.log(share / (1 - share)), 0.0, 0.0, 0.0))
    folds = [docs[k::2] for k in (0, 1)]
    seen = []
    for train, test in (folds, folds[::-1]):
        model = _field(train, names)
        emission = list(map(model.emission, names))
        for words, label in test:
            _, expected, largest = model.tag([emission[w] for w in words.tolist()])
            seen.append((1.0, largest, math.log1p(expected), expected / len(words) if len(words) else 0.0, label))
    model = _field(docs, names)
    return Model(model.weights, model.bias, model.transition, _logistic(np.array(seen)))


def _field(docs: list[tuple[np.ndarray, int]], names: list[str]) -> Model:
    """The random field of (numbers of words, label) documents, without a document score."""
    n = Counter(y for _, y in docs)
    held: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for words, y in docs:
        held[y].update({f for w in np.unique(words).tolist() for f in features(names[w])})

    def odds(f: str) -> float:
        return math.log((held[1][f] + 0.5) / (n[1] + 1)) - math.log((held[0][f] + 0.5) / (n[0] + 1))

    chosen = [f for f, c in held[1].items() if c >= LEAST_DOCS and odds(f) >= LEAST_LOG_ODDS]
    index = {f: i + 1 for i, f in enumerate(sorted(chosen))}
    theta, bias, trans = _train(*_windows(docs, names, index), len(index) + 1)
    return Model({f: float(theta[i]) for f, i in index.items()}, float(bias), tuple(tuple(map(float, r)) for r in trans))


def _windows(docs: list[tuple[np.ndarray, int]], names: list[str], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token kinds (windows, tokens) with 0 for no feature and -1 past the end, token labels, and each kind's features
    (0 for none)."""
    rng = _rng("windows")
    kinds: dict[tuple[int, ...], int] = {(): 0}
    known = np.array([kinds.setdefault(tuple(index[f] for f in features(w) if f in index), len(kinds)) for w in names], np.int32)
    xs, ys = [], []
    for words, label in docs:
        ids = known[words]
        at = np.flatnonzero(ids)
        starts = {max(0, i - int(rng.integers(0, WINDOW))) for i in rng.permutation(at)[:WINDOWED].tolist()} or {int(rng.integers(0, max(1, len(words) - WINDOW)))}
        for s in sorted(starts):
            x, y = np.full(WINDOW, -1, np.int32), np.zeros(WINDOW, np.int8)
            part = ids[s : s + WINDOW]
            x[: len(part)] = part
            y[: len(part)] = (part > 0) & (label == 1)
            xs.append(x)
            ys.append(y)
    of = np.zeros((len(kinds), 1 + len(PREFIXES)), np.int32)
    for fs, k in kinds.items():
        of[k, : len(fs)] = fs
    return np.array(xs), np.array(ys), of


def _train(x: np.ndarray, y: np.ndarray, of: np.ndarray, n_features: int, steps: int = 100, rate: float = 0.2, decay: float = 1e-3):
    """Adam on the field's conditional log-likelihood, with forward-backward over all windows at once."""
    theta = np.zeros(n_features + 5)  # features, bias, transitions 00 01 10 11
    theta[n_features] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(x)
    for step in range(1, steps + 1):
        grad = sum(_gradient(theta, x[k : k + BLOCK], y[k : k + BLOCK], of, n_features) for k in range(0, n, BLOCK))
        grad = grad / n - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return np.concatenate([[0.0], theta[1:n_features]]), theta[n_features], theta[n_features + 1 :].reshape(2, 2)


def _gradient(theta: np.ndarray, x: np.ndarray, y: np.ndarray, of: np.ndarray, n_features: int) -> np.ndarray:
    """Of the log-likelihood of some windows."""
    length = x.shape[1]
    on, label, kind = (x >= 0).T.copy(), y.T.astype(float), np.maximum(x, 0)
    w = np.concatenate([[0.0], theta[1:n_features]])
    score = w[of].sum(1)[kind] + theta[n_features]
    (t00, t01), (t10, t11) = np.exp(theta[n_features + 1 :].reshape(2, 2))
    e = np.exp(np.clip(score, -30, 30)).T.copy()  # token by window
    # Forward and backward passes, scaled to sum 1 at each token; past the end nothing changes.
    f0, f1, b0, b1 = np.empty_like(e), np.empty_like(e), np.ones_like(e), np.ones_like(e)
    f0[0], f1[0] = 1 / (1 + e[0]), e[0] / (1 + e[0])
    for t in range(1, length):
        x0, x1 = f0[t - 1] * t00 + f1[t - 1] * t10, (f0[t - 1] * t01 + f1[t - 1] * t11) * e[t]
        z = x0 + x1
        f0[t], f1[t] = np.where(on[t], x0 / z, f0[t - 1]), np.where(on[t], x1 / z, f1[t - 1])
    for t in range(length - 2, -1, -1):
        x0, x1 = t00 * b0[t + 1] + t01 * e[t + 1] * b1[t + 1], t10 * b0[t + 1] + t11 * e[t + 1] * b1[t + 1]
        z = x0 + x1
        b0[t], b1[t] = np.where(on[t + 1], x0 / z, b0[t + 1]), np.where(on[t + 1], x1 / z, b1[t + 1])
    p1 = f1 * b1 / (f0 * b0 + f1 * b1)
    error = np.where(on, label - p1, 0.0)
    grad = np.zeros_like(theta)
    by_kind = np.bincount(kind.T.ravel(), error.ravel(), len(of))
    grad[:n_features] = np.bincount(of.ravel(), np.repeat(by_kind, of.shape[1]), n_features)
    grad[0] = 0.0
    grad[n_features] = error.sum()
    pairs = [f0[:-1] * t00 * b0[1:], f0[:-1] * t01 * e[1:] * b1[1:], f1[:-1] * t10 * b0[1:], f1[:-1] * t11 * e[1:] * b1[1:]]
    z = pairs[0] + pairs[1] + pairs[2] + pairs[3]
    seen = [((label[:-1] == a) & (label[1:] == b) & on[1:]).sum() for a in (0, 1) for b in (0, 1)]
    grad[n_features + 1 :] = [of_labels - (p / z)[on[1:]].sum() for of_labels, p in zip(seen, pairs)]
    return grad


def _logistic(seen: np.ndarray, steps: int = 40, ridge: float = 1e-2) -> tuple[float, ...]:
    x, y = seen[:, :-1], seen[:, -1]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return tuple(map(float, w))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """The rows of training_frame."""
    found = training_frame(docs, labels, rows, chars)
    return [(r.text, int(r.toxic)) for r in found.collect()] if found is not None else []


def training_frame(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame | None:
    """(text, toxic) of at most rows labelled documents of each label that aren't held out, evenly chosen by a hash. The
    choice depends on the rows alone, not on their order.

    Rows of one doc_id count as toxic if one of them says so; null labels and ids are left out.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {int(r.toxic): r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    some = [usable.filter((F.col("toxic") == y) & (place < math.ceil(1_000_000 * min(1.0, rows / n)))).orderBy(place, "doc_id").limit(rows) for y, n in sorted(counts.items()) if y in (0, 1)]
    if not some:
        return None
    chosen = some[0]
    for other in some[1:]:
        chosen = chosen.unionByName(other)
    # At most 2 * rows ids: bounded, whatever the tables hold.
    found = docs.select("doc_id", "text").filter(F.length("text") <= chars).join(F.broadcast(chosen), "doc_id")
    return found.orderBy(place, "doc_id", F.xxhash64("text")).select("text", "toxic").limit(2 * rows)


SCHEMA = "score double, predicted int, offsets array<struct<start:int,end:int,p:double>>"


def score_text(model: Model, text: str, least: float = 0.5) -> dict:
    words = words_of(text)
    emissions = [model.emission(w) for w in words]
    tagged, expected, largest = model.tag(emissions)
    offsets = []
    if largest >= least:
        places = [m.span() for m in WORD.finditer(text)]
        before = -2
        for k, (i, p) in enumerate(tagged):  # tokens that are folded between two of these are like both
            if p < least:
                continue
            start, end = places[i]
            if k == before + 1:
                offsets[-1] |= {"end": end, "p": max(p, offsets[-1]["p"])}
            else:
                offsets.append({"start": start, "end": end, "p": p})
            before = k
    score = model.score(len(words), expected, largest)
    return {"score": score, "predicted": int(score >= 0.5), "offsets": offsets}


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score, predicted and offsets (code points of toxic spans); own columns of these names are replaced.

    The model is sent to the executors; its size is bounded by the training sample. Null and empty texts get the score of
    a text without tokens; repeated rows get the same score each; an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.transition, model.document))

    def rows(column: pa.Array):
        own = _model(sent.value)
        return [score_text(own, t) for t in texts(column)]

    return map_rows(docs, [text], SCHEMA, rows)


_MODELS: dict[int, tuple[tuple, Model]] = {}


def _model(parts: tuple) -> Model:
    """One Model for each broadcast value of a worker, with what it remembers."""
    if id(parts) not in _MODELS or _MODELS[id(parts)][0] is not parts:
        _MODELS.clear()
        _MODELS[id(parts)] = (parts, Model(*parts))
    return _MODELS[id(parts)][1]


def fitted(spark: SparkSession, sf_dir: str) -> Model:
    """The model of training_frame's rows, as fit of training_rows gives it. The rows come to the driver part by part, in fit's
    order, and only numbers of words stay there."""
    found = training_frame(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    if found is None:
        return fit([])
    rows = settle(found.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")), "sample").distinct()
    return _fit(*encoded((r.text, r.toxic) for r in rows.repartitionByRange(PARTS, "text", "toxic").sortWithinPartitions("text", "toxic").toLocalIterator()))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = toxicity(docs, fitted(spark, sf_dir))
    return done.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.size("offsets").alias("n_spans"))


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic; the model learns from the labelled documents of the whole table."""
    rows = docs.select(F.struct("*").alias("__row"), F.col("text"))
    return toxicity(rows, fitted(spark, sf_dir)).filter("predicted = 0").select("__row.*")


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
