"""N-gram Jaccard join: candidates by MinHash bands, Bayesian pruning of pairs hash by hash, exact check of the rest.

Copies (equal shingle sets) are one node from the start. Candidate pairs never become rows: each node has a block, the
largest bucket of a band that it is in (large ones are split), and a node goes to the pairs of its block with those blocks
that one of its own buckets reaches. So a group compares nodes of two blocks of bounded size, a chain of texts costs as much
as its links, and only texts that really share a bucket all with all are compared all with all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import prepare, settle, table, texts

#: Words of a shingle, and the similarity of a link as a fraction.
WORDS, SIMILAR = 5, (4, 5)
#: 40 bands of 6 hashes: a pair at similarity 0.8 shares a band but for 5 in a million.
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
#: Hashes compared at a time, and the posterior probability of a link below which a pair is dropped.
STEP, TOLERANCE = 24, 1e-6
#: Nodes of a block, and shingles of all its nodes, about; a longer text is a block of its own.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
#: Bytes of text that are hashed together.
CHUNK = 1 << 20

_rng = np.random.default_rng(20240229)
_SYMBOL = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1
_PLACE = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_IN_BAND = _rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def shingle_sets(batch: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (64 bits) of each text.

    Words are what white space separates, in lower case. A text of 1 to 4 words has one shingle, of all its words; one
    without words has none.
    """
    out: list[np.ndarray] = []
    held, size = [], 0
    for text in batch:
        raw = text.lower().encode("utf-8", "replace")
        if held and size + len(raw) > CHUNK:
            out += _shingle_sets(held)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    return out + _shingle_sets(held) if held else out


def _shingle_sets(raws: list[bytes]) -> list[np.ndarray]:
    buf = np.frombuffer(b" " + b" ".join(raws) + b" ", np.uint8)
    n = len(buf)
    power, inverse = _powers(max(CHUNK * 2, 1 << n.bit_length()))
    word = ~_SPACE[buf]
    edges = np.diff(word.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_SYMBOL[buf] * power[:n])])
    words = _mix((total[ends] - total[starts]) * inverse[starts])
    first = np.cumsum([1, *(len(r) + 1 for r in raws)])
    at = np.searchsorted(starts, first)
    m = len(words) - WORDS + 1
    shingles = _mix(sum(words[k : k + m] * _PLACE[k] for k in range(WORDS))) if m > 0 else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(at, at[1:]):
        if b - a >= WORDS:
            out.append(np.unique(shingles[a : b - WORDS + 1]))
        elif b > a:
            own = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(_mix(np.array([own], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of a set that isn't empty."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 512):
        np.minimum(low, (shingles[k : k + 512, None] * _FACTOR + _SHIFT).min(0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    return _mix((rows * _IN_BAND).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


@lru_cache(maxsize=None)
def least_matches(n: int, similar: float = SIMILAR[0] / SIMILAR[1], tolerance: float = TOLERANCE) -> int:
    """The fewest of n equal MinHash values with which similarity still may reach similar, by a uniform prior."""
    x = (np.arange(20_000) + 0.5) / 20_000
    for m in range(n + 1):
        log = m * np.log(x) + (n - m) * np.log1p(-x)
        p = np.exp(log - log.max())
        if p[x >= similar].sum() / p.sum() >= tolerance:
            return m
    return n


def survivors(sig: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs left[i], right[i] that pruning leaves, MinHash values being compared STEP at a time."""
    num, den = SIMILAR
    small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
    ok = den * small >= num * large
    left, right = left[ok], right[ok]
    equal = np.zeros(len(left), np.int32)
    for at in range(0, HASHES, STEP):
        if not len(left):
            break
        equal += (sig[left, at : at + STEP] == sig[right, at : at + STEP]).sum(1, dtype=np.int32)
        ok = equal >= least_matches(at + STEP)
        left, right, equal = left[ok], right[ok], equal[ok]
    return left, right


def exact(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs have Jaccard similarity SIMILAR or more."""
    if not len(left):
        return np.zeros(0, bool)
    num, den = SIMILAR
    sizes = np.array([len(s) for s in sets])
    used = np.unique(np.concatenate([left, right]))
    if len(left) < 4 * len(used):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right)])
    else:
        # Many pairs among few documents: counts of common shingles are a product of incidence matrices.
        place = np.full(len(sets), -1)
        place[used] = np.arange(len(used))
        shingles, ids = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
        owner = np.repeat(np.arange(len(used)), sizes[used])
        order = np.argsort(ids, kind="stable")
        ids, owner = ids[order], owner[order]
        common = np.zeros((len(used), len(used)), np.float64)
        width = 1 << 14
        for lo in range(0, len(shingles), width):
            a, b = np.searchsorted(ids, [lo, lo + width])
            part = np.zeros((len(used), min(width, len(shingles) - lo)), np.float32)
            part[owner[a:b], ids[a:b] - lo] = 1
            common += part @ part.T
        both = common[place[left], place[right]].astype(np.int64)
    return den * both >= num * (sizes[left] + sizes[right] - both)


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(kind)))


#: What the steps in Python yield. doc_id and th, a hash of the text, name a text; node numbers a shingle set.
HASHED = "doc_id long, th long, set_key binary, n_shingles long, bands array<long>"
SHINGLED = "node long, weight long, pairs array<struct<i:long,j:long,block:long>>, shingles array<long>"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _hash_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(texts(batch.column(2)))
        keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        bands = [band_keys(signature(s)) if len(s) else np.zeros(0, np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), _lists(bands, np.int64)], _names(HASHED))


def _shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, weight, pairs, text) to (..., shingles); a repeated row gives none."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column(0).to_pylist()
        new = [n not in seen and not seen.add(n) for n in nodes]
        batch = batch.filter(pa.array(new, pa.bool_()))
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists(shingle_sets(texts(batch.column(3))), np.int64)], _names(SHINGLED))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (i, j), each with block: links of the pairs between blocks i and j, once each."""
    key, held, seen = None, [], set()
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(5)]
        lists = batch.column(5)
        flat, offsets = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
        for r, (i, j, block, node, weight) in enumerate(zip(*cols)):
            if (i, j) != key:
                if held:
                    yield _group(key, held)
                key, held, seen = (i, j), [], set()
            if node not in seen:
                seen.add(node)
                held.append((block, node, weight, flat[offsets[r] : offsets[r + 1]].copy()))
    if held:
        yield _group(key, held)


LINKS = "node long, n_links long, n_texts long, root long"


def _group(key: tuple, rows: list[tuple]) -> pa.RecordBatch:
    i, j = key
    blocks, nodes, weights = (np.array(c) for c in list(zip(*rows))[:3])
    sets = [r[3] for r in rows]
    sig, sizes = np.array([signature(s) for s in sets]), np.array([len(s) for s in sets])
    if i == j:
        left, right = np.triu_indices(len(rows), 1)
    else:
        a, b = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        left, right = np.repeat(a, len(b)), np.tile(b, len(a))
    left, right = survivors(sig, sizes, left, right)
    ok = exact(sets, left, right)
    left, right = left[ok], right[ok]
    n_links = np.bincount(left, weights[right], len(rows)) + np.bincount(right, weights[left], len(rows))
    n_texts = np.bincount(left, minlength=len(rows)) + np.bincount(right, minlength=len(rows))
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
    found = [(int(nodes[k]), int(n_links[k]), int(n_texts[k]), int(nodes[root(k)])) for k in range(len(rows)) if n_texts[k]]
    cols = list(zip(*found)) if found else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _names(LINKS))


def meetings(sets: DataFrame) -> DataFrame:
    """(node, pairs array<struct<i,j,block>>): the pairs of blocks to which nodes that share a bucket go.

    sets has node, n_shingles and bands. Two nodes in one bucket of a band meet in exactly one pair. Rows are linear in the
    nodes; a node's array has the blocks that its buckets reach, n / BLOCK of them where n nodes are all in one bucket.
    """
    keys = sets.select("node", "n_shingles", F.explode("bands").alias("band"))
    hubs = settle(keys.groupBy("band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("all")).filter("n > 1"), "hubs")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)).alias("parts")
    shared = settle(keys.join(hubs, "band").select("node", "band", "n", parts), "shared")
    home = F.max(F.struct("n", "band", "parts")).alias("home")
    block = F.xxhash64("home.band", F.pmod(F.xxhash64("node"), F.col("home.parts"))).alias("block")
    placed = settle(shared.groupBy("node").agg(home).select("node", block), "placed")

    # Of buckets that reach the same blocks (a dense group has 40 of them) one counts: a kind is a digest of their set.
    reached = settle(shared.join(placed, "node").select("band", "block").distinct(), "reached")
    kinds = settle(reached.groupBy("band").agg(F.bit_xor(F.xxhash64("block")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "block")).alias("y")), "kinds")
    blocks = reached.join(kinds, "band").groupBy("x", "y").agg(F.collect_set("block").alias("blocks"))
    own = shared.join(kinds, "band").select("node", "x", "y").distinct()
    met = own.join(blocks, ["x", "y"]).groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks")).join(placed, "node")
    pair = lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j"), F.col("block").alias("block"))
    return met.select("node", F.transform("blocks", pair).alias("pairs"))


def _linked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, th, first struct<doc_id,th>, n_links, n_text_links) of rows with a doc_id: first is the least text of the
    class, null for a text without shingles."""
    prepare(docs.sparkSession)
    real = docs.select(*_text_name(doc_id, text), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    hashed = settle(real.mapInArrow(_hash_documents, HASHED), "hashed")
    filled = hashed.filter("set_key IS NOT NULL")
    first = F.min(F.struct("doc_id", "th"))
    sets = filled.groupBy("set_key").agg(first.alias("first"), F.count("*").alias("weight"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"))
    # The numbers are written with the table, so every later read sees the same ones.
    sets = settle(sets.withColumn("node", F.monotonically_increasing_id()), "sets")

    going = sets.select("node", "weight", "first.*").join(meetings(sets), "node")
    payload = real.join(going.hint("shuffle_hash"), ["doc_id", "th"]).select("node", "weight", "pairs", "text").mapInArrow(_shingle, SHINGLED)
    dealt = payload.select(F.inline("pairs"), "node", "weight", "shingles")
    links = settle(dealt.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(_compare, LINKS), "links")

    classes = settle(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))), "classes")
    firsts = classes.join(sets.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("first"))
    counts = links.groupBy("node").agg(F.sum("n_links").alias("n_links"), F.sum("n_texts").alias("n_texts"))
    found = classes.join(firsts, "component").join(counts, "node").select("node", F.col("first").alias("of"), "n_links", "n_texts")
    per_set = sets.join(found, "node", "left").select(
        "set_key",
        F.coalesce("of", "first").alias("first"),
        (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).alias("n_text_links"),
    )
    none = F.lit(0).cast("long")
    alone = hashed.filter("set_key IS NULL").select("doc_id", "th", F.lit(None).cast("struct<doc_id:bigint,th:bigint>").alias("first"), none.alias("n_links"), none.alias("n_text_links"))
    return filled.select("doc_id", "th", "set_key").join(per_set, "set_key").drop("set_key").unionByName(alone)


def _text_name(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("th")]


def ngram_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links), a row for each row of docs.

    Documents are linked at Jaccard similarity 0.8 or more of their shingle sets. class_id: the least doc_id that links
    lead to; n_links: other rows that the document is linked with, copies included; n_text_links: other shingle sets.
    Null and empty texts have no shingles and no links, and are their own class; a null doc_id has class_id null and no
    links and takes no part. doc_id is long; rows that repeat it are rows like others: copies with the same text, texts of
    their own otherwise. An empty table gives an empty table. Further columns of docs are ignored.
    """
    none = F.lit(0).cast("long")
    nameless = docs.filter(F.col(doc_id).cast("long").isNull()).select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "class_id")], none.alias("n_links"), none.alias("n_text_links"))
    return _linked(docs, doc_id, text).select("doc_id", F.coalesce("first.doc_id", "doc_id").alias("class_id"), "n_links", "n_text_links").unionByName(nameless)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the least doc_id (of several texts with that id, the one of least hash).
    Texts without a word and rows without doc_id stay; of rows that repeat both doc_id and text one stays, the least by a
    hash of all columns."""
    named = docs.select("*", *[c.alias(n) for c, n in zip(_text_name("doc_id", "text"), ("__id", "__th"))])
    linked = _linked(docs, "doc_id", "text").filter("first IS NULL OR (first.doc_id = doc_id AND first.th = th)")
    stay = settle(linked.groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(F.count("*").alias("__n")), "stay")
    once = named.join(stay.filter("__n = 1"), ["__id", "__th"]).select(docs.columns)
    # Few texts, or copies of few rows: folded before the exchange.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = named.join(stay.filter("__n > 1"), ["__id", "__th"]).groupBy("__id", "__th").agg(F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")).select("row.*")
    return once.unionByName(again).unionByName(docs.filter(F.col("doc_id").cast("long").isNull()))


QUERIES = {"op8_ngram_jaccard_join": op8_ngram_jaccard_join}
ORACLES: dict[str, str] = {}
