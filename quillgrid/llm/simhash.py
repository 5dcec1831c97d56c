"""SimHash near-dedup: fingerprints of word shingles, linked at a Hamming distance of RADIUS or less.

Two fingerprints that differ in at most 2 bits agree in at least 2 of 4 blocks of 16 bits, so every fingerprint goes to 6
buckets, one for each pair of blocks, and each link is found in one of them: nothing is lost and nothing grows with the
square of the table. Buckets of over SMALL fingerprints are dealt once more, by 2 of 4 blocks of the 32 bits that are still
free; 16 bits remain then, so that no group has more than 65,536 members. Within a group, tiles in the order of their
population counts are compared by exclusive-or and bit count; tiles whose population counts differ by more than the radius
are never compared. Groups give a forest of links, not all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import prepare, settle, table, utf8

#: Words of a shingle, the seed of its hash, and the bits in which linked fingerprints may differ.
WORDS, SEED, RADIUS = 3, 42, 2
#: Fingerprints of a bucket that are compared as one group, and of a tile.
SMALL, TILE = 4096, 512
#: Bytes of a text whose words are held at a time.
CHUNK = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _words(raw: bytes) -> Iterator[list[bytes]]:
    """The words of raw in lower case, about CHUNK bytes at a time."""
    at = 0
    while at < len(raw):
        found = _SPACE.search(raw, at + CHUNK)
        end = found.start() if found else len(raw)
        yield raw[at:end].lower().split()
        at = end


def _hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of the shingles of words, of which there are at least WORDS."""
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends[: len(words) - WORDS])]
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :])), np.uint64, len(starts))


def fingerprint(raw: bytes) -> int:
    """The SimHash of a UTF-8 text: bit k is set if it is in over half of the shingles' hashes; 0 without words."""
    counts, n, held = np.zeros(64, np.int64), 0, []
    for words in _words(raw):
        held += words
        if len(held) >= WORDS:
            hashes = _hashes(held)
            for k in range(0, len(hashes), 1 << 16):
                counts += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
            n += len(hashes)
            held = held[1 - WORDS :]
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(held), SEED) if held else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(raw) for raw in utf8(batch.column(1))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in the order of their population counts, and for each the place of the first one that links
    within the group lead to."""
    pops = np.bitwise_count(fps)
    order = np.argsort(pops, kind="stable")
    fps, pops = fps[order], pops[order].astype(np.int64)
    label = np.arange(len(fps))
    for a in range(0, len(fps), TILE):
        last = pops[min(a + TILE, len(fps)) - 1]
        for b in range(a, len(fps), TILE):
            if pops[b] - last > RADIUS:
                break
            left, right = np.nonzero(np.bitwise_count(fps[a : a + TILE, None] ^ fps[None, b : b + TILE]) <= RADIUS)
            _merge(label, left + a, right + b)
    return fps, label


def _merge(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Bring links into label, whose entries are places of roots before and after."""
    while True:
        low, high = np.minimum(label[left], label[right]), np.maximum(label[left], label[right])
        apart = low != high
        if not apart.any():
            return
        left, right = left[apart], right[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, part, fp) sorted by bucket and part: links (a, b) of each group's forest."""
    key, held = None, []

    def links() -> Iterator[pa.RecordBatch]:
        fps = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        if len(fps) > 1:
            fps, label = forest(fps)
            on = np.flatnonzero(label != np.arange(len(fps)))
            if len(on):
                yield pa.RecordBatch.from_arrays([pa.array(fps[on].view(np.int64)), pa.array(fps[label[on]].view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, part, fps = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        new = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
        for start, end in zip([0, *new], [*new, len(fps)]):
            if (bucket[start], part[start]) != key:
                yield from links()
                key, held = (bucket[start], part[start]), []
            held.append(fps[start:end].view(np.uint64).copy())
    yield from links()


def _block(fp: str, k: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, k * width).bitwiseAND((1 << width) - 1)


def buckets(fps: DataFrame) -> DataFrame:
    """(bucket, part, fp): the groups of distinct fingerprints that hold every link; buckets of one are left out."""
    keys = [F.lit(n << 32).bitwiseOR(F.shiftleft(_block("fp", i, 16), 16)).bitwiseOR(_block("fp", j, 16)) for n, (i, j) in enumerate(combinations(range(4), 2))]
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    sizes = settle(dealt.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    met = dealt.join(sizes, "bucket")
    parts = []
    for n, agreed in enumerate(combinations(range(4), 2)):
        free = [k for k in range(4) if k not in agreed]
        rest = F.shiftleft(_block("fp", free[0], 16), 16).bitwiseOR(_block("fp", free[1], 16))
        again = [F.lit(m << 16).bitwiseOR(F.shiftleft(F.shiftrightunsigned(rest, 8 * i).bitwiseAND(255), 8)).bitwiseOR(F.shiftrightunsigned(rest, 8 * j).bitwiseAND(255)) for m, (i, j) in enumerate(combinations(range(4), 2))]
        parts.append(F.when(F.shiftrightunsigned("bucket", 32) == n, F.array(*again)))
    small = F.array(F.lit(-1).cast("long"))
    return met.select("bucket", F.explode(F.when(F.col("n") <= SMALL, small).otherwise(F.coalesce(*parts))).alias("part"), "fp")


def simhash_near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of docs.

    Words are what the six ASCII white-space characters separate, A-Z in lower case; a text of one or two words has one
    shingle, of all of them, and a null or empty text has fingerprint zero, which is linked like any other. component_id is
    the least doc_id that links lead to. doc_id is long; rows that repeat it are rows like others; a row whose doc_id is null
    has the least doc_id of its component, null where there is none. An empty table gives an empty table. Further columns of
    docs are ignored.
    """
    prepare(docs.sparkSession)
    hashed = settle(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long"), "hashed")
    classes = settle(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    groups = buckets(classes.select("fp"))
    links = settle(groups.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_link, "a long, b long"), "links")
    found = settle(components(links).select(F.col("node").alias("fp"), "component"), "found")
    least = found.join(classes, "fp").groupBy("component").agg(F.min("first").alias("least"))
    named = settle(classes.join(found.join(least, "component"), "fp", "left").select("fp", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id")), "named")
    return hashed.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op11_simhash_near_dedup": op11_simhash_near_dedup}
ORACLES: dict[str, str] = {}
