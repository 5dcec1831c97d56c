"""Byte-level BPE as a monoid: halves are encoded apart and joined over a boundary window.

A token list is the encoding of its bytes exactly if each two neighbours are the encoding of their joined bytes (true
where each token encodes to itself). So a join re-encodes a window around the boundary, and grows it on a side until the
token next to the window and the window's outer token are such neighbours: nothing outside can change any more.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import prepare, table, texts

#: Bytes up to which a piece is a leaf of its tree, and pieces or tokens up to which a stretch is one of a text's tree.
LEAF, STRETCH = 16, 256
#: Pieces and pairs that a worker remembers; beyond that it forgets all and starts anew.
REMEMBERED = 200_000


def product(items: list, leaf: Callable, join: Callable):
    """The product of a monoid over items: halves apart, then joined; at most STRETCH items are a leaf."""
    if len(items) <= STRETCH:
        return leaf(items)
    half = len(items) // 2
    return join(product(items[:half], leaf, join), product(items[half:], leaf, join))


class Codec:
    """Encoder and decoder for the ranks of one vocabulary file (base64 token, blank, rank; one a line)."""

    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.matches = regex.compile(pattern).findall
        self._pieces: dict[str, list[int]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    def leaf(self, piece: bytes) -> list[int]:
        """Merge the neighbours of least rank, leftmost first, until none is left."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        keys = [ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while keys:
            low = min(keys)
            if low == 1 << 30:
                break
            i = keys.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del keys[i]
            if i:
                keys[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
            if i < len(keys):
                keys[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
        return [ranks[p] for p in parts]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether a, b is the encoding of its bytes."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            found = self._pairs[a, b] = self.leaf(self.tokens[a] + self.tokens[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            window = self.leaf(self._bytes(left[-i:] + right[:j]))
            settled_left = i >= len(left) or self.neighbours(left[-i - 1], window[0])
            settled_right = j >= len(right) or self.neighbours(window[-1], right[j])
            if settled_left and settled_right:
                return left[: len(left) - i] + window + right[j:]
            i = i if settled_left else min(len(left), 2 * i)
            j = j if settled_right else min(len(right), 2 * j)

    def piece(self, piece: bytes) -> list[int]:
        """Encode one match of the pattern: halves, then a join."""
        if len(piece) <= LEAF:
            return self.leaf(piece)
        half = len(piece) // 2
        return self.join(self.piece(piece[:half]), self.piece(piece[half:]))

    def encode(self, text: str) -> list[int]:
        """Halves of the text's matches apart. Matches of the pattern never merge with each other, so that the boundary
        window of a join between two of them is empty."""
        return product(self.matches(text), self._stretch, list.__add__)

    def _stretch(self, matches: list[str]) -> list[int]:
        known, out = self._pieces, []
        extend = out.extend
        for match in matches:
            ids = known.get(match)
            if ids is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = self.piece(match.encode("utf-8", "replace"))
                if len(match) <= 64:
                    known[match] = ids
            extend(ids)
        return out

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        """Concatenation up the tree."""
        return product(ids, self._bytes, bytes.__add__)


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(ranks_file: bytes, pattern: str) -> Codec:
    key = (hashlib.sha256(ranks_file).hexdigest(), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks_file, pattern)
    return _CODECS[key]


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with ids array<int> and decoded binary (the bytes of the ids), which replace own columns of these names.

    The vocabulary file is read on the driver and sent to the executors, under 2 MB. Null and empty texts have no ids;
    repeated rows get the same ids each; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    kept = docs.drop("ids", "decoded")
    names = kept.columns
    source = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            ids = [own.encode(t) for t in texts(batch.column(batch.num_columns - 1))]
            lists = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array([own.decode(x) for x in ids], pa.binary())], [*names, "ids", "decoded"])

    return source.mapInArrow(run, kept.withColumn("ids", F.array().cast("array<int>")).withColumn("decoded", F.lit(b"")).schema)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe_round_trip(docs, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op3_bpe": op3_bpe}
ORACLES: dict[str, str] = {}
