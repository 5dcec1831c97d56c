"""Best-fit packing: bounded-space online best-fit over token pieces; the fullest open bin closes first."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import prepare, table, texts

CAPACITY, END_ID = 1024, 2
#: Bins that are open at a time, and pieces that arrive together (longest first); both bound a task's memory.
OPEN_BINS, ARRIVALS = 4096, 8192
#: Sequence numbers of one task: its partition's number stands above these bits.
TASK_BITS = 40


class BestFit:
    """Open bins, in a bitset keyed by free space: bit f says that some open bin has f places left."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.count, self.made = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        found = self.at[free].pop()
        if not self.at[free]:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to capacity tokens."""
        if fits := self.bits >> length:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            if self.count >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            found, free = self.made, self.capacity
            self.made += 1
        if left := free - length:
            self.at[left].append(found)
            self.bits |= 1 << left
            self.count += 1
        return found, self.capacity - free


_ENCODINGS: dict[tuple[int, int, str], tiktoken.Encoding] = {}


def encoding(ranks_file: bytes, pattern: str) -> tiktoken.Encoding:
    key = (len(ranks_file), zlib.crc32(ranks_file), pattern)
    if key not in _ENCODINGS:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks_file.splitlines() if x)}
        _ENCODINGS[key] = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


#: White space (Unicode's), of which a long run overflows the stack of the library's pattern.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{20000,}")


def ids_of(own: tiktoken.Encoding, text: str) -> list[int]:
    """The text's ids. By the pattern a run of white space, but for its last character where more text follows, is one
    match; long runs are encoded apart as that, and the pattern sees what is left."""
    out, at = [], 0
    for m in BLANKS.finditer(text):
        end = m.end() - (m.end() < len(text))
        out += own.encode_ordinary(text[at : m.start()])
        out += own._encode_single_piece(text[m.start() : end])
        at = end
    return out + own.encode_ordinary(text[at:]) if at else own.encode_ordinary(text)


PIECES = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False, short_first: bool = False) -> DataFrame:
    """A row for each piece of a document's ids (the text's, then end_id), with docs' other columns; the text goes.

    Only documents of more than capacity tokens are cut, every capacity tokens; the last piece may be shorter, or, with
    short_first, the first one. keep_ids adds ids array<int>. Null and
    empty texts are the one token end_id; repeated rows are each cut; an empty table gives no pieces. Columns of docs
    that clash with the new ones are replaced. The vocabulary file is sent to the executors, under 2 MB.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    new = PIECES + (", ids array<int>" if keep_ids else "")
    added = T._parse_datatype_string(new)
    kept = docs.drop(text, *added.names)
    names = [*kept.columns, *added.names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(ranks.value, pattern)
        for batch in batches:
            row, piece, start, length, crc, ids_out = [], [], [], [], [], []
            for i, text in enumerate(texts(batch.column(batch.num_columns - 1))):
                ids = np.array([*ids_of(own, text), end_id], "<u4")
                over = len(ids) % capacity if short_first else 0
                bounds = [*([0] if over else []), *range(over, len(ids), capacity), len(ids)]
                for k, (s, end) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[s:end]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        ids_out.append(part.astype(np.int32))
            rest = batch.select(list(range(batch.num_columns - 1))).take(pa.array(row, pa.int64())) if batch.num_columns > 1 else None
            cols = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if keep_ids:
                cols.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*(rest.columns if rest is not None else []), *cols], names)

    return source.mapInArrow(run, T.StructType([*kept.schema.fields, *added.fields]))


def best_fit(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, open_bins: int = OPEN_BINS, arrivals: int = ARRIVALS) -> DataFrame:
    """pieces with sequence_id long and offset long: no sequence holds more than capacity, and its pieces lie gapless.

    Rows are dealt out evenly by arrival, whatever their columns hold; each task packs its share, so all it costs beyond a
    single packer are its last open bins. Within a task the pieces come in a fixed order, so a task that runs again packs
    alike. Lengths of 0 or null and above capacity raise ValueError. Clashing columns are replaced.
    """
    prepare(pieces.sparkSession)
    kept = pieces.drop("sequence_id", "offset")
    where = kept.columns.index(length)
    names = [*kept.columns, "sequence_id", "offset"]
    dealt = kept.withColumn("__arrival", F.xxhash64(F.monotonically_increasing_id())).repartition("__arrival").sortWithinPartitions("__arrival")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = BestFit(capacity, open_bins), TaskContext.get().partitionId() << TASK_BITS

        def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()
            for batch in rows:
                lengths = batch.column(where).to_pylist()
                if not all(x and 0 < x <= capacity for x in lengths):
                    raise ValueError(f"a piece must have 1 to {capacity} tokens")
                bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
                for i in np.argsort(-np.asarray(lengths), kind="stable").tolist():
                    bins[i], offsets[i] = packer.put(lengths[i])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bins + first), pa.array(offsets)], names)

        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, arrivals):
                part = batch.slice(at, arrivals)
                held.append(part)
                n += part.num_rows
                if n >= arrivals:
                    yield from pack(held)
                    held, n = [], 0
        if n:
            yield from pack(held)

    return dealt.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: sequence_id, tokens array<int>, pieces; for pieces made with keep_ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    return packed.groupBy("sequence_id").agg(ordered.alias("__p")).select("sequence_id", F.flatten(F.transform("__p", lambda x: x["ids"])).alias("tokens"), F.size("__p").alias("pieces"))


RESULT = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, short_first: bool = False) -> DataFrame:
    import public_tokenizers as tokenizers

    return best_fit(token_pieces(docs.select("doc_id", "text"), tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, short_first=short_first)).select(*RESULT)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), short_first=True)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
ORACLES: dict[str, str] = {}
