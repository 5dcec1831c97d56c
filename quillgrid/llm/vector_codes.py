"""Vector code compression: codes of vector parts by codebooks, each entry found by VA-file filtering.

Entries of a part position are bit-quantised: each coordinate falls into one of CELLS cells of equal numbers of entries. For a
query, tables of the least and the greatest squared distance to each cell add up to bounds for every entry; entries whose
lower bound is above the least upper bound are out, and the rest are refined with integer distances. All is integers, so the
codes are those of a full comparison.

A round is one scan: tasks send sums and counts of the entries that they used, never vectors. What the driver holds is the
codebooks, of entries * size numbers, and nothing of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import prepare, settle, table
from .vectors import finite, matrix, small, usual_size

#: Parts of a vector, entries of a part position's codebook, rounds of training, and the factor before the floor.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Cells of a coordinate (4 bits), and queries that are filtered together.
CELLS, BLOCK = 16, 256


class Codebook:
    """The entries of one part position, as a vector-approximation file."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        self.cell = np.empty((width, n), np.intp)
        self.low, self.high = np.empty((width, CELLS), np.int64), np.empty((width, CELLS), np.int64)
        for d in range(width):
            order = np.argsort(entries[:, d], kind="stable")
            bounds = np.arange(CELLS + 1) * n // CELLS
            for c, (a, b) in enumerate(zip(bounds, bounds[1:])):
                self.cell[d, order[a:b]] = c
                # A cell without entries is never looked up.
                self.low[d, c], self.high[d, c] = (entries[order[a], d], entries[order[b - 1], d]) if a < b else (0, 0)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the first of its nearest entries, and the squared distance."""
        found = [self._nearest(queries[k : k + BLOCK]) for k in range(0, len(queries), BLOCK)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries x queries) lower and upper bounds of the squared distances."""
        width = self.entries.shape[1]
        reach = int(max(np.abs(queries).max(), np.abs(self.entries).max())) * 2
        kind = np.int32 if width * reach * reach < 1 << 31 else np.int64
        lower, upper = np.zeros((len(self.entries), len(queries)), kind), np.zeros((len(self.entries), len(queries)), kind)
        for d in range(width):
            below, above = self.low[d][:, None] - queries[:, d], queries[:, d] - self.high[d][:, None]
            gap, far = np.maximum(np.maximum(below, above), 0), np.maximum(-below, -above)
            lower += (gap * gap).astype(kind)[self.cell[d]]
            upper += (far * far).astype(kind)[self.cell[d]]
        return lower, upper

    def _nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lower, upper = self.bounds(queries)
        query, entry = np.nonzero((lower <= upper.min(0)).T)
        apart = queries[query] - self.entries[entry]
        distance = (apart * apart).sum(1)
        starts = np.searchsorted(query, np.arange(len(queries)))
        least = np.minimum.reduceat(distance, starts)
        hit = np.flatnonzero(distance == least[query])
        first = hit[np.searchsorted(query[hit], np.arange(len(queries)))]
        return entry[first], least


def _parts(column: pa.Array, size: int, scale: int, parts: int) -> np.ndarray:
    """(parts, rows, width) integers."""
    whole = np.floor(matrix(column, size).astype(np.float64) * scale).astype(np.int64)
    return whole.reshape(len(whole), parts, size // parts).transpose(1, 0, 2)


def _fit(usable: DataFrame, size: int, scale: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """(parts, entries, width) codebooks."""
    first = usable.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries)
    books = _parts(pa.array([r.vector for r in first.select("vector").collect()], pa.list_(pa.float64())), size, scale, parts)
    n, width = books.shape[1:]

    for _ in range(rounds):
        now = books

        def sums(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            indexes = [Codebook(b) for b in now]
            total, count = np.zeros(now.shape, np.int64), np.zeros((parts, n), np.int64)
            for batch in batches:
                if batch.num_rows:
                    for p, rows in enumerate(_parts(batch.column(0), size, scale, parts)):
                        code = indexes[p].nearest(rows)[0]
                        np.add.at(total[p], code, rows)
                        count[p] += np.bincount(code, minlength=n)
            used = np.flatnonzero(np.repeat(count.ravel(), width))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.ravel()[used]), pa.array(count.ravel()[used // width])], ["at", "total", "n"])

        found = usable.select("vector").mapInArrow(sums, "at long, total long, n long").groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        books = now.copy()
        if found:
            at, total, count = np.array(found, np.int64).T
            books.ravel()[at] = total // count
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row whose vector is finite.

    code: two hex digits for each part (entries is 256 at most). Codebooks start with the parts of the least vec_ids, of equal
    ones those with the least vectors, null last; fewer rows give fewer entries. The size of vectors is the most frequent one
    that can be cut into equal parts; a vector of another size, or one with a component of which floor(scale * x) is beyond
    2^24, has code and error null and takes no part in training. label_error is null where all errors of a label are. Without
    a label column all rows are of one label. Rows that repeat a vec_id are rows like others; rows with a null vector or a
    component that is null or not finite are dropped. An empty table gives an empty table. Further columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256: a code has two hex digits a part")
    prepare(rows.sparkSession)
    named = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), (F.col(label) if label else F.lit(None).cast("int")).alias("label")).filter(finite("vector"))
    size = usual_size(named.filter(small("vector", scale)), "vector", parts)
    fits = small("vector", scale) & (F.size("vector") == size)
    usable = named.filter(fits)
    books = _fit(usable, size, scale, parts, entries, rounds) if size else np.zeros((parts, 0, 0), np.int64)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [Codebook(b) for b in books]
        for batch in batches:
            if batch.num_rows:
                found = [indexes[p].nearest(part) for p, part in enumerate(_parts(batch.column(2), size, scale, parts))]
                code = np.stack([f[0] for f in found], 1).astype(np.uint8)
                text = [row.tobytes().hex() for row in code]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(text), pa.array(sum(f[1] for f in found))], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
    coded = usable.select("vec_id", "label", "vector").mapInArrow(codes, schema).unionByName(named.filter(~fits).select("vec_id", "label", *none))
    # Written once: both the sums and the join read it, and a label of many rows can be split in the join.
    coded = settle(coded, "coded")
    sums = settle(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "sums")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The rounds as SQL, by comparing all pairs of parts and entries."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "cut AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS q FROM kept, (SELECT unnest(range(4)) AS p))",
        """book0 AS MATERIALIZED (
  SELECT p, e, q AS b FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 256) USING (vec_id))""",
    ]
    distance = "list_sum(list_transform(list_zip(q, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(ROUNDS + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(label) AS label, any_value(q) AS q, min(d) AS d, min(e) FILTER (d = least) AS e
  FROM (SELECT *, min(d) OVER (PARTITION BY vec_id, p) AS least FROM (SELECT vec_id, label, cut.p, q, e, {distance} AS d FROM cut JOIN book{k} USING (p)))
  GROUP BY vec_id, p)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, b) AS b FROM book{k} LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m
    FROM (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(q) AS x, unnest(range(len(q))) AS i FROM near{k}) GROUP BY p, e, i)
    GROUP BY p, e) USING (p, e))"""
            )
    steps.append(f"coded AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id)")
    steps.append(f"named AS (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, named"


QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLES: dict[str, str] = {"op12_vector_codes": _oracle()}
