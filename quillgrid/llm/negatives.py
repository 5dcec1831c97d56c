"""Hard-negative mining over a vector-approximation file.

Each component is quantised into one of CELLS cells, whose edges are quantiles of a bounded sample; the file has a byte of cell
number for each component beside the integer vector. For an anchor, two tables give the least and the greatest product of its
component with every cell, so that sums of table entries bound its score with a row. Only rows whose bounds may enter the
first places, or the window of a positive, are scored exactly, in integers.

Anchors and rows meet in a grid: an anchor goes to its strip of anchors times all strips of rows, a row to its strip of rows
times all strips of anchors, and a task streams the rows of a grid cell past at most a few thousand anchors. What leaves a
grid cell is the first places of each anchor. The work is that of the query set against all rows; no task holds the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import prepare, settle, table
from .vectors import finite, matrix, small, usual_size

#: Factor before the floor, positives of an anchor, negatives of a positive.
SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score, times 100, lies between these multiples of the positive's.
WINDOW = (50, 95)
#: Cells of a component, and rows of the sample that their edges are taken from.
CELLS, SAMPLE_ROWS = 64, 4096
#: Anchors and rows of a grid cell, about; anchors whose bounds are computed together.
ANCHORS, ROWS, TILE = 1024, 1 << 16, 256


class Cells:
    """Edges of the cells: component x is in cell c where edges[c] <= x < edges[c + 1]."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray):
        inner = np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0, method="lower").astype(np.int64)
        self.edges = np.sort(np.vstack([low, np.clip(inner, low, high), high + 1]), axis=0)

    def of(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(self.edges[1:-1, d], rows[:, d], side="right") for d in range(rows.shape[1])], 1).astype(np.uint8)

    def products(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest products, by (component, cell, anchor)."""
        first, last = self.edges[:-1], np.maximum(self.edges[1:] - 1, self.edges[:-1])
        a, b = first.T[:, :, None] * anchors.T[:, None, :], last.T[:, :, None] * anchors.T[:, None, :]
        reach = np.abs(self.edges).max(1).max() * np.abs(anchors).sum(1).max(initial=0)
        kind = np.int32 if reach < 1 << 31 else np.int64
        return np.minimum(a, b).astype(kind), np.maximum(a, b).astype(kind)


def bounds(products: tuple[np.ndarray, np.ndarray], cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x anchors) lower and upper bounds of the scores, by table lookup."""
    out = []
    for side in products:
        total = np.zeros((len(cells), side.shape[2]), side.dtype)
        for d in range(cells.shape[1]):
            total += side[d][cells[:, d]]
        out.append(total)
    return out[0], out[1]


class First:
    """The first k of (score, id) of each key: higher scores first, ties by smaller id."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.held = tuple(np.zeros(0, np.int64) for _ in range(4))
        self.least = np.full(keys, np.iinfo(np.int64).min)

    def add(self, key: np.ndarray, score: np.ndarray, of: np.ndarray, row: np.ndarray) -> None:
        """of names a row in the results; row breaks ties and is returned."""
        if not len(key):
            return
        key, score, of, row = (np.concatenate(x) for x in zip(self.held, (key, score, of, row)))
        order = np.lexsort((of, row, -score, key))
        key = key[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        on = order[place < self.k]
        self.held = tuple(x[place < self.k] if x is key else x[on] for x in (key, score, of, row))
        last = place == self.k - 1
        self.least[key[last]] = score[order[last]]


class Group:
    """The anchors of a grid cell."""

    def __init__(self, rows: list[tuple], cells: Cells):
        self.key, self.id, self.label = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        self.vectors = np.array([r[3] for r in rows], np.int64)
        self.windows = [r[4] or [] for r in rows]
        self.products = cells.products(self.vectors)

    def candidates(self, may: Callable[[np.ndarray, np.ndarray, slice], np.ndarray], cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, anchor) pairs for which may(lower, upper, anchors) holds."""
        for at in range(0, len(self.key), TILE):
            tile = slice(at, at + TILE)
            lower, upper = bounds((self.products[0][:, :, tile], self.products[1][:, :, tile]), cells)
            row, anchor = np.nonzero(may(lower, upper, tile))
            yield row, anchor + at

    def scores(self, rows: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        out = np.empty(len(row), np.int64)
        for k in range(0, len(row), 1 << 15):
            out[k : k + (1 << 15)] = (rows[row[k : k + (1 << 15)]] * self.vectors[anchor[k : k + (1 << 15)]]).sum(1)
        return out


class Positives:
    """The first k rows of an anchor's label that aren't the anchor."""

    schema = "key long, score long, vec_id long"

    def __init__(self, group: Group, k: int, window: tuple[int, int]):
        self.group, self.first = group, First(len(group.key), k)

    def take(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> None:
        g = self.group
        for label in np.intersect1d(labels, g.label):
            # Of a batch's rows only those of the label meet its anchors, also in the bounds.
            own, anchors = np.flatnonzero(labels == label), np.flatnonzero(g.label == label)
            part = Subset(g, anchors)
            for row, anchor in part.candidates(lambda lower, upper, tile: upper >= self.first.least[anchors[tile]], cells[own]):
                row, anchor = own[row], anchors[anchor]
                other = ids[row] != g.id[anchor]
                row, anchor = row[other], anchor[other]
                score = g.scores(rows, row, anchor)
                self.first.add(anchor, score, np.zeros(len(row), np.int64), ids[row])

    def found(self) -> list[np.ndarray]:
        key, score, _, row = self.first.held
        return [self.group.key[key], score, row]


class Subset(Group):
    """Some anchors of a group, with its tables."""

    def __init__(self, group: Group, anchors: np.ndarray):
        self.key, self.vectors = group.key[anchors], group.vectors
        self.products = tuple(p[:, :, anchors] for p in group.products)


class Negatives:
    """The first k rows of other labels in the window of each positive; place is the positive's."""

    schema = "key long, place int, score long, vec_id long"

    def __init__(self, group: Group, k: int, window: tuple[int, int]):
        self.group = group
        self.width = max((len(w) for w in group.windows), default=0)
        lo, hi = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        self.low, self.high = np.full((len(group.key), self.width), lo), np.full((len(group.key), self.width), hi)
        for a, scores in enumerate(group.windows):
            for p, s in enumerate(scores):
                # Least and greatest integers in the window; none where a positive's score is negative.
                self.low[a, p], self.high[a, p] = -(-window[0] * s // 100), window[1] * s // 100
        self.first = First(len(group.key) * self.width, k)

    def take(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> None:
        g = self.group
        if not self.width:
            return
        # Only scores that reach a window, and its last place so far, can enter it.
        floor = np.maximum(self.low, self.first.least.reshape(self.low.shape))
        open_ = floor <= self.high
        least = np.where(open_, floor, np.iinfo(np.int64).max).min(1)
        most = np.where(open_, self.high, np.iinfo(np.int64).min).max(1)
        for row, anchor in g.candidates(lambda lower, upper, tile: (upper >= least[tile]) & (lower <= most[tile]) & (labels[:, None] != g.label[tile]), cells):
            score = g.scores(rows, row, anchor)
            for p in range(self.width):
                on = (score >= floor[anchor, p]) & (score <= self.high[anchor, p])
                self.first.add(anchor[on] * self.width + p, score[on], np.full(on.sum(), p), ids[row[on]])

    def found(self) -> list[np.ndarray]:
        key, score, place, row = self.first.held
        return [self.group.key[key // max(self.width, 1)], place.astype(np.int32), score, row]


def _ints(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x * float(scale)).cast("int"))


def _file(usable: DataFrame, size: int, scale: int) -> tuple[DataFrame, Cells]:
    """The written approximation file (vec_id, label, vector array<int>, cells binary), and the cells' edges."""
    whole = usable.select("vec_id", "label", _ints("vector", scale).alias("vector"))

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(0), size)
                low, high = np.minimum(low, rows.min(0)), np.maximum(high, rows.max(0))
        if (low <= high).all():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(low), pa.array(high)], ["at", "low", "high"])

    ends = whole.select("vector").mapInArrow(extremes, "at long, low long, high long").groupBy("at").agg(F.min("low"), F.max("high")).orderBy("at").collect()
    sample = whole.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE_ROWS).collect()
    cells = Cells(np.array([r.vector for r in sample], np.int64), np.array([r[1] for r in ends]), np.array([r[2] for r in ends]))

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = cells.of(matrix(batch.column(2), size).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in found], pa.binary())], ["vec_id", "label", "vector", "cells"])

    return settle(whole.mapInArrow(quantise, "vec_id long, label long, vector array<int>, cells binary"), "file"), cells


def _meet(file: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, cells: Cells, size: int, kind: type, k: int, window: tuple[int, int]) -> DataFrame:
    """What kind finds of file's rows for anchors (key, vec_id, label, vector, windows array<long>), grid cell by grid cell."""
    wide, high = -(-n_rows // ROWS), -(-n_anchors // ANCHORS)
    strip = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = anchors.select(strip("key", high).alias("i"), across(wide).alias("j"), "key", "vec_id", "label", "vector", F.lit(None).cast("binary").alias("cells"), "windows")
    none = [F.lit(None).cast("long").alias("key"), F.lit(None).cast("array<long>").alias("windows")]
    passing = file.select(across(high).alias("i"), strip("vec_id", wide).alias("j"), none[0], "vec_id", "label", "vector", "cells", none[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, now = None, [], None

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None:
                found = now.found()
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], [c.split()[0] for c in kind.schema.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            i, j = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            new = np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for start, end in zip([0, *new], [*new, len(i)]):
                if (i[start], j[start]) != at:
                    yield from done()
                    at, waiting, now = (i[start], j[start]), [], None
                part = batch.slice(start, end - start)
                n = part.num_rows - part.column(2).null_count
                if n:
                    waiting += zip(*(part.column(c).slice(0, n).to_pylist() for c in (2, 3, 4, 5, 7)))
                if n < part.num_rows and waiting:
                    if now is None:
                        now = kind(Group(waiting, cells), k, window)
                    ids, labels = (part.column(c).slice(n).to_numpy(zero_copy_only=False) for c in (3, 4))
                    code = np.frombuffer(b"".join(part.column(6).slice(n).to_pylist()), np.uint8).reshape(-1, size)
                    now.take(ids, labels, matrix(part.column(5).slice(n), size).astype(np.int64), code)
        yield from done()

    both = held.unionByName(passing).repartition("i", "j").sortWithinPartitions("i", "j", F.col("key").asc_nulls_last())
    return both.mapInArrow(run, kind.schema)


def _leading(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows of each group, with their rank from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of which anchor, a condition
    on columns of rows, holds.

    Rows whose vec_id, label or vector is null, or with a component that is null or not finite, take no part. The size of vectors is
    the most frequent one; rows of another size have no product with them and take no part, nor do those with a component of
    which floor(scale * x) is beyond 2^24. vec_id and label are long. Rows that repeat a vec_id are rows like others, but a row
    with the anchor's own vec_id is never its positive; an anchor that occurs twice is answered twice. An anchor
    without positives, or with empty windows, gives no row. An empty table gives an empty table; further columns are ignored.
    """
    prepare(rows.sparkSession)
    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    named = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("vector")).filter(small("vector", scale))
    size = usual_size(named, "vector")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size:
        return rows.sparkSession.createDataFrame([], result)
    usable = named.filter(F.size("vector") == size)
    file, cells = _file(usable, size, scale)
    asked = usable.filter("anchor").select("vec_id", "label", _ints("vector", scale).alias("vector"))
    # The numbers are written with the table, so every later read sees the same ones.
    asked = settle(asked.withColumn("key", F.monotonically_increasing_id()), "anchors")
    n_rows, n_anchors = file.count(), asked.count()
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], result)

    meet = lambda anchors, kind, k: _meet(file, anchors, n_rows, n_anchors, cells, size, kind, k, window)
    best = settle(_leading(meet(asked.withColumn("windows", F.lit(None).cast("array<long>")), Positives, positives), ["key"], positives), "positives")
    of = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    # Anchors without a positive have no window.
    windowed = settle(asked.join(of, "key").withColumn("windows", F.col("positives.score")), "windowed")
    found = _leading(meet(windowed, Negatives, negatives), ["key", "place"], negatives)
    own = windowed.select("key", F.col("vec_id").alias("anchor_id"), "positives")
    positive = F.element_at("positives", F.col("place") + 1)
    return found.join(own, "key").select("anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM kept a JOIN kept r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLES: dict[str, str] = {"op13_hard_negatives": ORACLE}
