"""Suffix-array dedup: bytes that a string of a given length covers which also starts anywhere else.

A window of that length has one anchor: the gram in it whose hash is least (leftmost if equal). Equal windows have equal
anchors at equal places, so only windows around equal anchors can be equal. The windows of one anchor begin next to each
other; the bytes that they span are its context. Equal contexts (128 bits of BLAKE2b over their bytes) are one entry with
a multiplicity. Where an anchor has several different contexts, the suffixes that begin behind it and the reversed
prefixes that end before it are put in order by deep-shallow sorting; common prefixes of neighbours then say which windows
are equal. Where an anchor has more different contexts than one task should hold, these contexts are the texts of another
round, with longer grams: their windows are dealt to more anchors, and much that was different becomes equal. The last
round's gram is the window itself, where different contexts of one anchor no longer exist.

Two lengths may be asked for at once: each part of a repeated string repeats, so the longer strings are sought only in what
the shorter ones cover.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, prepare, map_rows, settle, table, utf8


@dataclass(frozen=True)
class Shape:
    """Bytes of a repeated string, and of the grams that anchor it."""

    length: int
    gram: int

    def longer(self) -> Shape:
        """The next round's, which leaves an eighth of the windows around a gram."""
        return Shape(self.length, self.length - self.rest // 8)

    @property
    def reach(self) -> int:
        """Anchors that a window may have."""
        return self.length - self.gram + 1

    @property
    def rest(self) -> int:
        return self.length - self.gram


#: The query's shape.
REPEATED = Shape(400, 128)
#: The pipeline stage's, and that of the query's text: 50 words of three letters and a blank each, the least that a passage of over 50 words has in
#: text of everyday words; it is a third shorter than 50 average words.
PASSAGE = Shape(200, 64)
#: Depth at which multikey quicksort hands over to blind tries.
SHALLOW = 12
#: Different contexts of one anchor that one task sorts; a larger group, which may be of any size, goes to another round.
GROUP = 256
#: Bytes that are hashed together; a longer text is cut into overlapping parts.
CHUNK_BITS = 19
CHUNK = 1 << CHUNK_BITS

_rng = np.random.default_rng(20240777)
_SYMBOLS = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(CHUNK, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _grams(buf: np.ndarray, n: int) -> np.ndarray:
    """A rolling hash of each n bytes of a buffer of at most CHUNK. It only brings grams together, and decides nothing."""
    power, inverse = _powers()
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_SYMBOLS[buf] * power[: len(buf)], out=total[1:])
    return _mix((total[n:] - total[:-n]) * inverse[: len(buf) + 1 - n])


def _digest(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BLAKE2b of byte ranges, as two columns of 64 bits."""
    view = memoryview(data)
    made = b"".join([blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    both = np.frombuffer(made, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbouring values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(parts: list[bytes], shape: Shape) -> tuple[np.ndarray, ...]:
    """(part, lo, n, da, kh, c1, c2): windows lo to lo + n - 1 of a part have their anchor at lo + da; hash of the anchor,
    digest of the context and da. The parts together have at most CHUNK bytes."""
    data = b"".join(parts)
    buf = np.frombuffer(data, np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    none = (np.zeros(0, np.int64),) * 7
    if len(buf) < shape.length:
        return none
    grams = _grams(buf, shape.gram)
    place = np.uint64(CHUNK - 1)
    at = (_least((grams & ~place) | np.arange(len(grams), dtype=np.uint64), shape.reach) & place).astype(np.int64)
    valid = np.zeros(len(at) + 2, bool)  # with an invalid one at each end
    for a, b in zip(starts, ends):
        if b - a >= shape.length:
            valid[a + 1 : b - shape.length + 2] = True
    inner = valid[1:-1]
    new = inner & ~(valid[:-2] & np.concatenate([[False], at[1:] == at[:-1]]))
    lo = np.flatnonzero(new)
    if not len(lo):
        return none
    last = inner & ~(valid[2:] & np.concatenate([at[1:] == at[:-1], [False]]))
    hi = np.flatnonzero(last)
    anchor = at[lo]
    c1, c2 = _digest(data, lo, hi + shape.length)
    c1 = c1 ^ _mix((anchor - lo).astype(np.uint64)).view(np.int64)
    part = np.searchsorted(starts, lo, "right") - 1
    # Empty parts share a start with the next; the last of equal starts is the one that has bytes.
    return part, lo - starts[part], hi - lo + 1, anchor - lo, grams[anchor].view(np.int64), c1, c2


def _parts(raws: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(row, base, bytes) lists of at most CHUNK bytes; parts of a long text overlap so that each window is in one."""
    rows, bases, held, size = [], [], [], 0
    for i, raw in enumerate(raws):
        if len(raw) < length:
            continue
        for base in range(0, len(raw) - length + 1, CHUNK - length + 1):
            part = raw[base : base + CHUNK]
            if size + len(part) > CHUNK:
                yield rows, bases, held
                rows, bases, held, size = [], [], [], 0
            rows.append(i)
            bases.append(base)
            held.append(part)
            size += len(part)
    if held:
        yield rows, bases, held


#: What the steps in Python yield. key and th name a text (see repeated_spans), base a part of it where a round's texts are
#: contexts; lo, start and end count from the whole text's begin.
ANCHORS = "key long, th long, base long, lo long, n long, da long, kh long, c1 long, c2 long, times long"
CONTEXTS = "kh long, c1 long, c2 long, many boolean, key long, th long, lo long, n long, da long, bytes binary"
SPANS = "key long, th long, start long, end long"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(",")]


def _find_anchors(shape: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, th, base, bytes) to rows of two sorts. Contexts: once for each text, with the times that they occur in it. Spans (kh
    null): what the contexts cover that occur more than once in a text; periodic texts have very many, which end here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes, above = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            for rows, bases, held in _parts(utf8(batch.column(3)), shape.length):
                part, lo, n, da, kh, c1, c2 = anchors(held, shape)
                order = np.lexsort((lo, c2, c1, kh, part))
                differs = lambda x: x[order][1:] != x[order][:-1]
                first = np.concatenate([[True], differs(part) | differs(kh) | differs(c1) | differs(c2)])[: len(order)]
                group = np.cumsum(first) - 1
                times = np.bincount(group)
                one = order[first]
                again = np.sort(order[times[group] > 1])
                start, end = lo[again], lo[again] + n[again] - 1 + shape.length
                new = np.concatenate([[True], (part[again][1:] != part[again][:-1]) | (start[1:] > end[:-1])])[: len(again)]
                last = np.concatenate([new[1:], [True]])[: len(again)]
                row = np.array(rows)
                base = np.array(bases) + above[row]
                m, k = len(one), int(new.sum())
                at = np.concatenate([part[one], part[again][new]])
                cols = [
                    pa.array(keys[row[at]]),
                    pa.array(hashes[row[at]]),
                    pa.array(above[row[at]]),
                    pa.array(np.concatenate([lo[one], start[new]]) + base[at]),
                    pa.array(np.concatenate([n[one], (end[last] - start[new])])),
                    pa.array(np.concatenate([da[one], np.zeros(k, np.int64)])),
                    *(pa.array(np.concatenate([x[one], np.zeros(k, np.int64)]), mask=np.arange(m + k) >= m) for x in (kh, c1, c2)),
                    pa.array(np.concatenate([times, np.zeros(k, np.int64)])),
                ]
                yield pa.RecordBatch.from_arrays(cols, _names(ANCHORS))

    return run


# ---- deep-shallow sorting


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def _symbol(s: bytes, d: int) -> int:
    return s[d] if d < len(s) else -1


class _Node:
    """Of a blind trie: the depth at which its children differ, and them by symbol; a leaf is a list of string numbers."""

    __slots__ = ("depth", "children")

    def __init__(self, depth: int, children: dict):
        self.depth, self.children = depth, children


def _blind_sort(strings: list[bytes], items: list[int]) -> list[int]:
    """items in order of their strings, by a trie that keeps branching depths only: a search goes down unchecked, then one
    comparison with the leaf's string finds where the new string leaves its path."""
    root: _Node | list[int] = [items[0]]
    for i in items[1:]:
        s = strings[i]
        node = root
        while isinstance(node, _Node):
            child = node.children.get(_symbol(s, node.depth))
            node = child if child is not None else next(iter(node.children.values()))
        other = strings[node[0]]
        depth = _common(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            continue
        above, edge, node = None, None, root
        while isinstance(node, _Node) and node.depth < depth:
            above, edge = node, _symbol(s, node.depth)
            node = node.children[edge]
        if isinstance(node, _Node) and node.depth == depth:
            node.children[_symbol(s, depth)] = [i]
            continue
        split = _Node(depth, {_symbol(other, depth): node, _symbol(s, depth): [i]})
        if above is None:
            root = split
        else:
            above.children[edge] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack.extend(node.children[k] for k in sorted(node.children, reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Numbers of strings in their order: multikey quicksort to a shallow depth, blind tries for what is equal there."""
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2 or depth < 0:
            out.extend(items)
        elif depth >= shallow:
            out.extend(_blind_sort(strings, items))
        else:
            symbols = [_symbol(strings[i], depth) for i in items]
            pivot = sorted((symbols[0], symbols[len(symbols) // 2], symbols[-1]))[1]
            less = [i for i, c in zip(items, symbols) if c < pivot]
            more = [i for i, c in zip(items, symbols) if c > pivot]
            same = [i for i, c in zip(items, symbols) if c == pivot]
            stack += [(more, depth), (same, depth + 1 if pivot >= 0 else -1), (less, depth)]
    return out


def _order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix of each neighbouring two)."""
    order = deep_shallow_sort(strings)
    return np.array(order), np.array([_common(strings[a], strings[b]) for a, b in zip(order, order[1:])], np.int64)


def _common_with(order: np.ndarray, common: np.ndarray, rank: int, n: int) -> np.ndarray:
    """Common prefix of the string at rank with every string, by number; 0 for itself."""
    out = np.zeros(n, np.int64)
    if rank + 1 < n:
        out[order[rank + 1 :]] = np.minimum.accumulate(common[rank:])
    if rank:
        out[order[:rank]] = np.minimum.accumulate(common[:rank][::-1])[::-1]
    return out


def repeated_windows(contexts: list[tuple[int, int, bytes]], shape: Shape = REPEATED) -> list[list[tuple[int, int]]]:
    """For contexts (da, n, bytes) of one anchor, all different: the runs (first, end) of windows, counted from each
    context's first, that another context has too."""
    by_gram: dict[bytes, list[int]] = {}
    for i, (da, _, b) in enumerate(contexts):
        by_gram.setdefault(b[da : da + shape.gram], []).append(i)
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for own in by_gram.values():  # one group, unless hashes of anchors collide
        if len(own) > 1:
            for i, runs in zip(own, _equal_windows([contexts[i] for i in own], shape)):
                out[i] = runs
    return out


def _equal_windows(contexts: list[tuple[int, int, bytes]], shape: Shape) -> list[list[tuple[int, int]]]:
    lefts = [b[:da][::-1] for da, _, b in contexts]
    rights = [b[da + shape.gram :] for da, _, b in contexts]
    m = len(contexts)
    (lo, lc), (ro, rc) = _order(lefts), _order(rights)
    lrank, rrank = np.empty(m, np.int64), np.empty(m, np.int64)
    lrank[lo], rrank[ro] = np.arange(m), np.arange(m)
    out = []
    for i, (da, n, _) in enumerate(contexts):
        left, right = _common_with(lo, lc, lrank[i], m), _common_with(ro, rc, rrank[i], m)
        left[i] = right[i] = -1
        # A window that begins d bytes before the anchor is equal if left >= d and right >= rest - d.
        first, last = np.maximum(shape.rest - right, da - n + 1), np.minimum(left, da)
        ok = (first <= last) & (right >= 0)
        if not ok.any():
            out.append([])
            continue
        steps = np.zeros(da + 2, np.int64)
        np.add.at(steps, first[ok], 1)
        np.add.at(steps, last[ok] + 1, -1)
        on = np.cumsum(steps)[: da + 1][::-1] > 0  # from d = da, the first window, down to d = 0
        out.append(_runs(on))
    return out


def _runs(on: np.ndarray) -> list[tuple[int, int]]:
    edges = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


def _cut_contexts(shape: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, th, base, bytes, wanted array<struct>) to one row for each wanted context; a repeated row gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for key, th, base, raw, wanted in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), utf8(batch.column(3)), batch.column(4).to_pylist()):
                if (key, th, base) in seen:
                    continue
                seen.add((key, th, base))
                for w in wanted:
                    for col, v in zip(out, (w["kh"], w["c1"], w["c2"], w["many"], key, th, w["lo"], w["n"], w["da"], raw[w["lo"] - base : w["lo"] - base + w["n"] - 1 + shape.length])):
                        col.append(v)
            kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], _names(CONTEXTS))

    return run


def _sort_groups(shape: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts sorted by (kh, c1, c2), at most GROUP an anchor; gives the spans of runs of repeated windows."""
    columns = ["kh", "c1", "c2", "key", "th", "lo", "n", "da", "bytes"]

    def group(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_windows([(da, n, raw) for _, _, _, n, da, raw in rows], shape)
        flat = [(key, th, lo + a, lo + b - 1 + shape.length) for (key, th, lo, *_), runs in zip(rows, found) for a, b in runs]
        cols = list(zip(*flat)) if flat else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _names(SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before, held = None, None, []
        for batch in batches:
            for kh, c1, c2, *row in zip(*(batch.column(n).to_pylist() for n in columns)):
                if kh != now:
                    if held:
                        yield group(held)
                    now, before, held = kh, None, []
                if (c1, c2) != before:  # equal ones come from a text that a lost task gave twice
                    held.append(tuple(row))
                before = (c1, c2)
        if held:
            yield group(held)

    return run


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP, shape: Shape = REPEATED) -> DataFrame:
    """(key, th, start, end): byte spans of texts that repeated strings of the shape's length cover; spans may overlap.

    key is doc_id (a hash of the text where that is null) and th a hash of the text: together they name a text.
    """
    return _rounds(_whole_texts(docs, doc_id, text, shape), group, shape)[0]


def _whole_texts(docs: DataFrame, doc_id: str, text: str, shape: Shape) -> DataFrame:
    """(key, th, base, bytes) of the texts that have room for a string of the shape's length."""
    prepare(docs.sparkSession)
    return docs.filter(F.octet_length(text) >= shape.length).select(*_named(doc_id, text), F.lit(0).cast("long").alias("base"), F.col(text).cast("binary").alias("bytes"))


def _rounds(rows: DataFrame, group: int, shape: Shape) -> tuple[DataFrame, list[DataFrame]]:
    """(spans, the settled tables that they are read from) of (key, th, base, bytes) rows."""
    tables: list[DataFrame] = []
    spans, more = _round(rows, group, shape, tables)
    while more is not None:
        shape = shape.longer()
        found, more = _round(more, group, shape, tables)
        spans = spans.unionByName(found)
    return spans, tables


def _round(rows: DataFrame, group: int, shape: Shape, tables: list[DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """(spans, contexts that are the next round's rows; None where there are none) of (key, th, base, bytes) rows.

    Each window is in one context, so windows of different contexts are different places.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        tables.append(settle(df, name))
        return tables[-1]

    found = kept(rows.mapInArrow(_find_anchors(shape), ANCHORS), "anchors")
    within = found.filter("kh IS NULL").select("key", "th", F.col("lo").alias("start"), (F.col("lo") + F.col("n")).alias("end"))
    once = found.filter("kh IS NOT NULL")
    same = once.groupBy("kh").agg(F.sum("times").alias("c"), *[f(x).alias(f"{name}_{x}") for x in ("c1", "c2") for name, f in (("low", F.min), ("high", F.max))])
    same = same.filter("c > 1").selectExpr("kh", "low_c1 <> high_c1 OR low_c2 <> high_c2 AS mixed")
    twins = kept(once.join(kept(same, "same"), "kh"), "twins")
    span = lambda df: df.select("key", "th", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + shape.length).alias("end"))
    plain = span(twins.filter("NOT mixed"))

    mixed = twins.filter("mixed").drop("mixed")
    one = F.min(F.struct("key", "th", "base", "lo", "n", "da")).alias("one")
    entries = kept(mixed.groupBy("kh", "c1", "c2").agg(F.sum("times").alias("times"), one), "entries")
    whole = span(mixed.drop("times").join(entries.filter("times > 1").select("kh", "c1", "c2"), ["kh", "c1", "c2"]))
    # The last round's contexts are windows: there nothing is different but what collides.
    large = F.count("*") > group if shape.rest else F.lit(False)
    sizes = kept(entries.groupBy("kh").agg(large.alias("many")), "sizes")
    wanted = entries.join(sizes, "kh").select("one.key", "one.th", "one.base", F.struct("kh", "c1", "c2", "many", "one.lo", "one.n", "one.da").alias("w"))
    wanted = wanted.groupBy("key", "th", "base").agg(F.collect_list("w").alias("wanted"))
    cut = rows.join(wanted.hint("shuffle_hash"), ["key", "th", "base"]).select("key", "th", "base", "bytes", "wanted")
    contexts = kept(cut.mapInArrow(_cut_contexts(shape), CONTEXTS), "contexts")
    few = contexts.filter("NOT many").drop("many").repartition("kh").sortWithinPartitions("kh", "c1", "c2")
    few = few.mapInArrow(_sort_groups(shape), SPANS)
    many = contexts.filter("many").select("key", "th", F.col("lo").alias("base"), "bytes")
    return within.unionByName(plain).unionByName(whole).unionByName(few), None if many.isEmpty() else many


def _named(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)).alias("key"), F.xxhash64(text).alias("th")]


def _cut(raw: bytes, starts: np.ndarray | None, ends: np.ndarray | None, whole: bool = False) -> dict:
    if starts is None or not len(starts):
        return {"n_bytes": len(raw), "spans": [], "kept": raw}
    order = np.argsort(starts, kind="stable")
    spans: list[dict] = []
    for a, b in zip(starts[order].tolist(), ends[order].tolist()):
        b = min(b, len(raw))
        if spans and a <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], b)
        elif a < b:
            spans.append({"start": a, "end": b})
    kept, at = [], 0
    for s in spans:
        start, end = s["start"], s["end"]
        if whole:
            start = next((k for k in range(start, max(start - 4, -1), -1) if raw[k] & 0xC0 != 0x80), start)
            end = next((k for k in range(end, min(end + 4, len(raw))) if raw[k] & 0xC0 != 0x80), len(raw) if end + 4 > len(raw) else end)
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    return {"n_bytes": len(raw), "spans": spans, "kept": b"".join(kept)}


SCHEMA = "n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
PASSAGES = "passages array<struct<start:long,end:long>>, rest binary"


def _collected(spans: DataFrame, name: str) -> DataFrame:
    # A set: repeated rows give the same spans once each.
    return spans.groupBy("key", "th").agg(F.collect_set(F.struct("start", "end")).alias(name))


def _each(found: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, ends) of each row's spans; none where the row is null."""
    flat_s, flat_e = ((found.values.field(k).to_numpy(zero_copy_only=False) if len(found) else np.zeros(0, np.int64)) for k in (0, 1))
    at = found.offsets.to_numpy()
    for i in range(len(found)):
        yield flat_s[at[i] : at[i + 1]], flat_e[at[i] : at[i + 1]]


def _inside(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, th, bytes, spans) to (key, th, base, bytes): maximal runs of spans that have room for a longer string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, th, raw, (starts, ends) in zip(*(batch.column(k).to_pylist() for k in (0, 1)), utf8(batch.column(2)), _each(batch.column(3))):
                for s in _cut(raw, starts, ends)["spans"]:
                    if s["end"] - s["start"] >= length:
                        for col, v in zip(out, (key, th, s["start"], raw[s["start"] : s["end"]])):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.binary()])], ["key", "th", "base", "bytes"])

    return run


def suffix_dedup_twice(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP, passage: Shape = PASSAGE, shape: Shape = REPEATED) -> DataFrame:
    """docs with suffix_dedup's columns for the shape, and passages and rest for a shorter one: maximal runs of bytes that
    its strings cover, and the other bytes without the rest of a character that such a run cuts."""
    texts = _whole_texts(docs, doc_id, text, passage)
    spans, tables = _rounds(texts, group, passage)
    short = settle(_collected(spans, "__passages"), "passages")
    for t in tables:
        discard(t)
    # A repeated string is made of repeated ones of the shorter length, so it lies in a run of their spans.
    found = texts.filter(F.octet_length("bytes") >= shape.length).join(short.hint("shuffle_hash"), ["key", "th"]).select("key", "th", "bytes", "__passages")
    runs = settle(found.mapInArrow(_inside(shape.length), "key long, th long, base long, bytes binary"), "runs")
    spans, tables = _rounds(runs, group, shape)
    long = settle(_collected(spans, "__spans"), "spans")
    for t in [runs, *tables]:
        discard(t)
    joined = _joined(docs, doc_id, text, short, long)

    def rows(column: pa.Array, found: pa.Array, passages: pa.Array):
        for raw, own, shorter in zip(utf8(column), _each(found), _each(passages)):
            made = _cut(raw, *shorter, whole=True)
            yield _cut(raw, *own) | {"passages": made["spans"], "rest": made["kept"]}

    return map_rows(joined.drop("passages", "rest"), [text, "__spans", "__passages"], f"{SCHEMA}, {PASSAGES}", rows).drop("__spans", "__passages")


def _joined(docs: DataFrame, doc_id: str, text: str, *found: DataFrame) -> DataFrame:
    """docs with what was found for each text, null where nothing was."""
    out = docs.drop("n_bytes", "spans", "kept", "__key", "__th", "__spans").select("*", *[c.alias(n) for c, n in zip(_named(doc_id, text), ("__key", "__th"))])
    for df in found:
        out = out.join(df.withColumnsRenamed({"key": "__key", "th": "__th"}).hint("shuffle_hash"), ["__key", "__th"], "left")
    return out.drop("__key", "__th")


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP, whole: bool = False, shape: Shape = REPEATED) -> DataFrame:
    """docs with n_bytes, spans (maximal runs of bytes that repeat) and kept (the other bytes), which replace own columns
    of these names.

    Null text is empty: nothing repeats. Repeated rows repeat each other, rows that share a doc_id with different texts are
    different texts, and rows without doc_id are known by their text. whole: kept lacks the rest of a character that a span
    cuts, too. An empty table gives an empty table. Columns named __key, __th and __spans are the operator's own.
    """
    joined = _joined(docs, doc_id, text, _collected(repeated_spans(docs, doc_id, text, group, shape), "__spans"))

    def rows(column: pa.Array, found: pa.Array):
        for raw, own in zip(utf8(column), _each(found)):
            yield _cut(raw, *own, whole)

    return map_rows(joined, [text, "__spans"], SCHEMA, rows).drop("__spans")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, for strings of 400 bytes; then n_passages and text, for those of PASSAGE: the text as the
    pipeline's stage leaves it, without passages that 400 bytes are too long for."""
    done = suffix_dedup_twice(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    contract = [F.col("doc_id"), F.col("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]
    return done.select(*contract, F.size("passages").cast("long").alias("n_passages"), _left("passages", "rest").alias("text"))


def _left(spans: str, kept: str) -> Column:
    return F.when(F.size(spans) == 0, F.col("text")).otherwise(F.make_valid_utf8(F.col(kept).cast("string")))


def stage_suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with repeated passages of PASSAGE bytes or more cut out of text wherever they stand, and n_chars counted anew; a
    character that a span cuts goes whole."""
    names = docs.columns
    done = suffix_dedup(docs, whole=True, shape=PASSAGE)
    done = done.withColumn("text", _left("spans", "kept"))
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.when(F.size("spans") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return done.select(names)


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLES: dict[str, str] = {}
