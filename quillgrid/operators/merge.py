"""Deduplication and merges. Order is always explicit: a seq column says which row came first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def _pick(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def keep_first(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    return _pick(df, keys, F.col(seq).asc())


def keep_last(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    return _pick(df, keys, F.col(seq).desc())


def keep_last_in_place(df: DataFrame, keys: Sequence[str], seq: str = "seq", position: str = "position") -> DataFrame:
    """The last row of each key, at the place of the first."""
    w = Window.partitionBy(*keys)
    return keep_last(df.withColumn(position, F.min(seq).over(w)), keys, seq)


def priority_merge(frames: Sequence[DataFrame], keys: Sequence[str], seq: str = "seq", last_wins: bool = False) -> DataFrame:
    """Union of frames; of each key the row of the first frame (last_wins: the last) stays, in it the first (last) row.

    Rows with a null key are left out: they have no identity.
    """
    union = None
    for rank, df in enumerate(frames):
        ranked = df.withColumn("__rank", F.lit(rank))
        union = ranked if union is None else union.unionByName(ranked, allowMissingColumns=True)
    for k in keys:
        union = union.filter(F.col(k).isNotNull())
    way = (lambda c: F.col(c).desc()) if last_wins else (lambda c: F.col(c).asc())
    return _pick(union, keys, way("__rank"), way(seq)).drop("__rank")


def only_new(df: DataFrame, seen: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Rows whose key isn't in seen, the first of each."""
    return keep_first(df.join(seen.select(*keys), list(keys), "left_anti"), keys, seq)


def only_new_of_history(df: DataFrame, history: DataFrame, keys: Sequence[str], seq: str = "seq", most_words: int = 1 << 21) -> DataFrame:
    """only_new for a batch and a history that is far larger: a Bloom filter of the batch's keys, in parts of words, passes
    over the history's scan, so that the exact anti-join shuffles only the keys that the batch may have.

    The filter has 16 bits a key, up to most_words words of 64 bits (16 MB), which bounds the broadcast; a larger batch gets
    fewer bits a key, so that more of history passes, and the result is the same.
    """
    batch = settle(df, "batch")
    words = min(most_words, max(1, 1 << (-(-batch.count() // 4) - 1).bit_length()))
    part = min(words, 4096)
    at = F.pmod(F.xxhash64(*keys), F.lit(words))
    mask = reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(F.xxhash64(*keys, F.lit(1)), 6 * k).bitwiseAND(63).cast("int")) for k in range(4)])
    bits = batch.select(at.alias("at"), mask.alias("mask")).groupBy("at").agg(F.bit_or("mask").alias("bits"))
    whole = df.sparkSession.range(words).select(F.col("id").alias("at")).join(bits, "at", "left").select("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    parts = whole.groupBy(F.floor(F.col("at") / part).alias("__part")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda w: w["bits"]).alias("__words"))
    asked = history.select(*keys).withColumns({"__part": F.floor(at / part), "__at": (at % part + 1).cast("int"), "__mask": mask})
    met = asked.join(F.broadcast(parts), "__part").filter(F.element_at("__words", F.col("__at")).bitwiseAND(F.col("__mask")) == F.col("__mask"))
    return only_new(batch, met.select(*keys), keys, seq)


def first_by_either(df: DataFrame, first: str, second: str, seq: str = "seq", most: int | None = None) -> DataFrame:
    """Rows in order of seq, without those that share either key with an earlier row that stayed; the first most of them.

    The sequential rule in rounds: a row that is the first open one of both of its keys stays, and open rows that share a key
    with it go. Only rows that stayed block others. Null is a key like any other; rows of one seq are ordered by their
    keys. A round for each link of the longest chain of rows that decide one another; with most, no longer than until the
    first most rows are decided.
    """
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    place = F.struct(F.col(seq).alias("s"), key(first).alias("a"), key(second).alias("b"))
    named = settle(df.withColumn("__o", place), "named")
    open_ = settle(named.select("__o").distinct(), "open")
    stay = None
    while True:
        lows = [open_.groupBy(F.col(f"__o.{k}").alias(k)).agg(F.min("__o").alias(f"low_{k}")) for k in "ab"]
        now = open_.select("__o", "__o.a", "__o.b").join(lows[0], "a").join(lows[1], "b").filter("__o = low_a AND __o = low_b").select("__o")
        now = settle(now, "stay")
        if now.isEmpty():
            break
        stay = now if stay is None else stay.unionByName(now)
        left = open_.select("__o", "__o.a", "__o.b")
        for k in "ab":
            left = left.join(now.select(F.col(f"__o.{k}").alias(k)).distinct(), k, "left_anti")
        open_ = settle(left.select("__o"), "open")
        if most is not None:
            least = open_.agg(F.min("__o").alias("o")).first()["o"]
            low = None if least is None else F.struct(*[F.lit(x).alias(k) for k, x in zip("sab", least)]).cast(open_.schema["__o"].dataType)
            if low is None or stay.filter(F.col("__o") < low).limit(most).count() == most:
                break
    kept = _pick(named.join(stay, "__o"), ["__o"], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])) if stay is not None else named
    kept = kept.orderBy("__o").limit(most) if most is not None else kept
    return kept.drop("__o")


def insert_only(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: str, updated: Sequence[str], when: str | None = None) -> DataFrame:
    """New keys are inserted; of known ones only the columns updated change, where column when differs (any, if None)."""
    o, n = old.alias("o"), new.alias("n")
    known, fresh = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    changed = known & fresh if when is None else known & fresh & ~F.col(f"o.{when}").eqNullSafe(F.col(f"n.{when}"))
    take = lambda c: F.when(~known | (changed if c in updated else F.lit(False)), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *[take(c).alias(c) for c in old.columns if c != key])


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Null or missing columns get a default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()})


def merge_lines(old: DataFrame, new: DataFrame, line: str = "value", key: str = "hash", position: str = "position") -> DataFrame:
    """JSON lines, the first of each key: old ones before new ones, then by position, a line's place in its file. Lines that
    can't be read stay, lines with a blank key go."""
    both = old.select(line, position).withColumn("__r", F.lit(0)).unionByName(new.select(line, position).withColumn("__r", F.lit(1)))
    both = both.withColumn("__v", F.try_parse_json(F.col(line))).withColumn("__k", F.try_variant_get("__v", f"$.{key}", "string"))
    good = both.filter(F.col("__v").isNotNull() & (F.coalesce("__k", F.lit("")) != "")).drop("__v")
    return _pick(good, ["__k"], F.col("__r"), F.col(position), F.col(line)).select(line).unionByName(both.filter(F.col("__v").isNull()).select(line))
