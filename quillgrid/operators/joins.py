"""Joins other than plain equi-joins, and plain ones with defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def enrich(df: DataFrame, other: DataFrame, key: str, overrides: Sequence[str]) -> DataFrame:
    """Left join; the other side's values win where it has them. Which side is broadcast is left to the planner's sizes."""
    o = other.select(key, *[F.col(c).alias(f"__{c}") for c in overrides])
    joined = df.join(o, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) if c in df.columns else F.col(f"__{c}") for c in overrides}).drop(*[f"__{c}" for c in overrides])


def nearest(df: DataFrame, points: DataFrame, keys: Sequence[str], value: str, at: str, payload: Sequence[str], reach: float, row: str = "id") -> DataFrame:
    """Each row of df with the payload of the nearest point of equal keys within reach; ties go to the lower point,
    of equal points to the least payload.

    Rows meet by key and a cell of reach's size and its neighbours, so a hot key is spread over its cells.
    """
    if reach <= 0:
        raise ValueError("reach must be positive")
    cell = lambda c: F.floor(F.col(c) / reach)
    left = df.select(row, *keys, F.col(value).alias("__v")).withColumn("__c", F.explode(F.sequence(cell("__v") - 1, cell("__v") + 1)))
    right = points.select(*keys, F.col(at).alias("__at"), *[F.col(p) for p in payload]).withColumn("__c", cell("__at"))
    both = left.join(right, [*keys, "__c"]).filter(F.abs(F.col("__v") - F.col("__at")) <= reach)
    best = both.groupBy(row).agg(F.min_by(F.struct(F.col("__at").alias("nearest"), *payload), F.struct(F.abs(F.col("__v") - F.col("__at")), "__at", *payload)).alias("__b"))
    return df.join(best, row, "left").select(*df.columns, F.col("__b.nearest").alias("nearest"), *[F.col(f"__b.{p}").alias(p) for p in payload])


def _grams(c: Column, n: int) -> Column:
    """The distinct runs of n characters of a text, or the whole of a shorter one."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - n + 1)), lambda i: F.substring(c, i, n)))


def contained(texts: DataFrame, text: str, words: DataFrame, word: str, gram: int = 3) -> DataFrame:
    """(text, word) of distinct values, where word contains text. Null and empty values take no part.

    A word that contains a text has all of its grams: words are dealt by their grams, and each text goes to the gram that
    the fewest words have, so that a common beginning doesn't bring all texts and words together. Texts shorter than
    gram are a gram of their own length, by which words are dealt too where there are such texts.
    """
    t = texts.select(F.col(text).alias("text")).filter("coalesce(text, '') <> ''").distinct()
    t = settle(t, "texts")
    w = words.select(F.col(word).alias("word")).filter("coalesce(word, '') <> ''").distinct()
    lengths = [r[0] for r in t.select(F.least(F.length("text"), F.lit(gram)).alias("n")).distinct().collect()]  # gram values at most
    if not lengths:
        return t.select("text", F.lit("").alias("word")).limit(0)
    dealt = w.select("word", F.explode(F.array_distinct(F.flatten(F.array(*[_grams(F.col("word"), n) for n in lengths])))).alias("g"))
    dealt = settle(dealt, "dealt")
    sizes = settle(dealt.groupBy("g").agg(F.count("*").alias("n")), "sizes")
    rarest = t.select("text", F.explode(_grams(F.col("text"), gram)).alias("g")).join(sizes, "g", "left")
    # A gram that no word has: no word contains the text.
    met = rarest.groupBy("text").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("r")).filter("r.n > 0").select("text", "r.g")
    return met.join(dealt, "g").filter(F.expr("contains(word, text)")).select("text", "word")


def contains_first(df: DataFrame, words: DataFrame, text: str, word: str, order: str, row: str, exact: str | None = None, gram: int = 3) -> DataFrame:
    """Each row of df with the first (by order) row of words whose word equals exact, else contains text.

    Texts and words meet by the rarest gram of a text (contained), once for each distinct value; rows follow by equi-joins.
    """
    pairs = contained(df, text, words, word, gram)
    w = words.withColumn("__w", F.col(word))
    key = F.struct((F.col("__w") != F.col("text")).alias("e") if exact else F.lit(0).alias("e"), F.col(order).alias("o"))
    best = pairs.join(w, F.col("word") == F.col("__w")) if word != "word" else pairs.drop("word").join(w, pairs["word"] == w["__w"])
    best = best.groupBy("text").agg(F.min_by(F.struct(*[w[c] for c in words.columns]), key).alias("__b")).withColumnRenamed("text", "__t")
    return df.join(best, df[text] == best["__t"], "left").select(*[df[c] for c in df.columns], *[F.col(f"__b.{c}").alias(c if c not in df.columns else f"matched_{c}") for c in words.columns])


def first_part(df: DataFrame, text: str, places: DataFrame, name: str, payload: Sequence[str], row: str, split: str = "[/,]") -> DataFrame:
    """Each row with the payload of the first of its parts that is a known name."""
    parts = df.select(row, F.posexplode(F.split(F.lower(text), split)).alias("__p", "__x")).withColumn("__x", F.trim("__x"))
    found = parts.join(places.select(F.lower(name).alias("__x"), *payload), "__x").groupBy(row).agg(F.min_by(F.struct(*payload), "__p").alias("__b"))
    return df.join(found, row, "left").select(*df.columns, *[F.col(f"__b.{p}").alias(p) for p in payload])


def with_state(feeds: DataFrame, state: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    joined = feeds.join(state, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def removed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.join(new.select(*keys), list(keys), "left_anti")


def first_of(df: DataFrame, row: str, order: str) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(row).orderBy(order))).filter("__n = 1").drop("__n")
