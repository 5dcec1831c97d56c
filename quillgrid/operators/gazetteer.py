"""Names of a gazetteer table in whole texts: a trie matched level by level by joins, the longest match first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

#: A word: letters and digits, as lower case.
WORD = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def trie(gazetteer: DataFrame, name: str = "name", label: str = "label", most: int = 8) -> DataFrame:
    """(depth, node, labels) of each prefix of a name's words: node is the prefix, labels those of names that end there, null
    where none does. Names of over most words, and those without a word, are left out."""
    split = gazetteer.select(F.col(label).alias("label"), words_of(F.col(name)).alias("w")).filter(F.size("w").between(1, most))
    steps = split.select("label", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("depth"))
    node = F.array_join(F.slice("w", F.lit(1), F.col("depth")), " ")
    ends = F.when(F.col("depth") == F.size("w"), F.col("label"))
    return steps.groupBy("depth", node.alias("node")).agg(F.array_sort(F.collect_set(ends)).alias("labels")).withColumn("labels", F.when(F.size("labels") > 0, F.array_join("labels", ",")))


def _levels(at: DataFrame, nodes: DataFrame, depth: int, between: str) -> DataFrame | None:
    """(__r, place, words, name, labels) of the names that begin at the places of at (__r, place, node, rest), where rest are the
    next words, to be added to a node with between before each. Each level is written, and holds only places that a name still fits."""
    open_, found = None, []
    for k in range(1, depth + 1):
        going = at if k == 1 else open_.filter(F.size("rest") >= k - 1).withColumn("node", F.concat("node", F.lit(between), F.element_at("rest", k - 1)))
        level = settle(going.join(nodes.filter(F.col("depth") == k).select("node", "labels"), "node"), f"level{k}")
        found.append(level.filter("labels IS NOT NULL").select("__r", "place", F.lit(k).alias("words"), F.col("node").alias("name"), "labels"))
        open_ = level.drop("labels")
    return reduce(DataFrame.unionByName, found) if found else None


def gazetteer_matches(df: DataFrame, gazetteer: DataFrame, row: str = "id", text: str = "text", name: str = "name", label: str = "label", most: int = 8) -> DataFrame:
    """(row, place, words, name, labels): names in each row's text, from the left, at each place the longest; no two overlap.

    place is that of the first word, from 0; names are as words in lower case, so that case and punctuation between words
    don't matter; labels are joined by commas. Only places where a name begins survive the first level, and those are written, so that
    the deeper levels read little. Both sides of a level are plain tables: a common first word is split by adaptive
    execution. Rows are named by row; null and empty texts have no names.
    """
    nodes = settle(trie(gazetteer, name, label, most), "trie")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    w = F.col("__w")
    tokens = df.select(F.col(row).alias("__r"), words_of(F.col(text)).alias("__w")).select("__r", "__w", F.posexplode("__w").alias("place", "node"))
    rest = F.slice(w, F.col("place") + 2, F.lit(max(depth - 1, 0)))
    found = _levels(tokens.select("__r", "place", "node", rest.alias("rest")), nodes, depth, " ")
    if found is None:
        return df.select(F.col(row), F.lit(0).alias("place"), F.lit(0).alias("words"), F.lit("").alias("name"), F.lit("").alias("labels")).limit(0)
    longest = found.groupBy("__r", "place").agg(F.max_by(F.struct("words", "name", "labels"), "words").alias("m")).select("__r", F.struct("place", "m.words", "m.name", "m.labels").alias("m"))
    each = longest.groupBy("__r").agg(F.array_sort(F.collect_list("m")).alias("m"))
    kind = "array<struct<place:int,words:int,name:string,labels:string>>"
    free = lambda acc, m: (F.size(acc) == 0) | (m["place"] >= F.element_at(acc, -1)["place"] + F.element_at(acc, -1)["words"])
    kept = F.aggregate("m", F.array().cast(kind), lambda acc, m: F.when(free(acc, m), F.concat(acc, F.array(m))).otherwise(acc))
    return each.select(F.col("__r").alias(row), F.inline(kept))


#: A word as regular expressions bound it, with what stands before it.
_BOUND = r"[^\p{L}\p{N}_]*[\p{L}\p{N}_]+"
_BEFORE = r"^[^\p{L}\p{N}_]+"
_WHOLE = r"^[\p{L}\p{N}_](?s:.*[\p{L}\p{N}_])?$"


def _bound(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_BOUND), 0)


def longest_name(df: DataFrame, catalog: DataFrame, row: str, text: str, name: str = "name", most: int = 12) -> DataFrame:
    """(row, name): the longest name of a catalog table that stands in a row's text, case aside, between word boundaries; of equal
    lengths the least. Rows without a name are left out.

    Unlike gazetteer_matches, what stands between a name's words counts ("e/r" isn't "e r"). A trie of the names' beginnings
    is matched level by level, so that the catalog may have any size and a text meets only names that it begins. Names
    that don't begin and end with a letter, digit or underscore, and those of over most words, are left out; row must be
    unique; null and empty texts have no name.
    """
    names = catalog.select(F.lower(F.trim(F.col(name))).alias("name")).filter(F.col("name").rlike(_WHOLE)).distinct()
    split = names.select("name", _bound(F.col("name")).alias("w")).filter(F.size("w") <= most)
    steps = split.select("name", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("depth"))
    ends = F.when(F.col("depth") == F.size("w"), F.lit(True))
    nodes = steps.groupBy("depth", F.array_join(F.slice("w", F.lit(1), F.col("depth")), "").alias("node")).agg(F.max(ends).alias("labels"))
    nodes = settle(nodes, "trie")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    tokens = df.select(F.col(row).alias("__r"), _bound(F.col(text)).alias("__w")).select("__r", "__w", F.posexplode("__w").alias("place", "node"))
    rest = F.slice("__w", F.col("place") + 2, F.lit(max(depth - 1, 0)))
    found = _levels(tokens.select("__r", "place", F.regexp_replace("node", _BEFORE, "").alias("node"), rest.alias("rest")), nodes, depth, "")
    if found is None:
        return df.select(F.col(row), F.lit("").alias("name")).limit(0)
    best = found.groupBy("__r").agg(F.min(F.struct((-F.length("name")).alias("n"), "name")).alias("b"))
    return best.select(F.col("__r").alias(row), F.col("b.name").alias("name"))
