"""Rule builders: catalogs become Columns that Catalyst compiles; nothing is looked up row by row in Python."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, Sequence[str]]]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Whether text (already in the case of words) has one of words as a substring; null text has none."""
    return F.coalesce(reduce(lambda a, b: a | b, (text.contains(w) for w in words)), F.lit(False))


def first_match(text: Column, rules: Rules, default: str | None) -> Column:
    """The label of the first rule with a word in text."""
    out: Column | None = None
    for label, words in rules:
        hit = contains_any(text, words)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def multi_match(text: Column, rules: Rules) -> Column:
    """The labels of all rules with a word in text, in the catalog's order."""
    return F.array_compact(F.array(*[F.when(contains_any(text, words), label) for label, words in rules]))


def additive_score(base: int, rules: Sequence[tuple[int, str, Sequence[str]]], category: Column, text: Column, low: int, high: int) -> Column:
    """base plus the weights of the rules that hold, within low and high."""
    terms = [F.when(category.isin(*words) if kind == "category" else contains_any(text, words), weight).otherwise(0) for weight, kind, words in rules]
    return F.greatest(F.lit(low), F.least(F.lit(high), reduce(lambda a, b: a + b, terms, F.lit(base)))).cast("int")


def lookup(key: Column, table: Mapping[str, object], default: object) -> Column:
    """table[key], or default: a literal map, resolved on the JVM."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def word_pattern(word: str) -> str:
    return rf"\b{re.escape(word)}\b"


def first_word(text: Column, table: Sequence[tuple[str, Column]], flags: str = "") -> Column:
    """The value of the first key that stands in text as a whole word."""
    out: Column | None = None
    for word, value in table:
        hit = text.rlike(flags + word_pattern(word))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(None) if out is None else out
