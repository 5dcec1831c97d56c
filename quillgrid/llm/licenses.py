"""License scans: Aho-Corasick finds notice phrases and identifier tags, a shunting-yard parser evaluates tag expressions."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_rows, table, utf8

#: Phrases that the contract names, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: More notice phrases of well-known licences.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
#: Identifier tags, as words.
TAGS = ("spdx license identifier",)
#: Licences (lower case) that a policy permits unless told otherwise.
PERMITTED = frozenset("mit mit-0 apache-2.0 bsd-2-clause bsd-3-clause isc zlib bsl-1.0 cc0-1.0 cc-by-4.0 cc-by-3.0 unlicense 0bsd".split())
#: What a tag, a notice and a bare mention each say about the text being under a licence.
TAG_SCORE, NOTICE_SCORE, MENTION_SCORE = 1.0, 0.9, 0.6
#: Words that, shortly before a phrase, make it a notice.
NOTICE_WORDS = frozenset(b"licensed released under distributed terms licence license redistribute".split())

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORDS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in _LOWER)
_TAG = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*([^\n]*)")
_TOKEN = re.compile(rb"\(|\)|[A-Za-z0-9.+\-:]+")


def parse_expression(text: str) -> list[str] | None:
    """Reverse Polish form of a licence expression by the shunting-yard method; None if it is malformed.

    `with` binds closest, then `and`, then `or`. Reading stops where an operand follows an operand, so prose after the
    expression is no error.
    """
    power = {"or": 1, "and": 2, "with": 3}
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether the last token was one, or closed one
    for m in _TOKEN.finditer(text.encode("utf-8", "replace")):
        raw = m[0].decode("ascii")
        token = raw.lower()
        if token in power:
            if not operand:
                return None
            while stack and stack[-1] != "(" and power[stack[-1]] >= power[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = False
        elif token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            if operand:
                break
            out.append(token.rstrip("."))
            operand = True
    while stack:
        if (op := stack.pop()) == "(":
            return None
        out.append(op)
    return out if out and operand else None


def evaluate_expression(rpn: list[str], permitted: frozenset[str] = PERMITTED) -> bool:
    """Whether a choice that the expression leaves open needs permitted licences only. An exception only adds freedom to its
    licence, and permits nothing alone; "+" (or later) is permitted where the licence is."""
    stack: list[bool] = []
    for token in rpn:
        if token in ("or", "and", "with"):
            b, a = stack.pop(), stack.pop()
            stack.append(a or b if token == "or" else a and b if token == "and" else a)
        else:
            stack.append(token.rstrip("+") in permitted)
    return stack[-1]


@lru_cache(maxsize=4)
def _automaton(phrases: tuple[tuple[str, str], ...], tags: tuple[str, ...]):
    """Over words joined by single blanks; bytes stand as code points below 256."""
    found = ahocorasick.Automaton()
    for phrase, label in phrases:
        key = f" {phrase} ".encode().decode("latin-1")
        found.add_word(key, (label, phrase in BASE_PHRASES, len(key), False))
    for tag in tags:
        key = f" {tag} ".encode().decode("latin-1")
        found.add_word(key, (tag, False, len(key), True))
    found.make_automaton()
    return found


def scan_text(raw: bytes, phrases: tuple[tuple[str, str], ...], tags: tuple[str, ...] = TAGS, permitted: frozenset[str] = PERMITTED) -> dict:
    """What the scan finds in one text: places, labels, expressions, score."""
    words = raw.translate(_WORDS).split()
    joined = (b" " + b" ".join(words) + b" ") if words else b""
    as_text = joined.decode("latin-1")
    base, labels, places, expressions, score, tagged = set(), set(), [], [], 0.0, False
    n_base, first, last = 0, None, None
    seen, at = 0, -1  # the number of blanks before byte seen, less one: counted on from the last match, not from the start
    for end, (label, is_base, length, is_tag) in _automaton(phrases, tags).iter(as_text):
        start = end - length + 1
        if is_tag:
            tagged = True
            continue
        at += joined.count(b" ", seen, start + 1) if start >= seen else -joined.count(b" ", start + 1, seen)
        seen = start + 1
        labels.add(label)
        places.append({"word": at, "label": label})
        notice = bool(NOTICE_WORDS.intersection(words[max(0, at - 6) : at]))
        score = max(score, NOTICE_SCORE if notice else MENTION_SCORE)
        if is_base:
            base.add(label)
            n_base += 1
            first = at if first is None else min(first, at)
            last = at if last is None else max(last, at)
    if tagged:
        for m in _TAG.finditer(raw.translate(_LOWER)):
            expression = m[1].decode("utf-8", "replace").strip()
            if rpn := parse_expression(expression):
                ok = evaluate_expression(rpn, permitted)
                expressions.append({"expression": expression, "rpn": " ".join(rpn), "permitted": ok})
                labels |= {f"spdx:{x}" for x in rpn if x not in ("or", "and", "with")}
                score = max(score, TAG_SCORE)
    return {
        "n_words": len(words),
        "n_base": n_base,
        "first_word": first,
        "last_word": last,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "places": sorted(places, key=lambda x: (x["word"], x["label"])),
        "expressions": expressions,
        "permitted": all(x["permitted"] for x in expressions) if expressions else None,
        "score": score,
    }


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, places array<struct<word:long,label:string>>, "
    "expressions array<struct<expression:string,rpn:string,permitted:boolean>>, permitted boolean, score double"
)


def license_scan(docs: DataFrame, text: str = "text", phrases: dict[str, str] | None = None, tags: tuple[str, ...] = TAGS, permitted: frozenset[str] = PERMITTED) -> DataFrame:
    """docs with SCHEMA's columns, which replace own columns of these names.

    Null and empty texts: no words, no places, empty labels, score 0. Overlapping phrases all count. Repeated rows get the
    same result each; an empty table gives an empty table. permitted is null where no expression was found.
    """
    chosen = tuple(sorted({**MORE_PHRASES, **BASE_PHRASES}.items() if phrases is None else phrases.items()))
    return map_rows(docs, [text], SCHEMA, lambda column: (scan_text(raw, chosen, tags, permitted) for raw in utf8(column)))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", F.size("expressions").alias("n_expressions"), "permitted", "score")


QUERIES = {"op2_license_scan": op2_license_scan}
ORACLES: dict[str, str] = {}
