"""Markup whose tags don't match: a stack automaton that closes what is open, as a fold over its pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import let
from .text import unescape_basic

#: A section of raw text, a comment, a tag, or text between tags.
PIECE = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|<[^<>]*>|[^<]+|<"
NAME = r"^</?\s*([A-Za-z][\w:.\-]*)"
#: Elements that have no end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Pieces folded at a time: what is copied at each step is bounded by them, and not by the text.
PART = 128

_STATE = "struct<stack:array<string>,out:array<string>>"


def _ends(names: Column) -> Column:
    return F.transform(names, lambda n: F.concat(F.lit("</"), n, F.lit(">")))


def _state(stack: Column, out: Column) -> Column:
    return F.struct(stack.alias("stack"), out.alias("out"))


def _step(state: Column, piece: Column) -> Column:
    stack, out = state["stack"], state["out"]
    name = F.regexp_extract(piece, NAME, 1)
    at = F.array_position(F.transform(stack, lambda n: F.lower(n)), F.lower(name)).cast("int")
    closed = _state(F.slice(stack, at + 1, F.size(stack)), F.concat(out, _ends(F.slice(stack, F.lit(1), at))))
    alone = piece.endswith("/>") | F.lower(name).isin(*VOID)
    return (
        F.when(piece == "<", _state(stack, F.concat(out, F.array(F.lit("&lt;")))))
        .when(piece.startswith("<!--"), state)
        .when(name == "", _state(stack, F.concat(out, F.array(piece))))
        .when(piece.startswith("</"), F.when(at > 0, closed).otherwise(state))
        .when(alone, _state(stack, F.concat(out, F.array(F.when(piece.endswith("/>"), piece).otherwise(F.regexp_replace(piece, ">$", "/>"))))))
        .otherwise(_state(F.concat(F.array(name), stack), F.concat(out, F.array(piece))))
        .cast(_STATE)
    )


def close_open(text: Column) -> Column:
    """text with every element closed, in the right order: an end tag closes what was opened after its element too, one
    without an element goes, and what is open at the end is closed there. Elements without content end in />, comments go, and a
    lone < is escaped. Names are compared without case. Null stays null."""
    none = F.array().cast("array<string>")

    def part(state: Column, some: Column) -> Column:
        return F.aggregate(some, _state(state["stack"], none), _step, lambda s: _state(s["stack"], F.concat(state["out"], F.array(F.array_join(s["out"], "")))))

    def whole(pieces: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(pieces)), F.lit(PART)), lambda i: F.slice(pieces, i, F.lit(PART)))
        return F.aggregate(parts, _state(none, none), part, lambda s: F.concat(F.array_join(s["out"], ""), F.array_join(_ends(s["stack"]), "")))

    return F.when(text.isNotNull(), let(F.regexp_extract_all(text, F.lit(PIECE), 0), whole))


#: The fields of an entry; one begins where another wasn't closed.
FIELDS = "title|link|guid|id|description|summary|content|content:encoded|pubDate|published|updated|author|category|enclosure|media:thumbnail|media:content|comments|source"


def field_of(block: Column, *names: str, body: bool = False) -> Column:
    """What the first of some elements of an entry's markup holds; null if none is there or it is empty. An element ends at its
    end tag, or else where another field or the entry's end begins. body: its markup, with everything closed; else its text
    without markup. A section of raw text stays as it is."""

    def inner(name: str) -> Column:
        start, raw = rf"(?is)<{name}(?:\s[^>]*)?(?<!/)>\s*", r"<!\[CDATA\[.*?\]\]>"
        until = F.regexp_extract(block, start + rf"({raw}|.*?(?=</{name}\s*>|<(?:{FIELDS})[\s>/]|</(?:item|entry|channel|feed|rss)\b|\z))", 1)
        closed = [F.regexp_extract(block, start + rf"({raw}|.*?)</{name}\s*>", 1)] if body else []
        return F.coalesce(*[F.nullif(c, F.lit("")) for c in [*closed, until]])

    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")

    def clean(c: Column) -> Column:
        plain = unescape_basic(bare(c)) if body else unescape_basic(bare(F.regexp_replace(c, "<[^>]*>", "")))
        text = F.when(F.contains(c, F.lit("<")), bare(close_open(c))).otherwise(plain) if body else plain
        return F.when(c.startswith("<![CDATA["), F.regexp_extract(c, r"(?s)^<!\[CDATA\[(.*?)\]\]>", 1)).otherwise(text)

    return F.nullif(let(F.coalesce(*[inner(n) for n in names]), clean), F.lit(""))
