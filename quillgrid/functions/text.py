"""Text projections as Columns, and the two that need Python (full entity decoding)."""

from __future__ import annotations

import html
from collections.abc import Sequence
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .catalogs import AGENCY_CITY, AGENCY_CITY_WORDS, AGENCY_NOISE, AGENCY_UNKNOWN, SNIPPET_EMPTY
from .rules import contains_any

#: The patterns that make text of markup. (?U) lets white space include what Unicode has.
SCRIPT, STYLE, TAG, SPACE = r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"<[^>]+>", r"(?U)\s+"
#: Shares and bounds of a snippet.
SNIPPET_SHARE, SNIPPET_LEAST, SNIPPET_MOST = 0.10, 300, 1000
#: Entities that unescape_basic decodes; &amp; comes last, so that nothing is decoded twice.
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))

#: The named entities that a feed's healing decodes; their characters are those of HTML.
FEED_ENTITIES = """
nbsp mdash ndash ldquo rdquo lsquo rsquo hellip bull trade reg copy deg middot laquo raquo eacute egrave ecirc agrave acirc
ocirc uuml ouml auml szlig ntilde ccedil euro pound yen frac12 frac14 frac34 times divide plusmn micro para sect dagger
Dagger permil ensp emsp thinsp zwnj zwj lrm rlm shy
""".split()


def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def html_unescape(text: Column) -> Column:
    """All HTML entities, by Python's table, in Arrow batches; the native unescape_basic does for machine-made markup."""
    return F.pandas_udf(_unescape, "string")(text)


def unescape_basic(text: Column) -> Column:
    for code, plain in BASIC_ENTITIES:
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def strip_markup(text: Column) -> Column:
    """Script and style bodies and tags become blanks, white space is folded and trimmed."""
    for pattern in (SCRIPT, STYLE, TAG):
        text = F.regexp_replace(text, pattern, " ")
    return F.regexp_replace(F.regexp_replace(text, SPACE, " "), "^ | $", "")


def clean_text(raw: Column, decode=unescape_basic) -> Column:
    """Plain text of markup; null is empty. decode=html_unescape decodes every entity, in an Arrow batch."""
    return F.coalesce(strip_markup(decode(raw)), F.lit(""))


def strip_tags(raw: Column) -> Column:
    """Tags out, the rest trimmed."""
    return F.trim(F.regexp_replace(raw, TAG, ""))


def snippet_of_clean(text: Column) -> Column:
    """A share of clean text, with a floor and a cap; an ellipsis marks a cut, a fixed sentence stands for nothing."""
    n = F.length(text)
    limit = F.least(F.lit(SNIPPET_MOST), F.greatest(F.least(F.lit(SNIPPET_LEAST), n), F.floor(n * SNIPPET_SHARE).cast("int")))
    cut = F.concat(F.rtrim(F.substring(text, F.lit(1), limit)), F.when(n > limit, "...").otherwise(""))
    return F.when(F.coalesce(n, F.lit(0)) == 0, SNIPPET_EMPTY).otherwise(cut)


def snippet(raw: Column, decode=unescape_basic) -> Column:
    return snippet_of_clean(clean_text(raw, decode))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def data_tag(region: Column, category: Column) -> Column:
    return F.concat(F.lit("[Region: "), region, F.lit("] [Category: "), category, F.lit("]"))


def tag_values(tag: Column) -> Column:
    """All values of a data tag."""
    return F.regexp_extract_all(tag, F.lit(r":\s*([^\]]+)\]"), 1)


def tag_region(tag: Column) -> Column:
    return F.nullif(F.regexp_extract(tag, r"\[Region:\s*([^\]]+)\]", 1), F.lit(""))


def truncate(text: Column, most: int, keep: int | None = None, mark: str = "...", always: bool = False) -> Column:
    """The first keep characters (most by default) and mark, if text has more than most; always: mark in any case."""
    cut = F.concat(F.substring(text, 1, most if keep is None else keep), F.lit(mark))
    return cut if always else F.when(F.length(text) > most, cut).otherwise(text)


def clean_agency(agency: Column) -> Column:
    """An agency's place: upper case, parts of names cut out in order, one city's words, then title case."""
    s = F.upper(agency)
    for part in AGENCY_NOISE:
        s = F.replace(s, F.lit(part), F.lit(""))
    titled = F.initcap(F.trim(s))
    known = F.when(contains_any(s, AGENCY_CITY_WORDS), AGENCY_CITY).when(titled == "", AGENCY_UNKNOWN).otherwise(titled)
    return F.when(F.coalesce(agency, F.lit("")) == "", AGENCY_UNKNOWN).otherwise(known)


def strip_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def join_parts(sep: str, *parts: Column) -> Column:
    """The parts that aren't empty, joined."""
    return F.concat_ws(sep, *[F.nullif(p, F.lit("")) for p in parts])


def decode_bytes(raw: Column) -> Column:
    """Text of bytes as UTF-8 without the bytes that aren't; a U+FFFD that the source has stays. The control character that
    holds its place meanwhile goes, as strip_controls would have it."""
    bad, held = F.lit("\ufffd"), F.lit("\x01")
    s = F.replace(F.replace(raw.cast("string"), held, F.lit("")), bad, held)
    return F.replace(F.replace(F.make_valid_utf8(s), bad, F.lit("")), held, bad)


def decode_entities(text: Column, names: Sequence[str] = FEED_ENTITIES) -> Column:
    """Named entities to characters, only those that a text has, one after another."""
    chars = F.create_map(*[F.lit(x) for n in names for x in (n, chr(name2codepoint[n]))])
    found = F.array_distinct(F.regexp_extract_all(text, F.lit("&([A-Za-z]+[0-9]*);"), 1))
    return F.aggregate(found, text, lambda t, n: F.coalesce(F.replace(t, F.concat(F.lit("&"), n, F.lit(";")), F.try_element_at(chars, n)), t))


def heal_xml(text: Column, names: Sequence[str] = FEED_ENTITIES) -> Column:
    """Text of a broken feed made parsable: byte-order marks and control characters out, named entities decoded, bare
    ampersands escaped, in this order."""
    healed = decode_entities(strip_controls(F.regexp_replace(text, "^\ufeff+", "")), names)
    return F.regexp_replace(healed, r"&(?!(?:amp|lt|gt|apos|quot|#[0-9]+|#x[0-9a-fA-F]+);)", "&amp;")


def xml_escape(text: Column) -> Column:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text
