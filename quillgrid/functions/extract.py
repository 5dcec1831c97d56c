"""Entities of dispatch texts, by regular expressions on the JVM. The patterns are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .catalogs import FACILITIES
from .rules import first_word, let

NAME_AGE = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,4})\s*\((\d{1,3})\)"
AGE_NAME = r"(\d{1,3})-year-old\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,4})"
NAME_YOA = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,4})\s+(\d{1,3})\s+YOA"
BAC = r"(?i)(\d*\.\d+)\s*Br?AC"
CHARGES = (
    r"(?i)(?:charges?\s+of|arrested\s+for|arrested\s+on\s+charges?\s+of|cited\s+for|charged\s+with|remanded\s+for)\s+"
    r"([^.!?\n]{3,200}?)(?:\.\s|\band\s+(?:was\s+)?(?:transport|remand|taken|held|booked)|$)"
)
CHARGE_SPLIT = r",\s*(?:and\s+)?|\s+and\s+"
NO_BAIL, BAIL_SET = r"(?i)\bno\s+bail\b|\bwithout\s+bail\b", r"(?i)bail\s+(?:was\s+)?set\s+at\s+\$?([\d,]+)"
RELEASED_OR, CITED = r"(?i)\breleased\s+(?:on\s+recognizance|OR\b|without\s+bail|with\s+no\s+bail)", r"(?i)\bcitation\b|\bcited\b"
OUTCOMES = [
    ("arrested", r"(?i)\barrested\b"),
    ("rescued", r"(?i)\bsafely\s+(?:recovered|located|found|rescued)\b"),
    ("fatal", r"(?i)\bdeceased\b|\bdied\b|\bfatally\b|\bdeath\b"),
    ("cited", r"(?i)\bcited\b|\bcitation\b"),
    ("released", r"(?i)\breleased\b"),
    ("investigation_ongoing", r"(?i)\binvestigation\s+(?:is\s+)?ongoing\b|\bunder\s+investigation\b"),
    ("referred", r"(?i)\breferred\b|\brefer\b"),
]
MISSING = r"(?i)\b(?:missing person|silver alert|amber alert|search and rescue|sar)\b"
INCIDENT_TIME = r"[Oo]n\s+(\d{1,2}/\d{1,2}/\d{4})[,\s]+at\s+(?:approximately\s+)?(\d{3,4})\s+hours?"
ASSISTANCE, AGENCY_SPLIT = r"(?i)with\s+(?:the\s+)?assistance\s+of\s+([^.!?\n]{5,200})", r",\s*|\s+and\s+"
ADDRESS = (
    r"(?i)(?:on|at|near)\s+([A-Z][a-zA-Z0-9 ]+(?:Drive|Road|Rd|Street|St|Avenue|Ave|Way|Loop|Highway|Hwy|Boulevard|Blvd|Lane|Ln|Circle|Place|Trail|Path)"
    r"[^,\n.]{0,40})"
)
MILE = r"(?i)(?:near\s+)?mile\s+(\d+(?:\.\d+)?)\s+(?:of\s+)?(?:the\s+)?([A-Z][a-zA-Z ]+(?:Highway|Hwy))"
CONTRABAND = ["meth", "methamphetamine", "heroin", "fentanyl", "cocaine", "firearm", "handgun", "rifle", "shotgun"]
LEGACY_OF = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\s*,\s*(\d{2})\s*,\s*of\s+([A-Z][a-z]+)"
LEGACY_ARREST = r"arrested\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\s*\(?(\d{2})?\)?"
LEGACY_CHARGES = r"(?i)(?:charges? of|remanded for|arrested for)\s+([^.!?]{5,100})"
FIELD_LOCATION, FIELD_TYPE = r"(?i)Location[:\s]+([^\n]+)", r"(?i)Type[:\s]+([^\n]+)"
FIELD_TEXT, FIELD_POSTED, FIELD_OFFICER = r"(?i)Dispatch Text[:\s]+([\s\S]+?)(?:Posted on|$)", r"(?i)Posted on ([^\n]+)", r"(?i)by\s+DPS\\+(.+?)$"
AGE_FIELD, BORN_FIELD = r"(?i)(?:Age|AGE)[\s:]*([0-9]{1,3})", r"(?i)(?:DOB|Date of Birth)[\s:]*([0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4})"

SUSPECT = "struct<name:string,age:int>"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null if there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _people(text: Column, pattern: str, name: int, age: int, bounded: bool) -> Column:
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), name),
        F.regexp_extract_all(text, F.lit(pattern), age),
        lambda n, a: F.struct(F.trim(n).alias("name"), a.try_cast("int").alias("age")),
    )
    return F.filter(pairs, lambda p: p["age"].between(5, 100)) if bounded else pairs


def _once(people: Column) -> Column:
    """The first of each name."""
    pick = lambda all_: let(F.transform(all_, lambda q: q["name"]), lambda names: F.filter(all_, lambda p, i: F.array_position(names, p["name"]) == i + 1))
    return let(people, pick)


def suspects(text: Column) -> Column:
    """array<struct<name, age>> by the three patterns in turn, each name once; ages of the third aren't bounded."""
    return _once(F.concat(_people(text, NAME_AGE, 1, 2, True), _people(text, AGE_NAME, 2, 1, True), _people(text, NAME_YOA, 1, 2, False)))


def legacy_suspects(text: Column) -> Column:
    return _once(F.concat(_people(text, LEGACY_OF, 1, 2, False), _people(text, LEGACY_ARREST, 1, 2, False)))


def legacy_charges(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(LEGACY_CHARGES), 1), lambda c: F.trim(c))


def blood_alcohol(text: Column) -> Column:
    return F.regexp_extract(text, BAC, 1).try_cast("double")


def charges(text: Column) -> Column:
    raw = F.regexp_replace(F.trim(F.regexp_extract(text, CHARGES, 1)), "[,. ]+$", "")
    return F.filter(F.transform(F.split(raw, CHARGE_SPLIT), lambda p: F.regexp_replace(F.trim(p), r"\.+$", "")), lambda p: F.length(p) > 2)


def facility(text: Column, table: Sequence[tuple[str, str]] = FACILITIES) -> Column:
    return first_word(text, [(code, F.struct(F.lit(code).alias("code"), F.lit(name).alias("name"))) for code, name in table], "(?i)")


def bail(text: Column) -> Column:
    """struct<status, amount>."""
    row = lambda status, amount=None: F.struct(F.lit(status).alias("status"), (F.lit(None).cast("string") if amount is None else amount).alias("amount"))
    amount = F.replace(F.regexp_extract(text, BAIL_SET, 1), F.lit(","), F.lit(""))
    return (
        F.when(text.rlike(NO_BAIL), row("denied")).when(text.rlike(BAIL_SET), row("set", amount)).when(text.rlike(RELEASED_OR), row("released_OR")).when(text.rlike(CITED), row("cited_released")).otherwise(row("unknown"))
    )


def outcome(text: Column) -> Column:
    out = None
    for label, pattern in OUTCOMES:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return out.otherwise("unknown")


def is_missing_person(text: Column) -> Column:
    return F.coalesce(text.rlike(MISSING), F.lit(False))


def incident_time(text: Column) -> Column:
    return F.try_to_timestamp(F.concat(_found(text, INCIDENT_TIME), F.lit(" "), F.lpad(F.regexp_extract(text, INCIDENT_TIME, 2), 4, "0")), F.lit("M/d/yyyy HHmm"))


def co_agencies(text: Column) -> Column:
    raw = F.regexp_replace(F.trim(F.regexp_extract(text, ASSISTANCE, 1)), r"\.+$", "")
    return F.filter(F.transform(F.split(raw, AGENCY_SPLIT), lambda a: F.trim(a)), lambda a: F.length(a) > 3)


def address_detail(text: Column) -> Column:
    mile = F.concat(F.lit("Mile "), _found(text, MILE, 1), F.lit(" "), F.trim(F.regexp_extract(text, MILE, 2)))
    return F.coalesce(F.trim(_found(text, ADDRESS)), mile)


def contraband(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(F.lower(text).rlike(rf"\b{w}\b"), w) for w in CONTRABAND]))


def dispatch_fields(block: Column) -> dict[str, Column]:
    """location, type, text, posted, officer of a dispatch block; null where a field is missing."""
    posted = _found(block, FIELD_POSTED)
    return {
        "location": F.trim(_found(block, FIELD_LOCATION)),
        "type": F.trim(_found(block, FIELD_TYPE)),
        "text": F.trim(F.regexp_replace(_found(block, FIELD_TEXT), r"(?U)\s+", " ")),
        "posted": F.trim(posted),
        "officer": F.trim(_found(posted, FIELD_OFFICER)),
    }


def age_and_birth(text: Column) -> tuple[Column, Column]:
    return F.regexp_extract(text, AGE_FIELD, 1).try_cast("int"), _found(text, BORN_FIELD)


def bulletin_age(text: Column, as_of: Column) -> Column:
    """The age that a bulletin names, else that of its date of birth on as_of's day, else 0."""
    from .times import age_on, parse_any

    age, born = age_and_birth(text)
    day = F.to_date(parse_any(F.replace(born, F.lit("-"), F.lit("/")), "M/d/yyyy", "M/d/yy"))
    return F.coalesce(age, age_on(day, F.to_date(as_of)), F.lit(0))


#: Words before a person's name, in a rank or a role; a rule of our own, in place of a language model.
TITLES = "Mr|Mrs|Ms|Dr|Trooper|Officer|Sergeant|Sgt|Lieutenant|Lt|Captain|Capt|Chief|Deputy|Detective|Investigator|[Ss]uspect|[Vv]ictim|[Dd]river|[Pp]assenger|identified as"
#: Words that end the name of a vehicle, and characters kept before them.
VEHICLES = ("truck", "sedan", "suv", "snowmachine", "atv", "motorcycle", "skiff", "vessel")
BEFORE = 15


def people(text: Column, known: Column | None = None, titles: str = TITLES) -> Column:
    """Names (capitalised words, at least five characters) behind a title or role, each once in order; those of known, an
    array of names, that contain one or are contained go. Null text has none."""
    found = F.regexp_extract_all(text, F.lit(rf"\b(?:{titles})\.?\s+((?:[A-Z][a-z]+)(?:\s+(?:[A-Z]\.|[A-Z][a-z]+)){{0,2}})"), 1)
    names = F.array_distinct(F.filter(F.transform(found, lambda n: F.regexp_replace(n, r"\s+", " ")), lambda n: F.length(n) > 4))
    if known is not None:
        names = F.filter(names, lambda n: ~F.exists(F.coalesce(known, F.array().cast("array<string>")), lambda k: F.contains(k, n) | F.contains(n, k)))
    return F.coalesce(names, F.array().cast("array<string>"))


def vehicles(text: Column, words: Sequence[str] = VEHICLES) -> Column:
    """Vehicles: each of words with the BEFORE characters before it, from the first capital on; of over three characters, each
    once in order. Null text has none."""
    one = "|".join(words)
    # Cut behind each word; the last part has none. (A pattern for the parts would scan a text's end again and again.)
    parts = let(F.split(text, rf"(?i)(?<=\b(?:{one})\b)"), lambda p: F.slice(p, F.lit(1), F.size(p) - 1))
    # Each part ends with a word, of two letters or more: so many parts hold the characters before the last one's.
    reach = BEFORE // 2 + 2
    phrase = lambda p, i: _phrase(F.array_join(F.slice(p, F.greatest(F.lit(1), i + 2 - reach), F.least(i + 1, F.lit(reach))), ""), one)
    found = let(parts, lambda p: F.transform(p, lambda _, i: phrase(p, i)))
    kept = F.filter(found, lambda v: F.length(v) > 3)
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def _phrase(before: Column, one: str) -> Column:
    def cut(tail: Column) -> Column:
        n = F.length(F.regexp_extract(tail, rf"(?is)\b({one})$", 1)) + BEFORE
        return F.regexp_replace(F.trim(F.substring(tail, F.greatest(F.lit(1), F.length(tail) - n + 1), n)), "^[^A-Z]*", "")

    # The words searched have fewer characters than BEFORE: the end of a long part is enough.
    return let(before, lambda b: let(F.right(b, F.lit(4 * BEFORE)), cut))


def height(text: Column) -> Column:
    """A height in inches: 5'11", 5 ft 11 in, 5-11 behind the word height, else null."""
    found = F.regexp_extract(text, r"(?i)\b([4-7])\s*(?:'|ft\.?|feet|foot)\s*(?:(1[01]|[0-9])\s*(?:\"|''|in(?:ches|\.)?)?)?", 0)
    spoken = F.regexp_extract(text, r"(?i)\bheight:?\s*([4-7])\s*[-']\s*(1[01]|[0-9])\b", 0)
    one = F.coalesce(F.nullif(spoken, F.lit("")), F.nullif(found, F.lit("")))
    numbers = F.regexp_extract_all(one, F.lit("[0-9]+"), 0)
    return F.element_at(numbers, 1).cast("int") * 12 + F.coalesce(F.try_element_at(numbers, F.lit(2)).cast("int"), F.lit(0))


def entities(text: Column) -> Column:
    """All of it as one struct."""
    parts = {
        "suspects": suspects(text), "charges": charges(text), "bac": blood_alcohol(text), "facility": facility(text), "bail": bail(text), "outcome": outcome(text),
        "incident_time": incident_time(text), "co_agencies": co_agencies(text), "address_detail": address_detail(text), "is_missing_person": is_missing_person(text),
        "drugs_weapons": contraband(text), "vehicles": vehicles(text), "people": people(text, F.transform(suspects(text), lambda x: x["name"])),
    }
    return F.struct(*[c.alias(k) for k, c in parts.items()])
