"""Keys of signals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_link_key(title: Column, link: Column) -> Column:
    return F.md5(F.concat(title, F.lit("|"), link).cast("binary"))


def text_key(text: Column, prefix: str = "") -> Column:
    key = F.md5(text.cast("binary"))
    return F.concat(F.lit(prefix), key) if prefix else key


def sha_key(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def composite_key(prefix: str, *parts: Column) -> Column:
    return F.concat_ws("_", F.lit(prefix), *parts)


def short_key(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.substring(key, 1, 8))
