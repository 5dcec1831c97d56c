"""Operators for training-data pipelines. Nothing outside this subpackage imports it but __spark_entry__.py and corpus_pipeline.py."""

from __future__ import annotations

import importlib

#: Modules with QUERIES and ORACLES, in the order of their operators.
MODULES = ("quality", "licenses", "bpe", "packing", "toxicity", "chat", "suffix_dedup", "ngram_join", "ogg", "langid", "simhash", "vector_codes", "negatives")


def queries() -> dict:
    return {k: f for m in MODULES for k, f in importlib.import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in importlib.import_module(f"{__name__}.{m}").ORACLES.items()}
