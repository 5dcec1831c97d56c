"""From raw documents to packed token sequences: quality, toxicity, near duplicates, repeated passages, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillgrid.llm.ngram_join import stage_near_duplicates
from quillgrid.llm.packing import stage_pack
from quillgrid.llm.quality import stage_quality
from quillgrid.llm.shared import settle, table
from quillgrid.llm.suffix_dedup import stage_suffix_dedup
from quillgrid.llm.toxicity import stage_toxicity

#: (name, function of (spark, docs, sf_dir)). Each stage's result is written as Parquet and read as the next one's docs.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", stage_quality),
    ("toxicity", stage_toxicity),
    ("near_duplicates", stage_near_duplicates),
    ("suffix_dedup", stage_suffix_dedup),
    ("packing", stage_pack),
]

#: No SQL: the classifier, the joins and the packing can't be said in it. The tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents; the packed pieces of what they keep.

    Null and empty texts, ids that are null or repeat, and empty tables get what the stages' docstrings say; a table that
    a stage leaves empty gives no pieces.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, name)
    return docs
