"""Small inputs with every awkward case."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def docs_frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or "")) for r in rows], DOCS)


def as_table(spark, frame, folder, name="documents"):
    frame.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


AWKWARD = [None, "", " ", "\n\n", "a", "é", " ", "\x0b\x0c", "𝒳 𝒴", "ß" * 70_000, "a b c d e f g " * 3_000, "x\ny\nx\n\n \nx"]
