"""Small tables with every edge case, and plain-Python twins."""

import zlib

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that an operator could use for its own columns.
    T.StructField("score", T.DoubleType()), T.StructField("b", T.IntegerType()), T.StructField("part", T.StringType()),
    T.StructField("label", T.IntegerType()), T.StructField("features", T.StringType()),
    T.StructField("kept", T.BooleanType()), T.StructField("spans", T.StringType())])


def docs_of(spark, rows):
    """``documents`` (with clashing extra columns) of (doc_id, text) rows."""
    return spark.createDataFrame(
        [(i, t, "en", None, None if t is None else len(t), 7.0, 7, "x", 7, "x", True, "x") for i, t in rows], DOCS)


def held(doc_id, remainder=0):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == remainder


LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(20_000))
EDGE = [(1, "one two three four five six seven"), (2, None), (3, ""), (None, "a null id has this text here"),
        (4, " \t\n "), (5, LONG), (6, "one two three four five six seven"), (7, "tie tie tie tie tie tie"),
        (7, "tie tie tie tie tie tie"), (8, "é ñ 漢字 \U0001F600 ok"), (9, "word")]
