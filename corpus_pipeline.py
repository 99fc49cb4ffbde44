"""The corpus pipeline: stages over ``documents``, each a written table.

Every stage takes the rows that the one before it kept and returns rows with
the columns of ``documents``; the last returns the pieces of the packed
sequences.

- toxicity: documents that score 0.5 or more go;
- near duplicates: of each group of near copies the smallest doc_id stays;
- decontamination: documents that contain a benchmark item go;
- secrets: every span found is replaced by ``[SECRET]``; no document goes;
- packing: what is left becomes sequences of 2048 ids.

Rows with null or empty text, null doc_id or further columns pass as the
operators' docstrings say; an empty table gives an empty result. A column
``n_chars`` follows the text when a secret is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import dartminhash, decontam, packing, secrets, toxicity
from roadpulse.llm.common import discard, materialize
from roadpulse.llm.registry import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees do not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return dartminhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    clean = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    n = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(n, "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secrets", replace_secrets), ("packing", pack)]

# Boosted trees, MinHash signatures and online packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole output of the one before it. A stage's table
    is deleted once the next one is written; the result reads the last."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
