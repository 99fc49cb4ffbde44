"""Registry of the subpackage's queries and their DuckDB twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ("packing", "secrets", "toxicity", "dartminhash", "decontam", "egojoin", "phrases", "ctw",
           "htmltext", "quality", "hypershuffle", "recompression", "spimi")


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"roadpulse.llm.{m}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
