"""Distinct counts that merge: HyperLogLog sketches per group, kept in a
rollup, united over any set of groups without the raw rows.

``lg`` sets the size: 2^lg registers, an error of about 1 / sqrt(2^lg)
whatever the number of rows. Exact counts stay the default elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG = 16
SUFFIX = "_sketch"


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], lg: int = LG) -> DataFrame:
    """One row per group with a sketch of each column's values; nulls don't
    count. Tasks send one sketch per group, never values."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c, lg).alias(c + SUFFIX) for c in columns])


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups."""
    columns = [c for c in sketches.columns if c.endswith(SUFFIX)]
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame) -> DataFrame:
    """Sketch columns as the numbers of distinct values they stand for."""
    return sketches.select(*[F.hll_sketch_estimate(c).alias(f"distinct_{c.removesuffix(SUFFIX)}")
                             if c.endswith(SUFFIX) else F.col(c) for c in sketches.columns])
