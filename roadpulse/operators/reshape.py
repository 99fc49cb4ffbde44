"""Pivots with explicit value lists (one aggregation pass, no value discovery job)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def pivot_wide(df: DataFrame, row_keys: Sequence[str], pivot_col: str, values: Sequence,
               agg: Column, names: Sequence[str] | None = None) -> DataFrame:
    """groupBy(row_keys).pivot(pivot_col, values).agg(agg), columns renamed to ``names``.

    The value list is a parameter: Spark then skips the distinct-values job,
    and the output schema is fixed whatever the data holds. With many keys
    keep the long (key, pivot, value) form instead.
    """
    out = df.groupBy(*row_keys).pivot(pivot_col, list(values)).agg(agg)
    if names:
        for v, name in zip(values, names):
            out = out.withColumnRenamed(str(v), name)
    return out
