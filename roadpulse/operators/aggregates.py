"""Grouped measures over telemetry.

``measure_sums`` is the one aggregation everything builds on. It produces
mergeable partial results (sums, counts, min, max) so a per-hour result can
be rolled up to day or sensor exactly, and Spark runs it as partial
(map-side) plus final aggregation: each task collapses its rows to one row
per group before the shuffle, so a key holding a third of all rows costs no
more shuffle than any other. Means are derived afterwards from exact
integer sums. Unused measures are pruned from the plan by Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import exprs as X
from roadpulse.sources.telemetry import DEFAULT, Cols


SUM_COLUMNS = ("record_count", "vehicle_sum", "vehicle_n", "vehicle_max", "speed_sum", "speed_n",
               "speed_min", "x100_sum", "x100_n", "critical_count", "first_event", "last_event")


def is_sums(df: DataFrame) -> bool:
    """True for a table of ``measure_sums`` rows (for example a materialised
    hourly rollup) rather than raw readings."""
    return set(SUM_COLUMNS) <= set(df.columns)


def measure_sums(df: DataFrame, keys: Sequence[str | Column], cols: Cols = DEFAULT) -> DataFrame:
    """groupBy(keys) -> record_count, vehicle_sum/_n/_max, speed_sum/_n/_min,
    x100_sum/_n (congestion in hundredths), critical_count, first/last_event.

    Given a table that already holds these sums at a finer grain (a
    materialised (sensor, date, hour) rollup), the sums are merged instead,
    exactly, so every operator built on this runs from the rollup as well
    as from raw facts.
    """
    if is_sums(df):
        return rollup_sums(df, keys)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(cols.count).cast("long").alias("vehicle_sum"),
        F.count(cols.count).alias("vehicle_n"),
        F.max(cols.count).alias("vehicle_max"),
        F.sum(cols.speed).cast("long").alias("speed_sum"),
        F.count(cols.speed).alias("speed_n"),
        F.min(cols.speed).alias("speed_min"),
        F.sum(cols.x100).cast("long").alias("x100_sum"),
        F.count(cols.x100).alias("x100_n"),
        F.count_if(F.coalesce(F.col(cols.flag), F.lit(False))).alias("critical_count"),
        F.min(cols.time).alias("first_event"),
        F.max(cols.time).alias("last_event"),
    )


def rollup_sums(sums: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Merge ``measure_sums`` rows to coarser keys (exact)."""
    return sums.groupBy(*keys).agg(
        F.sum("record_count").alias("record_count"),
        F.sum("vehicle_sum").alias("vehicle_sum"),
        F.sum("vehicle_n").alias("vehicle_n"),
        F.max("vehicle_max").alias("vehicle_max"),
        F.sum("speed_sum").alias("speed_sum"),
        F.sum("speed_n").alias("speed_n"),
        F.min("speed_min").alias("speed_min"),
        F.sum("x100_sum").alias("x100_sum"),
        F.sum("x100_n").alias("x100_n"),
        F.sum("critical_count").alias("critical_count"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
    )


def avg_vehicles(prefix: str = "") -> Column:
    return X.exact_mean(f"{prefix}vehicle_sum", f"{prefix}vehicle_n")


def avg_speed(prefix: str = "") -> Column:
    return X.exact_mean(f"{prefix}speed_sum", f"{prefix}speed_n")


def avg_congestion(prefix: str = "") -> Column:
    return X.exact_mean(f"{prefix}x100_sum", f"{prefix}x100_n", 100)


def rounded_int(total: str, n: str) -> Column:
    """Mean rounded half-up to an integer (``AVG(x)::int`` semantics)."""
    return X.div_half_up(total, n).cast("int")


def rounded_2dp(total: str, n: str, scale: int = 1) -> Column:
    """Mean of total / (n * scale) rounded half-up to 2 decimals, as a double."""
    return X.div_half_up(F.col(total) * (100 // scale), n) / F.lit(100)


def window_measures(df: DataFrame, duration: str, cols: Cols = DEFAULT,
                    slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) event-time windows x key.

    Output: window_start, window_end, key, avg_congestion_index,
    avg_vehicle_count, avg_speed, max_vehicle_count, min_speed, record_count.
    The same function serves batch DataFrames and watermarked streams.
    """
    win = F.window(cols.time, duration, slide) if slide else F.window(cols.time, duration)
    agg = df.groupBy(win.alias("window"), F.col(cols.key)).agg(
        F.sum(cols.x100).cast("long").alias("x100_sum"),
        F.count(cols.x100).alias("x100_n"),
        F.sum(cols.count).cast("long").alias("vehicle_sum"),
        F.count(cols.count).alias("vehicle_n"),
        F.sum(cols.speed).cast("long").alias("speed_sum"),
        F.count(cols.speed).alias("speed_n"),
        F.max(cols.count).alias("max_vehicle_count"),
        F.min(cols.speed).alias("min_speed"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col(cols.key),
        avg_congestion().alias("avg_congestion_index"),
        avg_vehicles().alias("avg_vehicle_count"),
        avg_speed().alias("avg_speed"),
        F.col("max_vehicle_count"),
        F.col("min_speed"),
        F.col("record_count"),
    )
