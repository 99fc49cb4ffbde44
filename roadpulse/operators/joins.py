"""Zero-fill joins and join-free gap filling (dense hour grids, hourly resampling).

No join here is hinted to broadcast: every side is an aggregate whose size
depends on the data (number of sensors, span of time), so the choice is left
to AQE, which broadcasts only when the measured runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions import exprs as X


def left_fill(left: DataFrame, right: DataFrame, on: Sequence[str], fill: dict[str, object]) -> DataFrame:
    """left join on ``on``; missing right measures become ``fill`` values."""
    joined = left.join(right, list(on), "left")
    for name, value in fill.items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


STRETCH = "30 DAYS"   # positions of a gap expanded at once; a multiple of any interval step used


def fill_gaps(agg: DataFrame, key_cols: Sequence[str], pos: str, fill: dict[str, object],
              step: int | str = 1, lo=None, hi=None) -> DataFrame:
    """Dense positions per key from an aggregate with one row per (key, pos).

    Each row is expanded to itself plus the empty positions up to the next
    row of its key (``lead``); the first row of a key also covers ``lo`` up to
    itself and the last row covers up to ``hi`` (when given; otherwise a key
    spans its own first to last position). Missing measures take ``fill``.
    No join and no second pass over the input: the window runs on the
    aggregate, whose rows per key are bounded by the output it produces.

    ``step`` is an integer for integer positions or an interval string such
    as ``"1 HOUR"`` for timestamps.
    """
    w = Window.partitionBy(*key_cols).orderBy(pos)
    p = F.col(pos)
    if isinstance(step, str):
        delta = F.expr(f"INTERVAL {step}")
        seq = lambda a, b: F.sequence(a, b, delta)
    else:
        delta = F.lit(step)
        seq = lambda a, b: F.sequence(a, b, F.lit(step))
    nxt, prv = F.lead(p).over(w), F.lag(p).over(w)
    start = p if lo is None else F.when(prv.isNull(), F.lit(lo)).otherwise(p)
    end = F.when(nxt.isNotNull(), nxt - delta).otherwise(p if hi is None else F.lit(hi))
    bounded = agg.withColumn("_start", start).withColumn("_end", end)
    if isinstance(step, str):
        # In two steps, so that no row holds a long gap as one array.
        stretch = F.expr(f"INTERVAL {STRETCH}")
        bounded = (bounded.withColumn("_start", F.explode(F.sequence("_start", "_end", stretch)))
                   .withColumn("_end", F.least(F.col("_end"), F.col("_start") + stretch - delta)))
    spread = bounded.withColumn("_pos", F.explode(seq(F.col("_start"), F.col("_end"))))
    measures = [c for c in agg.columns if c not in (*key_cols, pos)]
    return spread.select(
        *key_cols, F.col("_pos").alias(pos),
        *[F.when(F.col("_pos") == p, F.col(m)).otherwise(F.lit(fill.get(m))).alias(m) for m in measures])


def densify_hours(agg: DataFrame, key_cols: Sequence[str], fill: dict[str, object],
                  hours: int = 24, hour_col: str = "hour_of_day") -> DataFrame:
    """Dense key x hour 0..hours-1 table from a per-(key, hour) aggregate;
    keys are those present in the aggregate, gaps take ``fill``."""
    return fill_gaps(agg, key_cols, hour_col, fill, 1, 0, hours - 1)


def resample_hourly(df: DataFrame, key: str, time: str, measure: str,
                    out_time: str = "bucket", out_measure: str | None = None) -> DataFrame:
    """Per key: contiguous 1-hour buckets from its first to its last event,
    measure summed per bucket, empty buckets 0."""
    out_measure = out_measure or measure
    naive = dict(df.dtypes)[time] == "timestamp_ntz"
    bucket = X.hour_bucket(time, naive)
    if not naive:
        bucket = bucket.cast("timestamp_ntz")
    summed = df.groupBy(key, bucket.alias(out_time)).agg(F.sum(measure).cast("long").alias(out_measure))
    return fill_gaps(summed, [key], out_time, {out_measure: 0}, "1 HOUR")
