"""Per-key top-1, latest-row and top-n operators."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                  n: int = 1, rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..n within each partition by ``order`` (total order expected).

    Meant for already-aggregated inputs (per key x hour): Catalyst inserts a
    partial WindowGroupLimit before the shuffle, so only n rows per group
    and task cross the network.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


_DEC = "decimal(38,0)"
_ID_SHIFT = Decimal(2 ** 63)      # makes any bigint id non-negative
_ID_SPAN = Decimal(10 ** 20)      # > 2**64: room for every shifted id


def time_id_key(df: DataFrame, time: str, id_col: str) -> Column:
    """One exact DECIMAL(38,0) ordering key for (time, id): microseconds since
    the epoch * 10^20 + (id + 2^63). Orders rows like the pair, and fits 38
    digits for any year up to 9999. For TIMESTAMP_NTZ the microseconds are
    plain arithmetic (no time zone), so the order never depends on the
    session clock."""
    if dict(df.dtypes)[time] == "timestamp_ntz":
        t = F.col(time)
        micros = (F.unix_date(F.to_date(t)).cast("long") * 86_400_000_000
                  + F.hour(t).cast("long") * 3_600_000_000
                  + F.minute(t).cast("long") * 60_000_000
                  + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long"))
    else:
        micros = F.unix_micros(F.col(time).cast("timestamp"))
    return (micros.cast(_DEC) * F.lit(_ID_SPAN).cast(_DEC)
            + (F.coalesce(F.col(id_col), F.lit(-(1 << 63))).cast(_DEC) + F.lit(_ID_SHIFT).cast(_DEC)))


def latest_per_key(df: DataFrame, key: str | Sequence[str], time: str, id_col: str,
                   values: Sequence[str]) -> DataFrame:
    """Latest row per key by (time, id) - the id breaks ties on time.

    Each value is ``max_by(value, key)`` over one exact, unique ordering key,
    so all of them come from the same row. Every buffer is a fixed-width
    type, so Spark runs a hash aggregate with partial aggregation: one
    candidate per key and task crosses the shuffle, no sort of raw rows, and
    a hot key never lands whole in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = time_id_key(df, time, id_col)
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), order).alias(c) for c in values])


def argmax_per_group(df: DataFrame, keys: Sequence[str], measure: str, position: str, span: int,
                     values: Sequence[str], totals: dict[str, str] | None = None) -> DataFrame:
    """Per group, the row with the largest ``measure`` (ties -> smallest
    ``position`` in 0..span-1), as an aggregation rather than a window.

    ``measure * span + (span - 1 - position)`` is one exact long that orders
    rows like (measure desc, position asc); each wanted column is
    ``max_by(column, that key)``, and ``totals`` (output -> column) are summed
    over the whole group in the same pass. All buffers are fixed-width, so
    this is a hash aggregate with partial aggregation: at most one row per
    group and task crosses the shuffle, and no sort or window is needed.
    """
    k = F.col(measure).cast("long") * span + (span - 1 - F.col(position).cast("long"))
    return df.groupBy(*keys).agg(
        *[F.max_by(F.col(c), k).alias(c) for c in values],
        *[F.sum(c).alias(out) for out, c in (totals or {}).items()])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n (planned as TakeOrderedAndProject: per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)
