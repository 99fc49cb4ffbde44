"""Batch sources: driver tables and the canonical telemetry view.

Facts are read column-pruned from parquet; every time filter is expressed
as a range on the raw timestamp column so it reaches the scan as a pushed
filter (and, on a table partitioned by ``event_date``, prunes partitions).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.functions import exprs as X


@dataclass(frozen=True)
class Cols:
    """Column roles, so operators run over any telemetry-shaped table."""
    key: str = "sensor_id"
    time: str = "event_time"
    count: str = "vehicle_count"
    speed: str = "avg_speed"
    congestion: str = "congestion_index"
    x100: str = "congestion_x100"
    flag: str = "traffic_status"
    hour: str = "hour_of_day"
    date: str = "event_date"
    id: str = "event_id"


DEFAULT = Cols()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """Canonical sensor readings derived from the driver's ``events`` table.

    sensor_id = "J" + (user_id % 20 + 1); event_time = ts;
    vehicle_count = floor(value) + 10; avg_speed = props.k % 58 + 3.
    """
    # Extract one field as text, then cast (NULL when missing or not an integer).
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("J"), (F.col("user_id") % P.SENSOR_BUCKETS + 1).cast("string")).alias("sensor_id"),
        F.col("ts").alias("event_time"),
        (F.floor("value").cast("int") + P.COUNT_OFFSET).alias("vehicle_count"),
        (k % P.SPEED_MODULUS + P.SPEED_OFFSET).alias("avg_speed"),
    )


def enrich(df: DataFrame, cols: Cols = DEFAULT, critical_speed: int = P.CRITICAL_SPEED) -> DataFrame:
    """Add congestion (hundredths and index), critical flag, hour and date.

    A congestion index already present (from the wire) is kept; otherwise it
    is computed from count / speed, rounded half-up to 2 decimals.
    """
    if cols.congestion in df.columns:
        df = df.withColumn(cols.x100, X.x100_from_index(cols.congestion))
    else:
        df = df.withColumn(cols.x100, X.congestion_x100(cols.count, cols.speed)) \
               .withColumn(cols.congestion, X.congestion_from_x100(cols.x100))
    return (df
            .withColumn(cols.flag, X.critical_flag(cols.speed, critical_speed))
            .withColumn(cols.hour, X.hour_of_day(cols.time))
            .withColumn(cols.date, X.event_date(cols.time)))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched telemetry facts from the driver tables."""
    return enrich(telemetry_from_events(load_table(spark, sf_dir, "events")))


def alerts_of(facts_df: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """The alerts table: facts flagged critical (same predicate as the flag)."""
    return facts_df.filter(F.col(cols.flag))


def day_range(cols: Cols, day) -> "F.Column":
    """Predicate for one calendar day as a range on the raw time column."""
    start = F.lit(day).cast("timestamp_ntz")
    return (F.col(cols.time) >= start) & (F.col(cols.time) < F.date_add(F.lit(day), 1).cast("timestamp_ntz"))


def on_day(df: DataFrame, day, cols: Cols = DEFAULT) -> DataFrame:
    """Rows of one calendar day: a pushed-down time range on readings and,
    where the date is a column, its value, which prunes the partitions of a
    stored table; on a table of sums (no per-reading time) the date alone."""
    same_date = F.col(cols.date) == F.lit(day)
    if cols.time not in df.columns:
        return df.filter(same_date)
    df = df.filter(day_range(cols, day))
    return df.filter(same_date) if cols.date in df.columns else df


def trailing(df: DataFrame, as_of_ts, days: int, cols: Cols = DEFAULT) -> DataFrame:
    """Rows of [as_of - days, as_of), with the matching range of the date
    column, where there is one, for partition pruning."""
    out = df.filter(trailing_range(cols, as_of_ts, days))
    if cols.date not in df.columns:
        return out
    first = (as_of_ts - dt.timedelta(days=days)).date()
    return out.filter((F.col(cols.date) >= F.lit(first)) & (F.col(cols.date) <= F.lit(as_of_ts.date())))


def trailing_range(cols: Cols, as_of_ts, days: int) -> "F.Column":
    """Predicate for [as_of - days, as_of) on the raw time column."""
    # From ISO text: a naive Python datetime literal would be converted with
    # the driver process's local time zone.
    end = F.lit(as_of_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {int(days)} DAYS")
    return (F.col(cols.time) >= start) & (F.col(cols.time) < end)


STORE_KIND = "kind"


def _read_one(spark: SparkSession, path: str, kind: str) -> DataFrame:
    df = spark.read.parquet(path)
    if STORE_KIND in df.columns:       # single store written by start_store_sink
        df = df.filter(F.col(STORE_KIND) == kind).drop(STORE_KIND)
        if kind != "quarantine":
            df = df.drop("reject_reason", "raw_message")
    return df


def _read_kind(spark: SparkSession, path, kind: str) -> DataFrame:
    """One table, or the union of several (a live store plus backfill
    stores). Each path is read on its own so a file-sink store is listed
    through its metadata log."""
    paths = [p for p in (path.split(",") if isinstance(path, str) else path) if p]
    out = _read_one(spark, paths[0], kind)
    for p in paths[1:]:
        out = out.unionByName(_read_one(spark, p, kind), allowMissingColumns=True)
    return out


def read_facts(spark: SparkSession, path) -> DataFrame:
    """Stored facts: a table partitioned by event_date (and writer, batch_id
    from the foreachBatch sink), or the ``kind=fact`` rows of a single store; several
    paths (list or comma-separated) are read and unioned. Day
    filters prune partitions. Congestion in integer hundredths is derived
    from the stored index."""
    df = _read_kind(spark, path, "fact")
    if DEFAULT.x100 not in df.columns:
        df = df.withColumn(DEFAULT.x100, X.x100_from_index(DEFAULT.congestion))
    return df


def read_alerts(spark: SparkSession, path) -> DataFrame:
    return _read_kind(spark, path, "alert")


def read_quarantine(spark: SparkSession, path) -> DataFrame:
    return _read_kind(spark, path, "quarantine")


def newest(spark: SparkSession, path, df: DataFrame, n: int, kind: str | None = None,
           cols: Cols = DEFAULT) -> DataFrame:
    """``df`` (read from ``path``) cut to its newest dates that hold ``n`` rows
    or more, found by walking the date partitions from the newest on. Times
    never precede their date, so the latest ``n`` rows are all in there."""
    dates = partition_dates(spark, path, kind, cols.date)
    found = 0
    for day in sorted(dates, reverse=True):
        found += df.filter(F.col(cols.date) == F.lit(day)).limit(n - found).count()
        if found >= n:
            return df.filter(F.col(cols.date) >= F.lit(day))
    return df


def partition_dates(spark: SparkSession, path, kind: str | None = None, column: str = DEFAULT.date) -> set:
    """Dates that a stored table has partitions of (folder names only)."""
    out = set()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for one in [p for p in (path.split(",") if isinstance(path, str) else path) if p]:
        for folder in (f"{one}/{STORE_KIND}={kind}", one):
            root = jvm.org.apache.hadoop.fs.Path(folder)
            fs = root.getFileSystem(conf)
            if fs.exists(root):
                names = [x.getPath().getName() for x in fs.listStatus(root)]
                out |= {dt.date.fromisoformat(x.split("=", 1)[1]) for x in names
                        if x.startswith(f"{column}=") and not x.endswith("__HIVE_DEFAULT_PARTITION__")}
    return out
