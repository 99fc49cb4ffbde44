"""Registry of named queries and their independent SQL oracles.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the driver
tables; its oracle is standard SQL (DuckDB dialect) over the same parquet
tables, built on the same canonical telemetry view written in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import params as P

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Canonical telemetry view and derived facts/alerts, in SQL. Dates are ISO
# text, matching ``present`` on the Spark side.
PRELUDE = f"""
WITH telemetry AS (
    SELECT event_id,
           'J' || CAST(user_id % {P.SENSOR_BUCKETS} + 1 AS VARCHAR) AS sensor_id,
           ts AS event_time,
           CAST(floor(value) AS INTEGER) + {P.COUNT_OFFSET} AS vehicle_count,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % {P.SPEED_MODULUS} + {P.SPEED_OFFSET} AS avg_speed
    FROM events
), facts AS (
    SELECT t.*,
           CAST((200 * vehicle_count + avg_speed) // (2 * avg_speed) AS BIGINT) AS congestion_x100,
           CAST((200 * vehicle_count + avg_speed) // (2 * avg_speed) AS BIGINT) / 100 AS congestion_index,
           avg_speed < {P.CRITICAL_SPEED} AS traffic_status,
           CAST(hour(event_time) AS INTEGER) AS hour_of_day,
           strftime(event_time, '%Y-%m-%d') AS event_date
    FROM telemetry t
), alerts AS (
    SELECT * FROM facts WHERE traffic_status
)"""

# Per-group exact sums, the SQL twin of operators.aggregates.measure_sums.
SUMS = """
           COUNT(*) AS record_count,
           CAST(SUM(vehicle_count) AS BIGINT) AS vehicle_sum,
           COUNT(vehicle_count) AS vehicle_n,
           MAX(vehicle_count) AS vehicle_max,
           CAST(SUM(avg_speed) AS BIGINT) AS speed_sum,
           COUNT(avg_speed) AS speed_n,
           MIN(avg_speed) AS speed_min,
           CAST(SUM(congestion_x100) AS BIGINT) AS x100_sum,
           COUNT(congestion_x100) AS x100_n,
           COUNT(*) FILTER (WHERE traffic_status) AS critical_count,
           MIN(event_time) AS first_event,
           MAX(event_time) AS last_event"""


def sql(body: str) -> str:
    """Prefix the canonical view; a body starting with WITH adds more CTEs."""
    b = body.strip()
    if b.upper().startswith("WITH "):
        return PRELUDE + ",\n" + b[5:]
    return PRELUDE + "\n" + b


def present(df: DataFrame) -> DataFrame:
    """Output form of a registered query: DATE columns as ISO text
    ('yyyy-MM-dd'), the way reports and exports show them; other types
    unchanged. Operators themselves keep DATE (partitioning, pruning)."""
    if not any(isinstance(f.dataType, T.DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
                       if isinstance(f.dataType, T.DateType) else F.col(f.name) for f in df.schema.fields])


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = sql(oracle)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from roadpulse.plans import daily, ingest, reports, rolling, serving, shipments, stored  # noqa: F401
