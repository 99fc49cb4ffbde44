"""The telemetry operators over another table: shipped units of ``lineitem``.

Column roles come from ``Cols``: a warehouse line is the key, the shipping
day with an hour derived from the order is the time, units are the count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.joins import resample_hourly
from roadpulse.plans import daily
from roadpulse.plans.registry import register
from roadpulse.sources.telemetry import Cols, enrich, load_table

COLS = Cols(key="line", time="shipped", count="units", speed="rate", congestion="load", x100="load_x100",
            flag="slow", hour="hour", date="day", id="order_id")
LINES = 3

SQL = f"""
WITH shipped AS (
    SELECT l_orderkey AS order_id, 'L' || CAST(l_suppkey % {LINES} AS VARCHAR) AS line,
           l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS shipped,
           CAST(l_quantity AS INTEGER) AS units, CAST(l_partkey % 58 + 3 AS INTEGER) AS rate
    FROM lineitem
)"""


def shipments(spark, sf_dir) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    return enrich(li.select(
        F.col("l_orderkey").alias("order_id"), F.concat(F.lit("L"), (F.col("l_suppkey") % LINES).cast("string")).alias("line"),
        (F.col("l_shipdate").cast("timestamp_ntz") + hours).alias("shipped"),
        F.col("l_quantity").cast("int").alias("units"), (F.col("l_partkey") % 58 + 3).cast("int").alias("rate")), COLS)


@register("shipment_daily_totals", oracle=SQL + """
SELECT strftime(shipped, '%Y-%m-%d') AS day, line, CAST(SUM(units) AS BIGINT) AS total_daily_vehicles,
       CAST(SUM(rate) AS DOUBLE) / COUNT(rate) AS avg_daily_speed,
       COUNT(*) FILTER (WHERE rate < 10) AS total_critical_alerts
FROM shipped GROUP BY ALL""")
def q_shipment_daily_totals(spark, sf_dir):
    return daily.daily_totals(shipments(spark, sf_dir), cols=COLS)


@register("shipment_hourly_resample", oracle=SQL + """, b AS (
    SELECT line, date_trunc('hour', shipped) AS bucket, CAST(SUM(units) AS BIGINT) AS units FROM shipped GROUP BY ALL
), span AS (
    SELECT line, MIN(bucket) AS lo, MAX(bucket) AS hi FROM b GROUP BY line
), grid AS (
    SELECT line, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM span
)
SELECT g.line, CAST(g.bucket AS TIMESTAMP) AS bucket, COALESCE(b.units, 0) AS units
FROM grid g LEFT JOIN b USING (line, bucket)""")
def q_shipment_hourly_resample(spark, sf_dir):
    return resample_hourly(shipments(spark, sf_dir), COLS.key, COLS.time, COLS.count)
