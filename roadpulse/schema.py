"""Declared schemas: wire event, stored facts, alerts and daily reports."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire event as sent by sensors (JSON). Nullability is declared, but
# from_json does not enforce it: validation is done by the quarantine split.
WIRE_SCHEMA = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("vehicle_count", T.IntegerType(), False),
    T.StructField("avg_speed", T.IntegerType(), False),
    T.StructField("congestion_index", T.DoubleType(), True),
])

FACT_COLUMNS = ["event_id", "sensor_id", "event_time", "vehicle_count", "avg_speed",
                "congestion_index", "traffic_status", "hour_of_day", "event_date"]

ALERT_COLUMNS = ["event_id", "sensor_id", "event_time", "vehicle_count", "avg_speed",
                 "congestion_index", "event_date"]

REPORT_SCHEMA = T.StructType([
    T.StructField("report_date", T.DateType(), False),
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("peak_hour", T.IntegerType(), True),
    T.StructField("peak_hour_vehicle_count", T.LongType(), True),
    T.StructField("total_daily_vehicles", T.LongType(), True),
    T.StructField("avg_daily_speed", T.DoubleType(), True),
    T.StructField("peak_hour_critical_alerts", T.LongType(), True),
    T.StructField("total_critical_alerts", T.LongType(), True),
    T.StructField("requires_intervention", T.BooleanType(), True),
])
