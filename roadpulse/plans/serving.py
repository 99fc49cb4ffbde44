"""Serving queries: stored views and dashboard endpoints.

The dashboard's four summary scans become one aggregate; its client-side
24-hour gap fill and top-10 slicing move into Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.functions import exprs as X
from roadpulse.operators import aggregates as A
from roadpulse.operators.joins import densify_hours
from roadpulse.operators.ranking import latest_per_key, top_n
from roadpulse.plans import daily
from roadpulse.plans.registry import register
from roadpulse.sources.telemetry import DEFAULT, Cols, alerts_of, facts, on_day

DAY_SQL = (f"event_time >= TIMESTAMP '{P.AS_OF_DATE.isoformat()} 00:00:00' "
           f"AND event_time < TIMESTAMP '{P.AS_OF_DATE.isoformat()} 00:00:00' + INTERVAL 1 DAY")

def status_columns(cols: Cols = DEFAULT) -> list[str]:
    return [cols.id, cols.time, cols.count, cols.speed, cols.congestion, cols.flag]


def view_columns(cols: Cols = DEFAULT) -> list[str]:
    return [cols.id, cols.key, cols.time, cols.count, cols.speed, cols.congestion]


def latest_status(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Latest reading per sensor (ties on time broken by the larger event id)."""
    return latest_per_key(f, cols.key, cols.time, cols.id, status_columns(cols))


def hourly_traffic_summary(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    s = A.measure_sums(f, [cols.key, cols.date, cols.hour], cols)
    return s.select(
        F.col(cols.key), F.col(cols.date).alias("traffic_date"), F.col(cols.hour),
        F.col("record_count"),
        A.avg_vehicles().alias("avg_vehicles"),
        A.avg_speed().alias("avg_speed"),
        A.avg_congestion().alias("avg_congestion"),
        F.col("critical_count"),
    )


def hourly_stats_day(f: DataFrame, day=P.AS_OF_DATE, cols: Cols = DEFAULT) -> DataFrame:
    """One day's (sensor, hour) means, rounded for display: integers half-up
    and congestion to 2 decimals."""
    s = A.measure_sums(on_day(f, day, cols), [cols.key, cols.hour], cols)
    return s.select(
        F.col(cols.key), F.col(cols.hour),
        A.rounded_int("vehicle_sum", "vehicle_n").alias("avg_vehicles"),
        A.rounded_int("speed_sum", "speed_n").alias("avg_speed"),
        A.rounded_2dp("x100_sum", "x100_n", 100).alias("avg_congestion"),
        F.col("critical_count"),
    )


def day_summary(f: DataFrame, day=P.AS_OF_DATE, cols: Cols = DEFAULT) -> DataFrame:
    """One row for a day: records, critical readings, mean speed (integer),
    busiest sensor. One scan; an empty day gives 0, 0, 0, 'N/A'."""
    per = A.measure_sums(on_day(f, day, cols), [cols.key], cols)
    g = per.agg(
        F.sum("record_count").alias("n"),
        F.sum("critical_count").alias("c"),
        F.sum("speed_sum").alias("ss"),
        F.sum("speed_n").alias("sn"),
        # Largest total first, then the smallest sensor id.
        F.min_by(cols.key, F.struct((-F.col("vehicle_sum")).alias("v"), F.col(cols.key).alias("k"))).alias("peak"),
    )
    return g.select(
        F.coalesce("n", F.lit(0)).cast("long").alias("total_records"),
        F.coalesce("c", F.lit(0)).cast("long").alias("critical_alerts"),
        F.coalesce(X.div_half_up("ss", "sn"), F.lit(0)).cast("int").alias("avg_speed"),
        F.coalesce("peak", F.lit("N/A")).alias("peak_junction"),
    )


def busiest_sensor(f: DataFrame, day=P.AS_OF_DATE, cols: Cols = DEFAULT) -> DataFrame:
    per = A.measure_sums(on_day(f, day, cols), [cols.key], cols) \
           .select(cols.key, F.col("vehicle_sum").alias("total_vehicles"))
    return top_n(per, [F.col("total_vehicles").desc(), F.col(cols.key).asc()], 1)


def recent(df: DataFrame, n: int, cols: Cols = DEFAULT) -> DataFrame:
    """Latest n rows by time (ties: larger event id first)."""
    return top_n(df.select(*view_columns(cols)), [F.col(cols.time).desc(), F.col(cols.id).desc()], n)


def hour_grid(f: DataFrame, day=P.AS_OF_DATE, cols: Cols = DEFAULT) -> DataFrame:
    """Every sensor present on the day x hours 0-23; hours without data are 0."""
    hourly = hourly_stats_day(f, day, cols).select(
        cols.key, cols.hour, "avg_vehicles", "avg_speed", "critical_count")
    return densify_hours(hourly, [cols.key], {"avg_vehicles": 0, "avg_speed": 0, "critical_count": 0},
                         hour_col=cols.hour)


def recent_daily_reports(f: DataFrame, n: int = P.RECENT_REPORTS, cols: Cols = DEFAULT) -> DataFrame:
    """Latest n report rows by date (desc) then sensor; the day's mean speed
    rounded half-up to 2 decimals from its exact sums."""
    r = daily.peak_rows_with_day_sums(f, None, cols)
    shaped = r.select(
        F.col(cols.date).alias("report_date"), F.col(cols.key),
        F.col(cols.hour).alias("peak_hour"),
        F.col("vehicle_sum").alias("peak_hour_vehicle_count"),
        F.col("day_vehicles").cast("long").alias("total_daily_vehicles"),
        A.rounded_2dp("day_speed_sum", "day_speed_n").alias("avg_daily_speed"),
        F.col("day_critical").cast("long").alias("total_critical_alerts"),
        daily.peak_hour_intervention().alias("requires_intervention"),
    )
    return top_n(shaped, [F.col("report_date").desc(), F.col(cols.key).asc()], n)


def stored_recent_reports(reports: DataFrame, n: int = P.RECENT_REPORTS) -> DataFrame:
    """Same listing over a stored report table, the mean as numeric(10,2). A
    mean of up to 10^10 integers that is no tie lies further from one than 13
    decimals show, so rounding those half-up is exact."""
    exact = F.round(F.col("avg_daily_speed").cast("decimal(28,13)"), 2).cast("double")
    return top_n(reports.withColumn("avg_daily_speed", exact),
                 [F.col("report_date").desc(), F.col("sensor_id").asc()], n)


def status_board(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Latest status per sensor as the board shows it: label and state."""
    return latest_status(f, cols).select(
        cols.key, X.label(cols.key).alias("junction"), cols.time, cols.speed,
        X.status_glyph(cols.flag).alias("status"))


# --- registered queries ------------------------------------------------------

@register("status_board", oracle="""
SELECT sensor_id, replace(sensor_id, '_', ' ') AS junction, event_time, avg_speed,
       CASE WHEN traffic_status THEN 'critical' ELSE 'normal' END AS status
FROM facts
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, event_id DESC) = 1""")
def q_status_board(spark, sf_dir):
    return status_board(facts(spark, sf_dir))


@register("latest_status", oracle="""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index, traffic_status
FROM facts
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, event_id DESC) = 1""")
def q_latest_status(spark, sf_dir):
    return latest_status(facts(spark, sf_dir))


@register("hourly_traffic_summary", oracle=f"""
SELECT sensor_id, event_date AS traffic_date, hour_of_day,
       COUNT(*) AS record_count,
       CAST(SUM(vehicle_count) AS DOUBLE) / COUNT(vehicle_count) AS avg_vehicles,
       CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_speed,
       CAST(SUM(congestion_x100) AS DOUBLE) / (COUNT(congestion_x100) * 100) AS avg_congestion,
       COUNT(*) FILTER (WHERE traffic_status) AS critical_count
FROM facts GROUP BY sensor_id, event_date, hour_of_day""")
def q_hourly_traffic_summary(spark, sf_dir):
    return hourly_traffic_summary(facts(spark, sf_dir))


HOURLY_DAY_SQL = f"""
SELECT sensor_id, hour_of_day,
       CAST((2 * SUM(vehicle_count) + COUNT(vehicle_count)) // (2 * COUNT(vehicle_count)) AS INTEGER) AS avg_vehicles,
       CAST((2 * SUM(avg_speed) + COUNT(avg_speed)) // (2 * COUNT(avg_speed)) AS INTEGER) AS avg_speed,
       ((2 * SUM(congestion_x100) + COUNT(congestion_x100)) // (2 * COUNT(congestion_x100))) / 100 AS avg_congestion,
       COUNT(*) FILTER (WHERE traffic_status) AS critical_count
FROM facts WHERE {DAY_SQL}
GROUP BY sensor_id, hour_of_day"""


@register("hourly_stats_day", oracle=HOURLY_DAY_SQL)
def q_hourly_stats_day(spark, sf_dir):
    return hourly_stats_day(facts(spark, sf_dir))


@register("day_summary", oracle=f"""
WITH per AS (
    SELECT sensor_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE traffic_status) AS c,
           SUM(avg_speed) AS ss, COUNT(avg_speed) AS sn, SUM(vehicle_count) AS vs
    FROM facts WHERE {DAY_SQL} GROUP BY sensor_id
)
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_records,
       CAST(COALESCE(SUM(c), 0) AS BIGINT) AS critical_alerts,
       CAST(COALESCE((2 * SUM(ss) + SUM(sn)) // (2 * SUM(sn)), 0) AS INTEGER) AS avg_speed,
       COALESCE((SELECT sensor_id FROM per ORDER BY vs DESC, sensor_id LIMIT 1), 'N/A') AS peak_junction
FROM per""")
def q_day_summary(spark, sf_dir):
    return day_summary(facts(spark, sf_dir))


@register("busiest_sensor", oracle=f"""
SELECT sensor_id, CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles
FROM facts WHERE {DAY_SQL}
GROUP BY sensor_id ORDER BY total_vehicles DESC, sensor_id LIMIT 1""")
def q_busiest_sensor(spark, sf_dir):
    return busiest_sensor(facts(spark, sf_dir))


@register("critical_alerts", oracle="""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index, event_date
FROM alerts""")
def q_critical_alerts(spark, sf_dir):
    return alerts_of(facts(spark, sf_dir)).select(
        "event_id", "sensor_id", "event_time", "vehicle_count", "avg_speed", "congestion_index", "event_date")


@register("recent_alerts", oracle=f"""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index
FROM alerts ORDER BY event_time DESC, event_id DESC LIMIT {P.RECENT_ALERTS}""")
def q_recent_alerts(spark, sf_dir):
    return recent(alerts_of(facts(spark, sf_dir)), P.RECENT_ALERTS)


@register("latest_events", oracle=f"""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index
FROM facts ORDER BY event_time DESC, event_id DESC LIMIT {P.LATEST_EVENTS}""")
def q_latest_events(spark, sf_dir):
    return recent(facts(spark, sf_dir), P.LATEST_EVENTS)


@register("hour_grid", oracle=f"""
WITH day AS ({HOURLY_DAY_SQL}
), keys AS (
    SELECT DISTINCT sensor_id FROM day
), grid AS (
    SELECT sensor_id, CAST(h AS INTEGER) AS hour_of_day FROM keys, range(24) AS t(h)
)
SELECT g.sensor_id, g.hour_of_day,
       COALESCE(d.avg_vehicles, 0) AS avg_vehicles,
       COALESCE(d.avg_speed, 0) AS avg_speed,
       COALESCE(d.critical_count, 0) AS critical_count
FROM grid g LEFT JOIN day d USING (sensor_id, hour_of_day)""")
def q_hour_grid(spark, sf_dir):
    return hour_grid(facts(spark, sf_dir))


@register("recent_daily_reports", oracle=daily.DAILY_REPORT_SQL.replace(
    "CAST(day_speed_sum AS DOUBLE) / CAST(day_speed_n AS DOUBLE) AS avg_daily_speed",
    "((200 * day_speed_sum + day_speed_n) // (2 * day_speed_n)) / 100 AS avg_daily_speed") + f"""
SELECT report_date, sensor_id, peak_hour, peak_hour_vehicle_count, total_daily_vehicles,
       avg_daily_speed, total_critical_alerts, requires_intervention
FROM report ORDER BY report_date DESC, sensor_id LIMIT {P.RECENT_REPORTS}""")
def q_recent_daily_reports(spark, sf_dir):
    return recent_daily_reports(facts(spark, sf_dir))


@register("latest_alerts", oracle=f"""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index
FROM alerts ORDER BY event_time DESC, event_id DESC LIMIT {P.LATEST_EVENTS}""")
def q_latest_alerts(spark, sf_dir):
    return recent(alerts_of(facts(spark, sf_dir)), P.LATEST_EVENTS)
