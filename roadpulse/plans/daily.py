"""Nightly batch layer: hourly stats, peak hour, day totals, intervention, daily report.

One lazy plan per report: facts -> per (date, sensor, hour) exact sums
(partial + final aggregation, the only shuffle over raw rows) -> one more
aggregation per (date, sensor) that picks the peak hour (``max_by`` on an
exact key) and sums the day -> rule columns. Every report date is computed in one pass; ``as_of`` restricts the
scan to one day when given (pushed to the parquet scan as a time range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.functions import exprs as X
from roadpulse.operators import aggregates as A
from roadpulse.operators import rules as R
from roadpulse.operators.ranking import argmax_per_group
from roadpulse.plans.registry import SUMS, register
from roadpulse.sources.telemetry import DEFAULT, Cols, facts, on_day

HOURLY_SQL = f"""
hourly AS (
    SELECT event_date, sensor_id, hour_of_day,{SUMS}
    FROM facts GROUP BY event_date, sensor_id, hour_of_day
)"""


def _restrict(f: DataFrame, as_of, cols: Cols) -> DataFrame:
    return f if as_of is None else on_day(f, as_of, cols)


def hourly_sums(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    return A.measure_sums(_restrict(f, as_of, cols), [cols.date, cols.key, cols.hour], cols)


def hourly_stats(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    """(date, sensor, hour) -> total and mean count, mean speed, mean congestion, alerts."""
    h = hourly_sums(f, as_of, cols)
    return h.select(
        F.col(cols.date), F.col(cols.key), F.col(cols.hour).alias("hour"),
        F.col("vehicle_sum").alias("total_vehicles"),
        A.avg_vehicles().alias("avg_vehicles"),
        A.avg_speed().alias("avg_speed"),
        A.avg_congestion().alias("avg_congestion"),
        F.col("critical_count").alias("critical_alerts"),
    )


def daily_totals(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    """(date, sensor) -> total vehicles, mean speed, critical alerts of the day."""
    d = A.measure_sums(_restrict(f, as_of, cols), [cols.date, cols.key], cols)
    return d.select(
        F.col(cols.date), F.col(cols.key),
        F.col("vehicle_sum").alias("total_daily_vehicles"),
        A.avg_speed().alias("avg_daily_speed"),
        F.col("critical_count").alias("total_critical_alerts"),
    )


PEAK_FIELDS = ("vehicle_sum", "vehicle_n", "speed_sum", "speed_n", "x100_sum", "x100_n", "critical_count")
DAY_TOTALS = {"day_vehicles": "vehicle_sum", "day_speed_sum": "speed_sum", "day_speed_n": "speed_n",
              "day_critical": "critical_count"}


def peak_of(hourly: DataFrame, keys, cols: Cols = DEFAULT, totals: dict[str, str] | None = None) -> DataFrame:
    """Per group of ``keys``: the peak hour (highest hourly vehicle total,
    ties -> earliest hour) with that hour's exact sums, plus ``totals`` over
    all hours, from a per-hour ``measure_sums`` table in one aggregation."""
    return argmax_per_group(hourly, keys, "vehicle_sum", cols.hour, 24, [cols.hour, *PEAK_FIELDS], totals)


def peak_hour_rows(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    """Per (date, sensor) the peak hour's exact sums."""
    return peak_of(hourly_sums(f, as_of, cols), [cols.date, cols.key], cols)


def peak_hours(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    p = peak_hour_rows(f, as_of, cols)
    return p.select(
        F.col(cols.date), F.col(cols.key), F.col(cols.hour).alias("hour"),
        F.col("vehicle_sum").alias("total_vehicles"),
        A.avg_vehicles().alias("avg_vehicles"),
        A.avg_speed().alias("avg_speed"),
        A.avg_congestion().alias("avg_congestion"),
        F.col("critical_count").alias("critical_alerts"),
    )


def intervention_report(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    """Rules on each (date, sensor) peak-hour row: flag, priority, reasons."""
    p = peak_hour_rows(f, as_of, cols)
    required = R.requires_intervention(A.avg_congestion(), F.col("critical_count"), A.avg_speed())
    return p.select(
        F.col(cols.date).alias("report_date"), F.col(cols.key),
        F.col(cols.hour).alias("peak_hour"),
        required.alias("requires_intervention"),
        R.priority(required).alias("priority"),
        R.reasons("x100_sum", "x100_n", "critical_count", "speed_sum", "speed_n").alias("reasons"),
    )


def peak_rows_with_day_sums(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    """Per (date, sensor): the peak hour's exact sums plus the day's sums
    (day_vehicles, day_speed_sum, day_speed_n, day_critical).

    The peak row and the day totals come from one aggregation over the
    hourly sums, so there is no window, sort or join.
    """
    return peak_of(hourly_sums(f, as_of, cols), [cols.date, cols.key], cols, DAY_TOTALS)


def peak_hour_intervention() -> "F.Column":
    """The intervention rule on a peak-hour row of exact sums."""
    return R.requires_intervention(A.avg_congestion(), F.col("critical_count"), A.avg_speed())


def daily_report(f: DataFrame, as_of=None, cols: Cols = DEFAULT) -> DataFrame:
    """The stored daily report, one row per (report_date, sensor).

    ``total_critical_alerts`` is the day's count; the peak hour's count is
    kept as ``peak_hour_critical_alerts``.
    """
    r = peak_rows_with_day_sums(f, as_of, cols)
    return r.select(
        F.col(cols.date).alias("report_date"),
        F.col(cols.key),
        F.col(cols.hour).alias("peak_hour"),
        F.col("vehicle_sum").alias("peak_hour_vehicle_count"),
        F.col("day_vehicles").cast("long").alias("total_daily_vehicles"),
        X.exact_mean("day_speed_sum", "day_speed_n").alias("avg_daily_speed"),
        F.col("critical_count").alias("peak_hour_critical_alerts"),
        F.col("day_critical").cast("long").alias("total_critical_alerts"),
        peak_hour_intervention().alias("requires_intervention"),
    )


# --- registered queries ------------------------------------------------------

@register("hourly_stats", oracle=f"""
WITH {HOURLY_SQL}
SELECT event_date, sensor_id, hour_of_day AS hour,
       vehicle_sum AS total_vehicles,
       CAST(vehicle_sum AS DOUBLE) / vehicle_n AS avg_vehicles,
       CAST(speed_sum AS DOUBLE) / speed_n AS avg_speed,
       CAST(x100_sum AS DOUBLE) / (x100_n * 100) AS avg_congestion,
       critical_count AS critical_alerts
FROM hourly""")
def q_hourly_stats(spark, sf_dir):
    return hourly_stats(facts(spark, sf_dir))


@register("daily_totals", oracle=f"""
SELECT event_date, sensor_id,
       CAST(SUM(vehicle_count) AS BIGINT) AS total_daily_vehicles,
       CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_daily_speed,
       COUNT(*) FILTER (WHERE traffic_status) AS total_critical_alerts
FROM facts GROUP BY event_date, sensor_id""")
def q_daily_totals(spark, sf_dir):
    return daily_totals(facts(spark, sf_dir))


PEAK_SQL = f"""
WITH {HOURLY_SQL}, peak AS (
    SELECT *, row_number() OVER (PARTITION BY event_date, sensor_id
                                 ORDER BY vehicle_sum DESC, hour_of_day ASC) AS rn
    FROM hourly
)"""


@register("peak_hours", oracle=PEAK_SQL + """
SELECT event_date, sensor_id, hour_of_day AS hour,
       vehicle_sum AS total_vehicles,
       CAST(vehicle_sum AS DOUBLE) / vehicle_n AS avg_vehicles,
       CAST(speed_sum AS DOUBLE) / speed_n AS avg_speed,
       CAST(x100_sum AS DOUBLE) / (x100_n * 100) AS avg_congestion,
       critical_count AS critical_alerts
FROM peak WHERE rn = 1""")
def q_peak_hours(spark, sf_dir):
    return peak_hours(facts(spark, sf_dir))


# Rule predicate on a row of exact sums, and half-up fixed-point texts.
RULE_SQL = f"""(CAST(x100_sum AS DOUBLE) / (x100_n * 100) > {P.CONGESTION_LIMIT}
        OR critical_count > {P.ALERT_LIMIT}
        OR CAST(speed_sum AS DOUBLE) / speed_n < {P.LOW_SPEED_LIMIT})"""

REASONS_SQL = f"""CASE WHEN concat_ws('{P.REASON_SEPARATOR}',
            CASE WHEN CAST(x100_sum AS DOUBLE) / (x100_n * 100) > {P.CONGESTION_LIMIT} THEN
                 'High congestion index: ' || CAST((2 * x100_sum + x100_n) // (2 * x100_n) // 100 AS VARCHAR)
                 || '.' || lpad(CAST((2 * x100_sum + x100_n) // (2 * x100_n) % 100 AS VARCHAR), 2, '0') END,
            CASE WHEN critical_count > {P.ALERT_LIMIT} THEN 'Multiple alerts: ' || CAST(critical_count AS VARCHAR) END,
            CASE WHEN CAST(speed_sum AS DOUBLE) / speed_n < {P.LOW_SPEED_LIMIT} THEN
                 'Low average speed: ' || CAST((20 * speed_sum + speed_n) // (2 * speed_n) // 10 AS VARCHAR)
                 || '.' || CAST((20 * speed_sum + speed_n) // (2 * speed_n) % 10 AS VARCHAR) || ' km/h' END) = ''
       THEN '{P.NORMAL_FLOW}'
       ELSE concat_ws('{P.REASON_SEPARATOR}',
            CASE WHEN CAST(x100_sum AS DOUBLE) / (x100_n * 100) > {P.CONGESTION_LIMIT} THEN
                 'High congestion index: ' || CAST((2 * x100_sum + x100_n) // (2 * x100_n) // 100 AS VARCHAR)
                 || '.' || lpad(CAST((2 * x100_sum + x100_n) // (2 * x100_n) % 100 AS VARCHAR), 2, '0') END,
            CASE WHEN critical_count > {P.ALERT_LIMIT} THEN 'Multiple alerts: ' || CAST(critical_count AS VARCHAR) END,
            CASE WHEN CAST(speed_sum AS DOUBLE) / speed_n < {P.LOW_SPEED_LIMIT} THEN
                 'Low average speed: ' || CAST((20 * speed_sum + speed_n) // (2 * speed_n) // 10 AS VARCHAR)
                 || '.' || CAST((20 * speed_sum + speed_n) // (2 * speed_n) % 10 AS VARCHAR) || ' km/h' END)
       END"""


@register("intervention_report", oracle=PEAK_SQL + f"""
SELECT event_date AS report_date, sensor_id, hour_of_day AS peak_hour,
       {RULE_SQL} AS requires_intervention,
       CASE WHEN {RULE_SQL} THEN 'HIGH' ELSE 'LOW' END AS priority,
       {REASONS_SQL} AS reasons
FROM peak WHERE rn = 1""")
def q_intervention_report(spark, sf_dir):
    return intervention_report(facts(spark, sf_dir))


DAILY_REPORT_SQL = f"""
WITH {HOURLY_SQL}, ranked AS (
    SELECT *,
           row_number() OVER (PARTITION BY event_date, sensor_id
                              ORDER BY vehicle_sum DESC, hour_of_day ASC) AS rn,
           SUM(vehicle_sum) OVER (PARTITION BY event_date, sensor_id) AS day_vehicles,
           SUM(speed_sum) OVER (PARTITION BY event_date, sensor_id) AS day_speed_sum,
           SUM(speed_n) OVER (PARTITION BY event_date, sensor_id) AS day_speed_n,
           SUM(critical_count) OVER (PARTITION BY event_date, sensor_id) AS day_critical
    FROM hourly
), report AS (
    SELECT event_date AS report_date, sensor_id, hour_of_day AS peak_hour,
           vehicle_sum AS peak_hour_vehicle_count,
           CAST(day_vehicles AS BIGINT) AS total_daily_vehicles,
           CAST(day_speed_sum AS DOUBLE) / CAST(day_speed_n AS DOUBLE) AS avg_daily_speed,
           critical_count AS peak_hour_critical_alerts,
           CAST(day_critical AS BIGINT) AS total_critical_alerts,
           {RULE_SQL} AS requires_intervention
    FROM ranked WHERE rn = 1
)"""


@register("daily_report", oracle=DAILY_REPORT_SQL + "\nSELECT * FROM report")
def q_daily_report(spark, sf_dir):
    return daily_report(facts(spark, sf_dir))


def intervention_count(report: DataFrame) -> DataFrame:
    """Sensors needing intervention per report date (from a daily report)."""
    return report.groupBy("report_date").agg(
        F.count_if(F.col("requires_intervention")).alias("sensors_requiring_intervention"),
        F.count(F.lit(1)).alias("sensors_reported"))


@register("intervention_count", oracle=DAILY_REPORT_SQL + """
SELECT report_date,
       COUNT(*) FILTER (WHERE requires_intervention) AS sensors_requiring_intervention,
       COUNT(*) AS sensors_reported
FROM report GROUP BY report_date""")
def q_intervention_count(spark, sf_dir):
    return intervention_count(daily_report(facts(spark, sf_dir)))
