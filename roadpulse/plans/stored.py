"""Queries over tables that the library stores: each writes its table from the
readings through the sink a job uses, in the shared folder, and reads it back.

Arrival is derived from the readings: a reading arrives on its own day, one in
seven a day later.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.operators import aggregates as A
from roadpulse.plans import daily, serving
from roadpulse.plans.registry import register
from roadpulse.session import shared_dir
from roadpulse.sinks import read_daily_reports, upsert_daily_report
from roadpulse.sources.telemetry import facts
from roadpulse.streaming import served

ARRIVAL_SQL = "datediff('day', DATE '1970-01-01', CAST(event_time AS DATE)) + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END"
STEP_DAYS = 10    # days of arrival in one stored batch of the queries below


def arrival_day(f: DataFrame) -> DataFrame:
    """Readings with the day number on which they arrive."""
    late = F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    return f.withColumn("arrival", (F.unix_date(F.to_date("event_time")) + late).cast("int"))


def _own(spark: SparkSession, name: str) -> str:
    """A folder of one run of a query."""
    return shared_dir(spark, f"queries/{name}-{uuid.uuid4().hex}")


def _steps(f: DataFrame) -> list[int]:
    """First arrival days of the steps that the readings fall into."""
    low, high = f.agg(F.min("arrival"), F.max("arrival")).first()
    return [] if low is None else list(range(low, high + 1, STEP_DAYS))


MORNING_SQL = daily.DAILY_REPORT_SQL.replace("FROM facts GROUP BY", "FROM facts WHERE hour_of_day < 12 GROUP BY")


@register("report_upsert", oracle=f"""
SELECT * FROM ({daily.DAILY_REPORT_SQL} SELECT * FROM report WHERE CAST(substr(sensor_id, 2) AS INTEGER) <= 10)
UNION ALL
SELECT * FROM ({MORNING_SQL} SELECT * FROM report) AS morning
WHERE NOT (CAST(substr(sensor_id, 2) AS INTEGER) <= 10)""")
def q_report_upsert(spark, sf_dir):
    """Reports of the morning hours are stored; sensors J1 to J10 are then
    reported from whole days and upserted by (date, sensor)."""
    f, path = facts(spark, sf_dir), _own(spark, "report_upsert")
    upsert_daily_report(daily.daily_report(f.filter("hour_of_day < 12")), path)
    some = F.substring("sensor_id", 2, 9).cast("int") <= 10
    upsert_daily_report(daily.daily_report(f.filter(some)), path)
    return read_daily_reports(spark, path)


@register("stored_daily_reports", oracle=daily.DAILY_REPORT_SQL + f"""
SELECT report_date, r.sensor_id, peak_hour, peak_hour_vehicle_count, total_daily_vehicles,
       CAST((200 * s.v + s.n) // (2 * s.n) AS DOUBLE) / 100 AS avg_daily_speed,
       peak_hour_critical_alerts, total_critical_alerts, requires_intervention
FROM report r JOIN (SELECT event_date, sensor_id, CAST(SUM(avg_speed) AS BIGINT) AS v, COUNT(avg_speed) AS n
                    FROM facts GROUP BY 1, 2) s ON s.event_date = r.report_date AND s.sensor_id = r.sensor_id
ORDER BY report_date DESC, r.sensor_id LIMIT {P.RECENT_REPORTS}""")
def q_stored_daily_reports(spark, sf_dir):
    """The latest rows of a stored report table, as the dashboard lists them."""
    path = _own(spark, "stored_daily_reports")
    upsert_daily_report(daily.daily_report(facts(spark, sf_dir)), path)
    return serving.stored_recent_reports(read_daily_reports(spark, path))


@register("served_status", oracle="""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index, traffic_status
FROM facts
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, event_id DESC) = 1""")
def q_served_status(spark, sf_dir):
    """The latest status kept up by merging the batches that arrive."""
    f, path = arrival_day(facts(spark, sf_dir)), _own(spark, "served_status")
    for k, first in enumerate(_steps(f)):
        batch = f.filter((F.col("arrival") >= first) & (F.col("arrival") < first + STEP_DAYS))
        served.merge_status(serving.latest_status(batch), path, "query", k)
    return served.served_status(spark, path)


@register("window_table", oracle="""
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
       sensor_id,
       CAST(SUM(congestion_x100) AS DOUBLE) / (COUNT(congestion_x100) * 100) AS avg_congestion_index,
       CAST(SUM(vehicle_count) AS DOUBLE) / COUNT(vehicle_count) AS avg_vehicle_count,
       CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_speed,
       MAX(vehicle_count) AS max_vehicle_count,
       MIN(avg_speed) AS min_speed,
       COUNT(*) AS record_count
FROM facts GROUP BY 1, 2, sensor_id""")
def q_window_table(spark, sf_dir):
    """Windows kept up batch by batch: every batch logs the windows it
    changed, two logged batches are folded into the snapshot."""
    f, path = arrival_day(facts(spark, sf_dir)), _own(spark, "window_table")
    for k, first in enumerate(_steps(f)):
        last = F.col("arrival") < first + STEP_DAYS
        new = A.window_measures(f.filter(last & (F.col("arrival") >= first)), P.WINDOW)
        so_far = A.window_measures(f.filter(last), P.WINDOW)
        changed = so_far.join(new.select(*served.WINDOW_KEY), served.WINDOW_KEY, "left_semi")
        served.append_windows(changed, path, "query", k, fold_every=2)
    return served.window_table(spark, path)


@register("late_rows_by_batch", oracle=f"""
WITH arrived AS (
    SELECT event_time, CAST({ARRIVAL_SQL} AS INTEGER) AS arrival FROM facts
), marks AS (
    SELECT arrival, MAX(MAX(event_time)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - INTERVAL 10 MINUTE AS mark
    FROM arrived GROUP BY arrival
), tagged AS (
    SELECT a.*, mark, coalesce(time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <= mark, false) AS late
    FROM arrived a JOIN marks USING (arrival)
)
SELECT arrival, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE NOT late) AS on_time, COUNT(*) FILTER (WHERE late) AS late,
       MAX(CASE WHEN late THEN (epoch_us(mark) - epoch_us(event_time)) // 1000000 END) AS max_lateness_s
FROM tagged GROUP BY arrival""")
def q_late_rows_by_batch(spark, sf_dir):
    return served.late_by_batch(arrival_day(facts(spark, sf_dir)), "arrival")


@register("late_rows", oracle=f"""
WITH arrived AS (
    SELECT event_id, sensor_id, event_time, CAST({ARRIVAL_SQL} AS INTEGER) AS arrival FROM facts
), batched AS (
    SELECT *, CAST((arrival - (SELECT MIN(arrival) FROM arrived)) // {STEP_DAYS} AS BIGINT) AS late_batch FROM arrived
), marks AS (
    SELECT late_batch, MAX(MAX(event_time)) OVER (ORDER BY late_batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       - INTERVAL 10 MINUTE AS mark
    FROM batched GROUP BY late_batch
)
SELECT event_id, sensor_id, event_time, late_batch,
       (epoch_us(mark) - epoch_us(event_time)) // 1000000 AS lateness_s
FROM batched JOIN marks USING (late_batch)
WHERE time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <= mark""")
def q_late_rows(spark, sf_dir):
    """Readings whose window was closed when they arrived, as the side output
    stores them batch by batch."""
    f, path = arrival_day(facts(spark, sf_dir)), _own(spark, "late_rows")
    for k, first in enumerate(_steps(f)):
        batch = f.filter((F.col("arrival") >= first) & (F.col("arrival") < first + STEP_DAYS))
        served.split_late(batch.select("event_id", "sensor_id", "event_time"), path, "query", k)
    return served.late_rows(spark, path)
