"""Ingest and quality: wire decode, enrichment, quarantine, profile,
alert reconciliation, and 5-minute event-time windows (batch form of the
streaming aggregate; the same function runs on the stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.operators import aggregates as A
from roadpulse.operators import quality as Q
from roadpulse.plans.registry import register
from roadpulse.sources.telemetry import alerts_of, enrich, facts, load_table, telemetry_from_events
from roadpulse.sources.wire import decode_wire, encode_wire

ENRICHED = ["event_id", "sensor_id", "event_time", "vehicle_count", "avg_speed",
            "congestion_index", "traffic_status", "hour_of_day", "event_date"]


def wire_messages(spark, sf_dir) -> DataFrame:
    """Sensor messages (JSON text) for every event of the driver table."""
    t = telemetry_from_events(load_table(spark, sf_dir, "events"))
    return encode_wire(enrich(t))


@register("json_decode", oracle="""
SELECT event_id, sensor_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
       event_time, vehicle_count, avg_speed, congestion_index
FROM facts""")
def q_json_decode(spark, sf_dir):
    """Encode each event as a wire message, then decode it with the declared
    schema; round-tripping must give back every field exactly."""
    d = decode_wire(wire_messages(spark, sf_dir), keep=("event_id",))
    # Normalise the ISO text to always carry 6 fraction digits for comparison.
    return d.select("event_id", "sensor_id",
                    F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                    "event_time", "vehicle_count", "avg_speed", "congestion_index")


@register("enriched_events", oracle="""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index,
       traffic_status, hour_of_day, event_date
FROM facts""")
def q_enriched_events(spark, sf_dir):
    return facts(spark, sf_dir).select(*ENRICHED)


@register("quarantine", oracle="""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed,
       NULLIF(concat_ws(';',
           CASE WHEN sensor_id IS NULL THEN 'null_sensor_id' END,
           CASE WHEN event_time IS NULL THEN 'null_event_time' END,
           CASE WHEN vehicle_count IS NULL THEN 'null_vehicle_count' END,
           CASE WHEN avg_speed IS NULL THEN 'null_avg_speed' END,
           CASE WHEN vehicle_count < 0 THEN 'negative_vehicle_count' END,
           CASE WHEN avg_speed <= 0 THEN 'nonpositive_avg_speed' END), '') AS reject_reason
FROM telemetry""")
def q_quarantine(spark, sf_dir):
    """Decoded wire rows tagged valid (reason NULL) or with the violated checks."""
    d = decode_wire(wire_messages(spark, sf_dir), keep=("event_id",))
    return Q.with_reject_reason(d).select("event_id", "sensor_id", "event_time", "vehicle_count",
                                          "avg_speed", "reject_reason")


@register("dq_profile", oracle="""
SELECT sensor_id, COUNT(*) AS record_count,
       COUNT(*) FILTER (WHERE event_time IS NULL) AS null_event_time,
       COUNT(*) FILTER (WHERE vehicle_count IS NULL) AS null_vehicle_count,
       COUNT(*) FILTER (WHERE avg_speed IS NULL) AS null_avg_speed,
       COUNT(*) FILTER (WHERE congestion_index IS NULL) AS null_congestion_index,
       MIN(event_time) AS first_event, MAX(event_time) AS last_event,
       COUNT(DISTINCT event_date) AS dates_with_data,
       COUNT(DISTINCT hour_of_day) AS hours_with_data,
       COUNT(*) FILTER (WHERE traffic_status) AS critical_count
FROM facts GROUP BY sensor_id""")
def q_dq_profile(spark, sf_dir):
    return Q.profile(facts(spark, sf_dir))


@register("alert_reconciliation", oracle="""
WITH fl AS (
    SELECT sensor_id, COUNT(*) FILTER (WHERE traffic_status) AS flagged_facts,
           COUNT(*) FILTER (WHERE traffic_status IS NULL) AS unflagged_facts
    FROM facts GROUP BY sensor_id
), al AS (
    SELECT sensor_id, COUNT(*) AS alert_rows FROM alerts GROUP BY sensor_id
)
SELECT sensor_id,
       COALESCE(flagged_facts, 0) AS flagged_facts,
       COALESCE(unflagged_facts, 0) AS unflagged_facts,
       COALESCE(alert_rows, 0) AS alert_rows,
       COALESCE(alert_rows, 0) - COALESCE(flagged_facts, 0) AS difference
FROM fl FULL OUTER JOIN al USING (sensor_id)""")
def q_alert_reconciliation(spark, sf_dir):
    f = facts(spark, sf_dir)
    return Q.reconcile_alerts(f, alerts_of(f))


@register("tumbling_5min", oracle="""
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
def q_tumbling_5min(spark, sf_dir):
    return A.window_measures(facts(spark, sf_dir), P.WINDOW)


@register("ingestion_checks", oracle="""
WITH g AS (
    SELECT (SELECT COUNT(*) FROM facts) AS fact_rows,
           (SELECT COUNT(*) FROM alerts) AS alert_rows,
           (SELECT COUNT(DISTINCT sensor_id) FROM facts) AS sensors_reporting,
           (SELECT COUNT(DISTINCT hour_of_day) FROM facts) AS hours_reporting,
           (SELECT COUNT(*) FILTER (WHERE traffic_status) FROM facts) AS flagged_rows
)
SELECT m.check_name, m.value, m.passed
FROM g, LATERAL (VALUES ('fact_rows', fact_rows, fact_rows > 0),
                        ('alert_rows', alert_rows, true),
                        ('sensors_reporting', sensors_reporting, true),
                        ('hours_reporting', hours_reporting, true),
                        ('flagged_minus_alerts', flagged_rows - alert_rows, flagged_rows = alert_rows))
     AS m(check_name, value, passed)""")
def q_ingestion_checks(spark, sf_dir):
    f = facts(spark, sf_dir)
    return Q.ingestion_checks(f, alerts_of(f))


def corrupted_messages(spark, sf_dir) -> DataFrame:
    """The wire messages with six in ten of them damaged, by event id: cut
    off, a time that is none, speed 0, a count below 0, an index below 0, an
    index beyond any sum."""
    kind = F.pmod(F.col("event_id"), F.lit(10))

    def swap(name, value):
        return F.regexp_replace("value", f'"{name}":[^,}}]*', f'"{name}":{value}')

    damaged = (F.when(kind == 1, F.substring("value", 1, 12)).when(kind == 2, swap("timestamp", '"no time"'))
               .when(kind == 3, swap("avg_speed", "0")).when(kind == 4, swap("vehicle_count", "-5"))
               .when(kind == 5, swap("congestion_index", "-1.5")).when(kind == 6, swap("congestion_index", "1e300"))
               .otherwise(F.col("value")))
    return wire_messages(spark, sf_dir).withColumn("value", damaged)


@register("quarantine_damaged", oracle="""
SELECT event_id,
       CASE event_id % 10
            WHEN 1 THEN 'null_sensor_id;null_event_time;null_vehicle_count;null_avg_speed'
            WHEN 2 THEN 'null_event_time'
            WHEN 3 THEN 'nonpositive_avg_speed'
            WHEN 4 THEN 'negative_vehicle_count'
            WHEN 5 THEN 'bad_congestion_index'
            WHEN 6 THEN 'bad_congestion_index' END AS reject_reason,
       event_id % 10 NOT BETWEEN 1 AND 6 AS stored
FROM telemetry""")
def q_quarantine_damaged(spark, sf_dir):
    """Every damaged message is set apart with its reasons, no other is."""
    d = Q.with_reject_reason(decode_wire(corrupted_messages(spark, sf_dir), keep=("event_id",)))
    return d.select("event_id", "reject_reason", F.col("reject_reason").isNull().alias("stored"))
