"""Reports kept up by the day: per-day parts in a published table, merged over
any window, so a new day reads its own facts and no older ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import aggregates as A
from roadpulse.operators import sketches as S
from roadpulse.operators.joins import left_fill
from roadpulse.plans.registry import register
from roadpulse.plans.reports import _TRAILING_STATS
from roadpulse import params as P
from roadpulse.plans.stored import _own
from roadpulse.sinks import Published
from roadpulse.sources.telemetry import DEFAULT, Cols, alerts_of, facts, on_day, trailing


def add_day(f: DataFrame, alerts: DataFrame, path: str, day: dt.date, cols: Cols = DEFAULT) -> None:
    """Store a day's sums and alert count per sensor (again: anew, also if it
    has no rows any more). Reads the facts and alerts of that day alone."""
    sums = A.measure_sums(on_day(f, day, cols), [cols.key, cols.date], cols)
    counts = on_day(alerts, day, cols).groupBy(cols.key).agg(F.count(F.lit(1)).alias("alert_rows"))
    parts = left_fill(sums, counts, [cols.key], {"alert_rows": 0})
    Published(f.sparkSession, path).replace(parts, F.col(cols.date), [cols.key, cols.date], [day.isoformat()])


def rolling_statistics(spark: SparkSession, path: str, as_of: dt.date, days: int = P.TRAILING_DAYS,
                       cols: Cols = DEFAULT) -> DataFrame:
    """The trailing sensor statistics of the days before ``as_of``, merged
    from at most ``days`` parts a sensor; other days' parts are not listed."""
    first, end = (as_of - dt.timedelta(days=days)).isoformat(), as_of.isoformat()
    parts = Published(spark, path).read(lambda s: first <= s < end)
    sums = A.rollup_sums(parts, [cols.key])
    counts = parts.groupBy(cols.key).agg(F.sum("alert_rows").alias("critical_alerts"))
    return left_fill(sums, counts, [cols.key], {"critical_alerts": 0}).select(
        F.col(cols.key), F.col("vehicle_sum").alias("total_vehicles"), A.avg_speed().alias("avg_speed"),
        A.avg_congestion().alias("avg_congestion"), F.col("critical_alerts").cast("long").alias("critical_alerts"),
        F.col("first_event").alias("first_seen")).orderBy("first_seen", cols.key)


@register("rolling_sensor_statistics", oracle=_TRAILING_STATS + "\nSELECT * FROM stats ORDER BY first_seen, sensor_id")
def q_rolling_sensor_statistics(spark, sf_dir):
    """The trailing report from parts stored day by day."""
    f, path, as_of = facts(spark, sf_dir), _own(spark, "rolling"), P.AS_OF_TS.date()
    last = trailing(f, P.AS_OF_TS, P.TRAILING_DAYS)
    for k in range(P.TRAILING_DAYS, 0, -1):
        add_day(last, alerts_of(last), path, as_of - dt.timedelta(days=k))
    return rolling_statistics(spark, path, as_of)


@register("distinct_by_date_range", oracle=f"""
WITH pairs AS (SELECT DISTINCT event_date, event_id, sensor_id FROM facts),
days AS (SELECT DISTINCT event_date FROM facts)
SELECT d.event_date, COUNT(DISTINCT p.event_id) AS event_count, COUNT(DISTINCT p.sensor_id) AS sensor_count,
       true AS sketch_within_2_percent
FROM days d JOIN pairs p ON CAST(p.event_date AS DATE) <= CAST(d.event_date AS DATE)
    AND CAST(p.event_date AS DATE) > CAST(d.event_date AS DATE) - {P.TRAILING_DAYS}
GROUP BY d.event_date""")
def q_distinct_by_date_range(spark, sf_dir):
    """Exact distinct counts of every trailing week beside those of united
    daily sketches, which lie within two percent."""
    f = facts(spark, sf_dir)

    def weeks(daily):   # the range ends that a day counts for, of days with data
        ends = F.explode(F.sequence(F.col("event_date"), F.date_add("event_date", P.TRAILING_DAYS - 1)))
        some = f.select(F.col("event_date").alias("end")).distinct()
        return daily.withColumn("end", ends).join(some, "end", "left_semi")

    exact = weeks(f.select("event_date", "event_id", "sensor_id").distinct()).groupBy("end").agg(
        F.count_distinct("event_id").alias("event_count"), F.count_distinct("sensor_id").alias("sensor_count"))
    near = S.estimates(S.merge_sketches(weeks(S.distinct_sketches(f, ["event_date"], ["event_id", "sensor_id"])), ["end"]))
    within = [F.abs(F.col(f"distinct_{c}_id") - F.col(f"{c}_count")) <= 0.02 * F.col(f"{c}_count") for c in ("event", "sensor")]
    return exact.join(near, "end").select(F.col("end").alias("event_date"), "event_count", "sensor_count",
                                          (within[0] & within[1]).alias("sketch_within_2_percent"))
