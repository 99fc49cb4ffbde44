"""Analytical reports: whole-history peak-hour table, volumes, pivots, resample,
per-sensor statistics, bands, dataset extent, summary metrics and scans.

Everything is aggregated per key (x hour) first; ranking, joins, pivots,
rules and text formatting run on those aggregates, never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.functions import exprs as X
from roadpulse.operators import aggregates as A
from roadpulse.operators import rules as R
from roadpulse.operators.joins import left_fill, resample_hourly
from roadpulse.operators.reshape import pivot_wide
from roadpulse.plans import daily
from roadpulse.plans.registry import SUMS, register
from roadpulse.sources.telemetry import DEFAULT, Cols, alerts_of, facts, on_day, trailing

TRAILING_SQL = (f"event_time >= TIMESTAMP '{P.AS_OF_TS.isoformat(sep=' ')}' - INTERVAL {P.TRAILING_DAYS} DAY "
                f"AND event_time < TIMESTAMP '{P.AS_OF_TS.isoformat(sep=' ')}'")
DAY_SQL = (f"event_time >= TIMESTAMP '{P.AS_OF_DATE.isoformat()} 00:00:00' "
           f"AND event_time < TIMESTAMP '{P.AS_OF_DATE.isoformat()} 00:00:00' + INTERVAL 1 DAY")


def alert_counts(alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Rows of the alerts table per sensor, most alerts first."""
    return (alerts.groupBy(cols.key).agg(F.count(F.lit(1)).alias("alert_count"))
                  .orderBy(F.col("alert_count").desc(), F.col(cols.key)))


def peak_hour_analysis(f: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Per sensor over the whole history: peak hour of day (all dates pooled;
    ties -> earliest hour), totals, means, alerts from the alerts table, and
    the intervention decision with its recommendation tier."""
    hs = A.measure_sums(f, [cols.key, cols.hour], cols)
    peak = daily.peak_of(hs, [cols.key], cols, {
        "t_vehicles": "vehicle_sum", "t_speed_sum": "speed_sum", "t_speed_n": "speed_n",
        "t_x100_sum": "x100_sum", "t_x100_n": "x100_n"})
    per_alerts = alerts.groupBy(cols.key).agg(F.count(F.lit(1)).alias("critical_alerts"))
    joined = left_fill(peak, per_alerts, [cols.key], {"critical_alerts": 0})
    cong = X.exact_mean("t_x100_sum", "t_x100_n", 100)
    spd = X.exact_mean("t_speed_sum", "t_speed_n")
    required = R.requires_intervention(cong, F.col("critical_alerts"), spd)
    return joined.select(
        F.col(cols.key),
        X.label(cols.key).alias("junction"),
        X.hour_label(cols.hour).alias("peak_hour"),
        F.col("vehicle_sum").alias("peak_vehicles"),
        F.col("t_vehicles").cast("long").alias("total_vehicles"),
        X.fixed_text("t_speed_sum", "t_speed_n", 1).alias("avg_speed"),
        X.fixed_text(F.col("t_x100_sum"), F.col("t_x100_n") * 100, 2).alias("avg_congestion_index"),
        F.col("critical_alerts").cast("long").alias("critical_alerts"),
        X.yes_no(required).alias("intervention_required"),
        R.recommendation(required, F.col("critical_alerts"), cong).alias("recommendation"),
    )


def analysis_table(analysis: DataFrame, key: str = DEFAULT.key) -> DataFrame:
    """The peak-hour analysis with the published table's column headers, one
    row per sensor in sensor order (for the CSV export)."""
    fields = ["junction", "peak_hour", "peak_vehicles", "total_vehicles", "avg_speed",
              "avg_congestion_index", "critical_alerts", "intervention_required", "recommendation"]
    return analysis.orderBy(key).select(*[F.col(c).alias(h) for c, h in zip(fields, P.ANALYSIS_HEADERS)])


def volume_by_hour(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    return A.measure_sums(f, [cols.hour, cols.key], cols) \
            .select(cols.hour, cols.key, F.col("vehicle_sum").alias("total_vehicles"))


def volume_pivot(f: DataFrame, sensors, cols: Cols = DEFAULT) -> DataFrame:
    """hour x sensor volume table: one column per sensor of the given list and
    ``other`` for all that are not listed, so a row's sum is the hour's total."""
    s = A.measure_sums(f, [cols.hour, cols.key], cols)
    named = s.withColumn("_column", F.when(F.col(cols.key).isin(*sensors), F.col(cols.key)).otherwise(F.lit("other")))
    return pivot_wide(named, [cols.hour], "_column", [*sensors, "other"], F.sum("vehicle_sum").cast("long"))


def heatmap_pivot(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """sensor x hour 0-23 mean vehicle count (columns h0..h23)."""
    hours = list(range(24))
    s = A.measure_sums(f, [cols.key, cols.hour], cols)
    return pivot_wide(s, [cols.key], cols.hour, hours, F.first(A.avg_vehicles()), [f"h{h}" for h in hours])


def sensor_statistics(f: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Per sensor: total vehicles, mean speed, mean congestion, alerts (alerts
    table, missing -> 0), first appearance; listed in first-appearance order."""
    return _stats_from_sums(A.measure_sums(f, [cols.key], cols), alerts, cols)


def _stats_from_sums(s: DataFrame, alerts: DataFrame, cols: Cols) -> DataFrame:
    per_alerts = alerts.groupBy(cols.key).agg(F.count(F.lit(1)).alias("critical_alerts"))
    out = left_fill(s, per_alerts, [cols.key], {"critical_alerts": 0})
    return out.select(
        F.col(cols.key),
        F.col("vehicle_sum").alias("total_vehicles"),
        A.avg_speed().alias("avg_speed"),
        A.avg_congestion().alias("avg_congestion"),
        F.col("critical_alerts").cast("long").alias("critical_alerts"),
        F.col("first_event").alias("first_seen"),
    ).orderBy("first_seen", cols.key)


def speed_band_by_sensor(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    s = A.measure_sums(f, [cols.key], cols)
    mean = X.exact_mean("speed_sum", "speed_n")
    return s.select(F.col(cols.key), mean.alias("avg_speed"), X.speed_band(mean).alias("speed_band")) \
            .orderBy("avg_speed", cols.key)


def hour_band_profile(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Per sensor and hour band (rush / midday / night / normal)."""
    s = A.measure_sums(f.withColumn("hour_band", X.hour_band(cols.hour)), [cols.key, "hour_band"], cols)
    return s.select(
        F.col(cols.key), F.col("hour_band"),
        F.col("record_count"), F.col("vehicle_sum").alias("total_vehicles"),
        A.avg_vehicles().alias("avg_vehicles"),
    )


def extent(f: DataFrame, cols: Cols = DEFAULT, approx_rsd: float | None = None) -> DataFrame:
    """One row: first/last event, rows, critical rows, distinct sensors and
    dates with data. Distinct counts run on the (sensor, date) aggregate;
    with ``approx_rsd`` they use HyperLogLog++ (bounded memory for very many
    sensors) instead of exact counting."""
    return _extent_from_sums(A.measure_sums(f, [cols.key, cols.date], cols), cols, approx_rsd)


def _extent_from_sums(per: DataFrame, cols: Cols, approx_rsd: float | None = None) -> DataFrame:
    def distinct(c):
        return F.approx_count_distinct(c, approx_rsd) if approx_rsd else F.count_distinct(c)
    return per.agg(
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("total_records"),
        F.coalesce(F.sum("critical_count"), F.lit(0)).cast("long").alias("total_alerts"),
        distinct(cols.key).alias("sensors"),
        distinct(cols.date).alias("dates_with_data"),
    )


def _summary_rollup(f: DataFrame, alerts: DataFrame, cols: Cols) -> DataFrame:
    """Per-sensor rows plus one grand-total row (``_g`` = 1) with everything
    the summaries print, in one pass over the facts: a (sensor, date)
    aggregate rolled up by sensor, joined (null-safe, on key and grouping
    id) to alert counts rolled up the same way."""
    per = A.measure_sums(f, [cols.key, cols.date], cols)
    r = per.rollup(cols.key).agg(
        F.grouping_id().alias("_g"),
        F.sum("record_count").alias("total_records"),
        F.sum("vehicle_sum").alias("total_vehicles"),
        F.sum("speed_sum").alias("speed_sum"),
        F.sum("speed_n").alias("speed_n"),
        F.sum("x100_sum").alias("x100_sum"),
        F.sum("x100_n").alias("x100_n"),
        F.min("first_event").alias("first_seen"),
        F.max("last_event").alias("last_seen"),
        F.count_distinct(cols.key).alias("sensors"),
        F.count_distinct(cols.date).alias("dates_with_data"),
    )
    pa = (alerts.groupBy(cols.key).agg(F.count(F.lit(1)).alias("n"))
                .rollup(cols.key).agg(F.grouping_id().alias("_ag"), F.sum("n").alias("critical_alerts"))
                .withColumnRenamed(cols.key, "_ak"))
    j = r.join(pa, F.col(cols.key).eqNullSafe(F.col("_ak")) & (F.col("_g") == F.col("_ag")), "left")
    return j.withColumn("critical_alerts", F.coalesce(F.col("critical_alerts"), F.lit(0)).cast("long"))


def summary_metrics(f: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Long-format summary (section, sensor_id, metric, value): the text
    summary's numbers as a table, unpivoted from ``_summary_rollup`` with a
    single explode. The fact table is scanned once."""
    j = _summary_rollup(f, alerts, cols)
    overall = F.col("_g") == 1
    d = lambda c: F.col(c).cast("double")
    metrics = [
        ("total_records", overall, d("total_records")),
        ("total_alerts", overall, d("critical_alerts")),
        ("sensors", overall, d("sensors")),
        ("dates_with_data", overall, d("dates_with_data")),
        ("total_vehicles", ~overall, d("total_vehicles")),
        ("avg_speed", ~overall, X.exact_mean("speed_sum", "speed_n")),
        ("avg_congestion", ~overall, X.exact_mean("x100_sum", "x100_n", 100)),
        ("critical_alerts", ~overall, d("critical_alerts")),
    ]
    cells = F.explode(F.array(*[
        F.when(cond, F.struct(F.lit(name).alias("metric"), value.alias("value"))) for name, cond, value in metrics]))
    return (j.select(F.when(overall, F.lit("overall")).otherwise(F.lit("sensor")).alias("section"),
                     F.when(~overall, F.col(cols.key)).alias(cols.key), cells.alias("_m"))
             .filter(F.col("_m").isNotNull())
             .select("section", cols.key, "_m.metric", "_m.value"))


def summary_lines(f: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """The text summary as ordered lines (first_seen, sensor_id, line_no, line):
    a header block (period, records, alerts), then one block per sensor in
    first-appearance order. Numbers are exact: thousands separators on
    integers, half-up means. Sort by the first three columns to print."""
    j = _summary_rollup(f, alerts, cols)
    overall = F.col("_g") == 1
    count = lambda c: F.format_number(F.col(c), 0)
    header = [
        F.concat(F.lit(P.SUMMARY_PERIOD), X.ts_text("first_seen"), F.lit(" to "), X.ts_text("last_seen")),
        F.concat(F.lit(P.SUMMARY_RECORDS), count("total_records")),
        F.concat(F.lit(P.SUMMARY_ALERTS), count("critical_alerts")),
    ]
    block = [
        F.concat(F.col(cols.key), F.lit(":")),
        F.concat(F.lit(P.SENSOR_VEHICLES), count("total_vehicles")),
        F.concat(F.lit(P.SENSOR_SPEED), X.fixed_text("speed_sum", "speed_n", 1), F.lit(" km/h")),
        F.concat(F.lit(P.SENSOR_CONGESTION), X.fixed_text(F.col("x100_sum"), F.col("x100_n") * 100, 2)),
        F.concat(F.lit(P.SENSOR_ALERTS), F.col("critical_alerts").cast("string")),
    ]
    lines = F.when(overall, F.array(*header)).otherwise(F.array(*block))
    return j.select(F.when(~overall, F.col("first_seen")).alias("first_seen"),
                    F.when(~overall, F.col(cols.key)).alias(cols.key),
                    F.posexplode(lines).alias("line_no", "line"))


def hour_rollup(f: DataFrame, n: int = P.LATEST_HOURS, cols: Cols = DEFAULT) -> DataFrame:
    """hour of day -> records and means over all sensors; the n latest hours."""
    s = A.measure_sums(f, [cols.hour], cols)
    out = s.select(F.col(cols.hour), F.col("record_count").alias("records"),
                   A.avg_vehicles().alias("avg_vehicles"), A.avg_speed().alias("avg_speed"),
                   A.avg_congestion().alias("avg_congestion"))
    return out.orderBy(F.col(cols.hour).desc()).limit(n)


def sensor_summary(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    s = A.measure_sums(f, [cols.key], cols)
    return s.select(F.col(cols.key), F.col("record_count").alias("total_records"),
                    A.avg_vehicles().alias("avg_vehicles"), A.avg_speed().alias("avg_speed"),
                    F.col("speed_min").alias("min_speed"), F.col("vehicle_max").alias("max_vehicles"),
                    F.col("critical_count"))


def scan_columns(cols: Cols = DEFAULT) -> list[str]:
    return [cols.id, cols.key, cols.time, cols.count, cols.speed, cols.congestion, cols.flag, cols.hour]


def trailing_days(f: DataFrame, as_of=P.AS_OF_TS, days: int = P.TRAILING_DAYS, cols: Cols = DEFAULT) -> DataFrame:
    return trailing(f, as_of, days, cols).select(*scan_columns(cols))


def day_scan(f: DataFrame, day=P.AS_OF_DATE, cols: Cols = DEFAULT) -> DataFrame:
    return on_day(f, day, cols).select(*scan_columns(cols))


def history_scan(f: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Whole history, projected, in event-time order (order only for export)."""
    return f.select(cols.id, cols.key, cols.time, X.date_text(cols.time).alias("date"),
                    cols.hour, cols.count, cols.speed, cols.congestion) \
            .orderBy(cols.time, cols.id)


def alerts_history(alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """All alerts in event-time order (order only for export)."""
    return alerts.select(cols.id, cols.key, cols.time, X.date_text(cols.time).alias("date"),
                         cols.count, cols.speed, cols.congestion).orderBy(cols.time, cols.id)


def trailing_alerts(alerts: DataFrame, as_of=P.AS_OF_TS, days: int = P.TRAILING_DAYS,
                    cols: Cols = DEFAULT) -> DataFrame:
    """Alerts of the trailing days, newest first."""
    return (trailing(alerts, as_of, days, cols).select(cols.id, cols.key, cols.time, cols.count, cols.speed,
                                                       cols.congestion)
            .orderBy(F.col(cols.time).desc(), F.col(cols.id).desc()))


def analytical_lines(f: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """The analytical summary as ordered lines (first_seen, sensor_id,
    line_no, line): title, period and totals, then per sensor the peak hour,
    means, alerts, decision and recommendation. Sort by the first three
    columns to print."""
    count = lambda c: F.format_number(F.col(c), 0)
    total = _summary_rollup(f, alerts, cols).filter(F.col("_g") == 1)
    head = total.select(
        F.lit(None).cast("timestamp_ntz").alias("first_seen"), F.lit(None).cast("string").alias(cols.key),
        F.posexplode(F.array(
            F.lit(P.ANALYTICAL_TITLE),
            F.concat(F.lit(P.ANALYTICAL_PERIOD), X.ts_text("first_seen"), F.lit(" to "), X.ts_text("last_seen")),
            F.lit(P.ANALYTICAL_OVERALL),
            F.concat(F.lit(P.ANALYTICAL_RECORDS), count("total_records")),
            F.concat(F.lit(P.ANALYTICAL_ALERTS), count("critical_alerts")),
            F.concat(F.lit(P.ANALYTICAL_SENSORS), F.col("sensors").cast("string")),
            F.concat(F.lit(P.ANALYTICAL_DATES), F.col("dates_with_data").cast("string"), F.lit(" day(s)")),
            F.lit(P.ANALYTICAL_BY_SENSOR))).alias("line_no", "line"))
    first = A.measure_sums(f, [cols.key], cols).select(cols.key, F.col("first_event").alias("first_seen"))
    block = peak_hour_analysis(f, alerts, cols).join(first, cols.key).select(
        "first_seen", cols.key,
        F.posexplode(F.array(
            F.col("junction"),
            F.concat(F.lit(P.ANALYTICAL_PEAK), "peak_hour", F.lit(" ("), F.col("peak_vehicles").cast("string"),
                     F.lit(" vehicles)")),
            F.concat(F.lit(P.ANALYTICAL_SPEED), "avg_speed", F.lit(" km/h")),
            F.concat(F.lit(P.ANALYTICAL_CONGESTION), "avg_congestion_index"),
            F.concat(F.lit(P.ANALYTICAL_SENSOR_ALERTS), F.col("critical_alerts").cast("string")),
            F.concat(F.lit(P.ANALYTICAL_DECISION), "intervention_required"),
            F.concat(F.lit("   "), "recommendation"))).alias("line_no", "line"))
    return head.unionByName(block)


# --- registered queries ------------------------------------------------------

def _fa(spark, sf_dir):
    f = facts(spark, sf_dir)
    return f, alerts_of(f)


ANALYSIS_SQL = f"""
WITH hs AS (
    SELECT sensor_id, hour_of_day,{SUMS}
    FROM facts GROUP BY sensor_id, hour_of_day
), peak AS (
    SELECT *,
           row_number() OVER (PARTITION BY sensor_id ORDER BY vehicle_sum DESC, hour_of_day) AS rn,
           SUM(vehicle_sum) OVER (PARTITION BY sensor_id) AS t_vehicles,
           SUM(speed_sum) OVER (PARTITION BY sensor_id) AS t_speed_sum,
           SUM(speed_n) OVER (PARTITION BY sensor_id) AS t_speed_n,
           SUM(x100_sum) OVER (PARTITION BY sensor_id) AS t_x100_sum,
           SUM(x100_n) OVER (PARTITION BY sensor_id) AS t_x100_n
    FROM hs
), pa AS (
    SELECT sensor_id, COUNT(*) AS critical_alerts FROM alerts GROUP BY sensor_id
), j AS (
    SELECT p.*, COALESCE(a.critical_alerts, 0) AS alerts_n,
           CAST(t_x100_sum AS DOUBLE) / (t_x100_n * 100) AS cong,
           CAST(t_speed_sum AS DOUBLE) / t_speed_n AS spd
    FROM peak p LEFT JOIN pa a USING (sensor_id) WHERE rn = 1
), r AS (
    SELECT *, (cong > {P.CONGESTION_LIMIT} OR alerts_n > {P.ALERT_LIMIT} OR spd < {P.LOW_SPEED_LIMIT}) AS req FROM j
)
SELECT sensor_id,
       replace(sensor_id, '_', ' ') AS junction,
       CAST(hour_of_day AS VARCHAR) || ':00' AS peak_hour,
       vehicle_sum AS peak_vehicles,
       CAST(t_vehicles AS BIGINT) AS total_vehicles,
       CAST((20 * t_speed_sum + t_speed_n) // (2 * t_speed_n) // 10 AS VARCHAR) || '.'
           || CAST((20 * t_speed_sum + t_speed_n) // (2 * t_speed_n) % 10 AS VARCHAR) AS avg_speed,
       CAST((2 * t_x100_sum + t_x100_n) // (2 * t_x100_n) // 100 AS VARCHAR) || '.'
           || lpad(CAST((2 * t_x100_sum + t_x100_n) // (2 * t_x100_n) % 100 AS VARCHAR), 2, '0') AS avg_congestion_index,
       CAST(alerts_n AS BIGINT) AS critical_alerts,
       CASE WHEN req THEN 'YES' ELSE 'NO' END AS intervention_required,
       CASE WHEN NOT req THEN '{P.TIER_LOW}'
            WHEN alerts_n > {P.URGENT_ALERTS} THEN '{P.TIER_URGENT}'
            WHEN cong > {P.HIGH_CONGESTION} THEN '{P.TIER_HIGH}'
            ELSE '{P.TIER_MEDIUM}' END AS recommendation
FROM r"""


@register("peak_hour_analysis", oracle=ANALYSIS_SQL)
def q_peak_hour_analysis(spark, sf_dir):
    return peak_hour_analysis(*_fa(spark, sf_dir))


@register("volume_by_hour", oracle="""
SELECT hour_of_day, sensor_id, CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles
FROM facts GROUP BY hour_of_day, sensor_id""")
def q_volume_by_hour(spark, sf_dir):
    return volume_by_hour(facts(spark, sf_dir))


PIVOTED = P.sensor_ids()
_pivot_cols = ",\n       ".join(
    f"CAST(SUM(vehicle_count) FILTER (WHERE sensor_id = '{s}') AS BIGINT) AS \"{s}\"" for s in PIVOTED)


@register("volume_pivot", oracle=f"""
SELECT hour_of_day,
       {_pivot_cols},
       CAST(SUM(vehicle_count) FILTER (WHERE sensor_id NOT IN {tuple(PIVOTED)}) AS BIGINT) AS other
FROM facts GROUP BY hour_of_day""")
def q_volume_pivot(spark, sf_dir):
    return volume_pivot(facts(spark, sf_dir), PIVOTED)


_heat_cols = ",\n       ".join(f"AVG(vehicle_count) FILTER (WHERE hour_of_day = {h}) AS h{h}" for h in range(24))


@register("heatmap_pivot", oracle=f"""
SELECT sensor_id,
       {_heat_cols}
FROM facts GROUP BY sensor_id""")
def q_heatmap_pivot(spark, sf_dir):
    return heatmap_pivot(facts(spark, sf_dir))


@register("hourly_resample", oracle="""
WITH b AS (
    SELECT sensor_id, date_trunc('hour', event_time) AS bucket,
           CAST(SUM(vehicle_count) AS BIGINT) AS vehicle_count
    FROM facts GROUP BY sensor_id, date_trunc('hour', event_time)
), span AS (
    SELECT sensor_id, MIN(bucket) AS lo, MAX(bucket) AS hi FROM b GROUP BY sensor_id
), grid AS (
    SELECT sensor_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM span
)
SELECT g.sensor_id, CAST(g.bucket AS TIMESTAMP) AS bucket, COALESCE(b.vehicle_count, 0) AS vehicle_count
FROM grid g LEFT JOIN b USING (sensor_id, bucket)""")
def q_hourly_resample(spark, sf_dir):
    return resample_hourly(facts(spark, sf_dir), "sensor_id", "event_time", "vehicle_count")


STATS_SQL = """
WITH s AS (
    SELECT sensor_id, CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
           CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_speed,
           CAST(SUM(congestion_x100) AS DOUBLE) / (COUNT(congestion_x100) * 100) AS avg_congestion,
           MIN(event_time) AS first_seen
    FROM facts GROUP BY sensor_id
), a AS (
    SELECT sensor_id, COUNT(*) AS n FROM alerts GROUP BY sensor_id
), stats AS (
    SELECT s.sensor_id, total_vehicles, avg_speed, avg_congestion,
           CAST(COALESCE(a.n, 0) AS BIGINT) AS critical_alerts, first_seen
    FROM s LEFT JOIN a USING (sensor_id)
)"""


@register("sensor_statistics", oracle=STATS_SQL + "\nSELECT * FROM stats ORDER BY first_seen, sensor_id")
def q_sensor_statistics(spark, sf_dir):
    return sensor_statistics(*_fa(spark, sf_dir))


@register("alert_counts", oracle="""
SELECT sensor_id, COUNT(*) AS alert_count FROM alerts GROUP BY sensor_id
ORDER BY alert_count DESC, sensor_id""")
def q_alert_counts(spark, sf_dir):
    return alert_counts(alerts_of(facts(spark, sf_dir)))


@register("speed_band_by_sensor", oracle=f"""
WITH s AS (
    SELECT sensor_id, CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_speed
    FROM facts GROUP BY sensor_id
)
SELECT sensor_id, avg_speed,
       CASE WHEN avg_speed < {P.SPEED_BAND_LIMITS[0]} THEN '{P.SPEED_BANDS[0]}'
            WHEN avg_speed < {P.SPEED_BAND_LIMITS[1]} THEN '{P.SPEED_BANDS[1]}'
            ELSE '{P.SPEED_BANDS[2]}' END AS speed_band
FROM s ORDER BY avg_speed, sensor_id""")
def q_speed_band_by_sensor(spark, sf_dir):
    return speed_band_by_sensor(facts(spark, sf_dir))


_band_case = " ".join(f"WHEN hour_of_day IN {tuple(hours)} THEN '{name}'" for name, hours in P.HOUR_BANDS)


@register("hour_band_profile", oracle=f"""
WITH b AS (
    SELECT *, CASE {_band_case} ELSE '{P.DEFAULT_BAND}' END AS hour_band
    FROM facts
)
SELECT sensor_id, hour_band,
       COUNT(*) AS record_count,
       CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
       CAST(SUM(vehicle_count) AS DOUBLE) / COUNT(vehicle_count) AS avg_vehicles
FROM b GROUP BY sensor_id, hour_band""")
def q_hour_band_profile(spark, sf_dir):
    return hour_band_profile(facts(spark, sf_dir))


EXTENT_SQL = """
SELECT MIN(event_time) AS first_event, MAX(event_time) AS last_event,
       COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE traffic_status) AS total_alerts,
       COUNT(DISTINCT sensor_id) AS sensors,
       COUNT(DISTINCT event_date) AS dates_with_data
FROM facts"""


@register("dataset_extent", oracle=EXTENT_SQL)
def q_dataset_extent(spark, sf_dir):
    return extent(facts(spark, sf_dir))


@register("summary_metrics", oracle=STATS_SQL + f""", e AS ({EXTENT_SQL}
)
SELECT 'overall' AS section, CAST(NULL AS VARCHAR) AS sensor_id, m.metric, m.value
FROM e, LATERAL (VALUES ('total_records', CAST(e.total_records AS DOUBLE)),
                        ('total_alerts', CAST((SELECT COUNT(*) FROM alerts) AS DOUBLE)),
                        ('sensors', CAST(e.sensors AS DOUBLE)),
                        ('dates_with_data', CAST(e.dates_with_data AS DOUBLE))) AS m(metric, value)
UNION ALL
SELECT 'sensor', sensor_id, m.metric, m.value
FROM stats, LATERAL (VALUES ('total_vehicles', CAST(total_vehicles AS DOUBLE)),
                            ('avg_speed', avg_speed),
                            ('avg_congestion', avg_congestion),
                            ('critical_alerts', CAST(critical_alerts AS DOUBLE))) AS m(metric, value)""")
def q_summary_metrics(spark, sf_dir):
    return summary_metrics(*_fa(spark, sf_dir))


@register("hour_rollup_top5", oracle=f"""
SELECT hour_of_day, COUNT(*) AS records,
       CAST(SUM(vehicle_count) AS DOUBLE) / COUNT(vehicle_count) AS avg_vehicles,
       CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_speed,
       CAST(SUM(congestion_x100) AS DOUBLE) / (COUNT(congestion_x100) * 100) AS avg_congestion
FROM facts GROUP BY hour_of_day ORDER BY hour_of_day DESC LIMIT {P.LATEST_HOURS}""")
def q_hour_rollup_top5(spark, sf_dir):
    return hour_rollup(facts(spark, sf_dir))


@register("sensor_summary", oracle="""
SELECT sensor_id, COUNT(*) AS total_records,
       CAST(SUM(vehicle_count) AS DOUBLE) / COUNT(vehicle_count) AS avg_vehicles,
       CAST(SUM(avg_speed) AS DOUBLE) / COUNT(avg_speed) AS avg_speed,
       MIN(avg_speed) AS min_speed, MAX(vehicle_count) AS max_vehicles,
       COUNT(*) FILTER (WHERE traffic_status) AS critical_count
FROM facts GROUP BY sensor_id""")
def q_sensor_summary(spark, sf_dir):
    return sensor_summary(facts(spark, sf_dir))


_SCAN_SQL = "event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index, traffic_status, hour_of_day"


@register("trailing_days", oracle=f"SELECT {_SCAN_SQL} FROM facts WHERE {TRAILING_SQL}")
def q_trailing_days(spark, sf_dir):
    return trailing_days(facts(spark, sf_dir))


@register("day_scan", oracle=f"SELECT {_SCAN_SQL} FROM facts WHERE {DAY_SQL}")
def q_day_scan(spark, sf_dir):
    return day_scan(facts(spark, sf_dir))


@register("history_scan", oracle="""
SELECT event_id, sensor_id, event_time, strftime(event_time, '%Y-%m-%d') AS date, hour_of_day,
       vehicle_count, avg_speed, congestion_index
FROM facts ORDER BY event_time, event_id""")
def q_history_scan(spark, sf_dir):
    return history_scan(facts(spark, sf_dir))


_TS_SQL = ("CASE WHEN strftime({c}, '%f') = '000000' THEN strftime({c}, '%Y-%m-%d %H:%M:%S') "
           "ELSE strftime({c}, '%Y-%m-%d %H:%M:%S.%f') END")


@register("summary_text", oracle=f"""
WITH s AS (
    SELECT sensor_id, CAST(SUM(vehicle_count) AS BIGINT) AS v, SUM(avg_speed) AS ss, COUNT(avg_speed) AS sn,
           SUM(congestion_x100) AS xs, COUNT(congestion_x100) AS xn, MIN(event_time) AS first_seen
    FROM facts GROUP BY sensor_id
), a AS (
    SELECT sensor_id, COUNT(*) AS n FROM alerts GROUP BY sensor_id
), st AS (
    SELECT s.*, COALESCE(a.n, 0) AS alerts_n FROM s LEFT JOIN a USING (sensor_id)
), e AS (
    SELECT MIN(event_time) AS lo, MAX(event_time) AS hi, COUNT(*) AS n FROM facts
)
SELECT CAST(NULL AS TIMESTAMP) AS first_seen, CAST(NULL AS VARCHAR) AS sensor_id, 0 AS line_no,
       '{P.SUMMARY_PERIOD}' || {_TS_SQL.format(c="lo")} || ' to ' || {_TS_SQL.format(c="hi")} AS line FROM e
UNION ALL SELECT NULL, NULL, 1, '{P.SUMMARY_RECORDS}' || format('{{:,}}', n) FROM e
UNION ALL SELECT NULL, NULL, 2, '{P.SUMMARY_ALERTS}' || format('{{:,}}', (SELECT COUNT(*) FROM alerts))
UNION ALL SELECT first_seen, sensor_id, 0, sensor_id || ':' FROM st
UNION ALL SELECT first_seen, sensor_id, 1, '{P.SENSOR_VEHICLES}' || format('{{:,}}', v) FROM st
UNION ALL SELECT first_seen, sensor_id, 2, '{P.SENSOR_SPEED}'
       || CAST((20 * ss + sn) // (2 * sn) // 10 AS VARCHAR) || '.'
       || CAST((20 * ss + sn) // (2 * sn) % 10 AS VARCHAR) || ' km/h' FROM st
UNION ALL SELECT first_seen, sensor_id, 3, '{P.SENSOR_CONGESTION}'
       || CAST((2 * xs + xn) // (2 * xn) // 100 AS VARCHAR) || '.'
       || lpad(CAST((2 * xs + xn) // (2 * xn) % 100 AS VARCHAR), 2, '0') FROM st
UNION ALL SELECT first_seen, sensor_id, 4, '{P.SENSOR_ALERTS}' || CAST(alerts_n AS VARCHAR) FROM st""")
def q_summary_text(spark, sf_dir):
    return summary_lines(*_fa(spark, sf_dir))


@register("alerts_history", oracle="""
SELECT event_id, sensor_id, event_time, strftime(event_time, '%Y-%m-%d') AS date, vehicle_count, avg_speed,
       congestion_index
FROM alerts ORDER BY event_time, event_id""")
def q_alerts_history(spark, sf_dir):
    return alerts_history(alerts_of(facts(spark, sf_dir)))


@register("trailing_alerts", oracle=f"""
SELECT event_id, sensor_id, event_time, vehicle_count, avg_speed, congestion_index
FROM alerts WHERE {TRAILING_SQL} ORDER BY event_time DESC, event_id DESC""")
def q_trailing_alerts(spark, sf_dir):
    return trailing_alerts(alerts_of(facts(spark, sf_dir)))


_TRAILING_STATS = STATS_SQL.replace("FROM facts GROUP", f"FROM facts WHERE {TRAILING_SQL} GROUP").replace(
    "FROM alerts GROUP", f"FROM alerts WHERE {TRAILING_SQL} GROUP")


@register("trailing_sensor_statistics", oracle=_TRAILING_STATS + "\nSELECT * FROM stats ORDER BY first_seen, sensor_id")
def q_trailing_sensor_statistics(spark, sf_dir):
    f = trailing(facts(spark, sf_dir), P.AS_OF_TS, P.TRAILING_DAYS)
    return sensor_statistics(f, alerts_of(f))


@register("trailing_alert_counts", oracle=f"""
SELECT sensor_id, COUNT(*) AS alert_count FROM alerts WHERE {TRAILING_SQL} GROUP BY sensor_id
ORDER BY alert_count DESC, sensor_id""")
def q_trailing_alert_counts(spark, sf_dir):
    return alert_counts(alerts_of(trailing(facts(spark, sf_dir), P.AS_OF_TS, P.TRAILING_DAYS)))


@register("analytical_summary_text", oracle=ANALYSIS_SQL.strip().replace("SELECT sensor_id,\n       replace(", """, an AS (
SELECT sensor_id,
       replace(""", 1) + f"""
), fs AS (
    SELECT sensor_id, MIN(event_time) AS first_seen FROM facts GROUP BY sensor_id
), s AS (
    SELECT an.*, first_seen FROM an JOIN fs USING (sensor_id)
), e AS ({EXTENT_SQL}
)
SELECT CAST(NULL AS TIMESTAMP) AS first_seen, CAST(NULL AS VARCHAR) AS sensor_id, 0 AS line_no,
       '{P.ANALYTICAL_TITLE}' AS line
UNION ALL SELECT NULL, NULL, 1, '{P.ANALYTICAL_PERIOD}' || {_TS_SQL.format(c="first_event")} || ' to '
       || {_TS_SQL.format(c="last_event")} FROM e
UNION ALL SELECT NULL, NULL, 2, '{P.ANALYTICAL_OVERALL}'
UNION ALL SELECT NULL, NULL, 3, '{P.ANALYTICAL_RECORDS}' || format('{{:,}}', total_records) FROM e
UNION ALL SELECT NULL, NULL, 4, '{P.ANALYTICAL_ALERTS}' || format('{{:,}}', (SELECT COUNT(*) FROM alerts))
UNION ALL SELECT NULL, NULL, 5, '{P.ANALYTICAL_SENSORS}' || CAST(sensors AS VARCHAR) FROM e
UNION ALL SELECT NULL, NULL, 6, '{P.ANALYTICAL_DATES}' || CAST(dates_with_data AS VARCHAR) || ' day(s)' FROM e
UNION ALL SELECT NULL, NULL, 7, '{P.ANALYTICAL_BY_SENSOR}'
UNION ALL SELECT first_seen, sensor_id, 0, junction FROM s
UNION ALL SELECT first_seen, sensor_id, 1, '{P.ANALYTICAL_PEAK}' || peak_hour || ' (' || peak_vehicles || ' vehicles)'
       FROM s
UNION ALL SELECT first_seen, sensor_id, 2, '{P.ANALYTICAL_SPEED}' || avg_speed || ' km/h' FROM s
UNION ALL SELECT first_seen, sensor_id, 3, '{P.ANALYTICAL_CONGESTION}' || avg_congestion_index FROM s
UNION ALL SELECT first_seen, sensor_id, 4, '{P.ANALYTICAL_SENSOR_ALERTS}' || critical_alerts FROM s
UNION ALL SELECT first_seen, sensor_id, 5, '{P.ANALYTICAL_DECISION}' || intervention_required FROM s
UNION ALL SELECT first_seen, sensor_id, 6, '   ' || recommendation FROM s""")
def q_analytical_summary_text(spark, sf_dir):
    return analytical_lines(*_fa(spark, sf_dir))
