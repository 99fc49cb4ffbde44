"""Data-quality operators: quarantine split, profile, key uniqueness, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.telemetry import DEFAULT, Cols

MAX_CONGESTION = 1e9
REQUIRED = ("sensor_id", "event_time", "vehicle_count", "avg_speed")


def with_reject_reason(df: DataFrame, required: Sequence[str] = REQUIRED,
                       reason_col: str = "reject_reason") -> DataFrame:
    """Add ``reject_reason``: ';'-joined list of violated checks, NULL when valid.

    Checks: each required column non-NULL (NOT NULL constraint), a
    non-negative count, a positive speed, and a congestion index that is
    finite, not negative and small enough to sum, where present.
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in required]
    if "vehicle_count" in df.columns:
        checks.append(F.when(F.col("vehicle_count") < 0, F.lit("negative_vehicle_count")))
    if "avg_speed" in df.columns:
        checks.append(F.when(F.col("avg_speed") <= 0, F.lit("nonpositive_avg_speed")))
    if "congestion_index" in df.columns:
        index = F.col("congestion_index")
        fits = ~F.isnan(index) & (index >= 0) & (index < MAX_CONGESTION)
        checks.append(F.when(index.isNotNull() & ~fits, F.lit("bad_congestion_index")))
    reason = F.concat_ws(";", *checks)
    return df.withColumn(reason_col, F.when(reason != "", reason))


def split_valid(df: DataFrame, required: Sequence[str] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with reject_reason). Both are lazy filters
    of one plan; persist the input first if both are written."""
    tagged = with_reject_reason(df, required)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


def profile(df: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Per key: row count, NULL counts per measure, first/last event, hours and
    dates with data, critical rows.

    All counters are additive, so raw rows are first collapsed per (key,
    date, hour) with partial aggregation; the distinct counts then run on
    that small table (Spark's distinct-aggregate expansion never touches the
    raw rows)."""
    cells = df.groupBy(cols.key, cols.date, cols.hour).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(cols.time).isNull()).alias("nt"),
        F.count_if(F.col(cols.count).isNull()).alias("nc"),
        F.count_if(F.col(cols.speed).isNull()).alias("ns"),
        F.count_if(F.col(cols.congestion).isNull()).alias("ni"),
        F.min(cols.time).alias("lo"),
        F.max(cols.time).alias("hi"),
        F.count_if(F.coalesce(F.col(cols.flag), F.lit(False))).alias("cr"),
    )
    return cells.groupBy(cols.key).agg(
        F.sum("n").alias("record_count"),
        F.sum("nt").alias("null_event_time"),
        F.sum("nc").alias("null_vehicle_count"),
        F.sum("ns").alias("null_avg_speed"),
        F.sum("ni").alias("null_congestion_index"),
        F.min("lo").alias("first_event"),
        F.max("hi").alias("last_event"),
        F.count_distinct(F.col(cols.date)).alias("dates_with_data"),
        F.count_distinct(F.col(cols.hour)).alias("hours_with_data"),
        F.sum("cr").alias("critical_count"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (must be empty for a unique key)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def reconcile_alerts(facts: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Per key: facts flagged critical vs rows in the alerts table."""
    flagged = facts.groupBy(cols.key).agg(
        F.count_if(F.coalesce(F.col(cols.flag), F.lit(False))).alias("flagged_facts"),
        F.count_if(F.col(cols.flag).isNull()).alias("unflagged_facts"))
    stored = alerts.groupBy(cols.key).agg(F.count(F.lit(1)).alias("alert_rows"))
    out = flagged.join(stored, [cols.key], "full")
    return out.select(
        cols.key,
        F.coalesce("flagged_facts", F.lit(0)).alias("flagged_facts"),
        F.coalesce("unflagged_facts", F.lit(0)).alias("unflagged_facts"),
        F.coalesce("alert_rows", F.lit(0)).alias("alert_rows"),
        (F.coalesce("alert_rows", F.lit(0)) - F.coalesce("flagged_facts", F.lit(0))).alias("difference"),
    )


def ingestion_checks(facts: DataFrame, alerts: DataFrame, cols: Cols = DEFAULT) -> DataFrame:
    """Operational checks as rows (check_name, value, passed), in one aggregation
    over facts and alerts together (a narrow union, no join):

    - fact_rows > 0 (data is flowing)
    - alert_rows (informational)
    - sensors_reporting, hours_reporting (informational)
    - flagged_minus_alerts == 0 (alerts table matches the critical flag)
    """
    tagged = (facts.select(F.lit(True).alias("_fact"), F.col(cols.key), F.col(cols.hour),
                           F.coalesce(F.col(cols.flag), F.lit(False)).alias("_flag"))
              .unionByName(alerts.select(F.lit(False).alias("_fact"), F.col(cols.key),
                                         F.lit(None).cast("int").alias(cols.hour), F.lit(False).alias("_flag"))))
    # Collapse raw rows per (source, key, hour) first; distinct counts then
    # run on that small table.
    cells = tagged.groupBy("_fact", cols.key, cols.hour).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_flag")).alias("f"))
    g = cells.agg(
        F.coalesce(F.sum(F.when(F.col("_fact"), F.col("n"))), F.lit(0)).alias("fact_rows"),
        F.coalesce(F.sum(F.when(~F.col("_fact"), F.col("n"))), F.lit(0)).alias("alert_rows"),
        F.count_distinct(F.when(F.col("_fact"), F.col(cols.key))).alias("sensors_reporting"),
        F.count_distinct(F.when(F.col("_fact"), F.col(cols.hour))).alias("hours_reporting"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("flagged_rows"),
    )
    return g.select(F.expr(
        "stack(5, "
        "'fact_rows', fact_rows, fact_rows > 0, "
        "'alert_rows', alert_rows, true, "
        "'sensors_reporting', sensors_reporting, true, "
        "'hours_reporting', hours_reporting, true, "
        "'flagged_minus_alerts', flagged_rows - alert_rows, flagged_rows = alert_rows"
        ") AS (check_name, value, passed)"))
