"""Batch sinks.

Facts and alerts are partitioned by ``event_date``, reports by
``report_date``. Re-running a report day overwrites exactly that day's
partition (dynamic partition overwrite), which is the upsert on
(report_date, sensor_id). Exports are written by all tasks in parallel:
never coalesced to one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schema import ALERT_COLUMNS, FACT_COLUMNS
from roadpulse.sinks.published import Published


def write_facts(df: DataFrame, path: str, mode: str = "append") -> None:
    df.select(*FACT_COLUMNS).write.mode(mode).partitionBy("event_date").parquet(path)


def write_alerts(df: DataFrame, path: str, mode: str = "append") -> None:
    df.filter(F.col("traffic_status")).select(*ALERT_COLUMNS) \
      .write.mode(mode).partitionBy("event_date").parquet(path)


def write_daily_report(report: DataFrame, path: str, day=None) -> None:
    """Upsert report rows. With ``day`` exactly that date's partition is
    replaced, also by no rows; without it each report_date present in
    ``report`` replaces its partition. Other dates are untouched."""
    if day is not None:
        _replace_date(report, path, day).parquet(f"{path}/report_date={day.isoformat()}")
        return
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("report_date").parquet(path))


def _replace_date(df: DataFrame, path: str, day):
    """Writer of one date's folder: the rows of that date without it."""
    return df.filter(F.col("report_date") == F.lit(day)).drop("report_date").write.mode("overwrite")


def write_recommendations(report: DataFrame, path: str, day) -> None:
    """One closed day's recommendations as CSV under report_date=<day>; other
    days' files stay, a day without rows replaces what it had."""
    _replace_date(report, path, day).option("header", True).csv(f"{path}/report_date={day.isoformat()}")


def export_csv(df: DataFrame, path: str, partition_by: str | None = None,
               order_by: list[str] | None = None) -> None:
    """CSV with header. ``order_by`` sorts each output file."""
    # The writer sorts by its partition column unless the rows already are.
    order = ([partition_by] if partition_by else []) + (order_by or [])
    out = df.sortWithinPartitions(*order) if order_by else df
    w = out.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def write_summary(metrics: DataFrame, path: str) -> None:
    """Long-format summary metrics table (section, sensor_id, metric, value)."""
    metrics.write.mode("overwrite").parquet(path)


def write_text_report(lines: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Write report lines as text, in order, without collecting them: a range
    sort spreads the lines over ordered part files (read them in name order)."""
    order = order or ["first_seen", "sensor_id", "line_no"]
    (lines.orderBy(*[F.col(c).asc_nulls_first() for c in order]).select("line")
          .write.mode("overwrite").text(path))


def write_hourly_rollup(sums: DataFrame, path: str, date_col: str = "event_date") -> None:
    """Upsert a (sensor, date, hour) ``measure_sums`` table: each date present
    replaces its partition. Reports and views can read this instead of the
    facts (the sums merge exactly)."""
    # No repartition by date: a day holds sensors x 24 rows, so the input's
    # own (AQE-sized) partitions decide the files instead of one task a day.
    (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(date_col).parquet(path))


REPORT_KEY = ["report_date", "sensor_id"]


def upsert_daily_report(report: DataFrame, path: str) -> None:
    """Upsert report rows by (report_date, sensor_id) into a published table:
    rows of ``report`` replace stored rows of their key, other sensors of the
    same date stay, only dates that ``report`` has are rewritten, and readers
    see the old table until all of it is written and no key is there twice
    (``AuditFailed`` otherwise)."""
    Published(report.sparkSession, path).upsert(report, REPORT_KEY, F.col("report_date"))


def publish_daily_report(report: DataFrame, path: str, day) -> None:
    """Replace one closed day of a published report table, also by no rows,
    under the same audit."""
    rows = report.filter(F.col("report_date") == F.lit(day))
    Published(report.sparkSession, path).replace(rows, F.col("report_date"), REPORT_KEY, [day.isoformat()])


def read_daily_reports(spark: SparkSession, path: str, since=None) -> DataFrame:
    """A stored report table: a published one (the newest version, of dates
    from ``since`` on) or one of date folders."""
    table = Published(spark, path)
    if table.versions():
        return table.read(None if since is None else lambda s: s >= since.isoformat())
    stored = spark.read.parquet(path)
    return stored if since is None else stored.filter(F.col("report_date") >= F.lit(since))
