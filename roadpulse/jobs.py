"""Runnable jobs (spark-submit roadpulse/jobs.py <job> ...).

- ``stream``: wire messages -> facts + alerts tables, 5-minute windows.
- ``ingest``: batch backfill of wire-message files through the same path.
- ``nightly``: one closed day's report and recommendations CSV, each
  replacing that day alone.
- ``reports``: whole-history peak-hour table (CSV), summaries, and the
  trailing days' statistics, alerts, resample, heatmap and export.
- ``archive``: closed days of a streamed table as a few large files.
- ``dashboard``: the serving views (latest status, dense hourly stats, recent
  alerts and reports, day summary, checks) as small tables.

Paths are shared storage; checkpoints default to folders under
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from roadpulse import params as P  # noqa: E402
from roadpulse.operators.quality import ingestion_checks  # noqa: E402
from roadpulse.plans import daily, reports, serving  # noqa: E402
from roadpulse.session import get_session, shared_dir  # noqa: E402
from roadpulse.operators import aggregates as A  # noqa: E402
from roadpulse.operators.joins import resample_hourly  # noqa: E402
from roadpulse.sinks import (  # noqa: E402
    Published, export_csv, publish_daily_report, read_daily_reports, write_daily_report, write_hourly_rollup, write_recommendations, write_summary, write_text_report,
)
from roadpulse.sources.telemetry import Cols, newest, on_day, read_alerts, read_facts, trailing  # noqa: E402
from roadpulse.streaming import (  # noqa: E402
    dedup_events, enrich_stream, kafka_source, read_wire_files, start_cutoff, start_fact_sinks, start_store_sink,
    start_windows, window_update_sink,
)
from roadpulse.streaming.pipeline import start_latest_status, valid_only, write_batch  # noqa: E402
from roadpulse.sinks.archive import archive_days, drop_archived  # noqa: E402
from roadpulse.streaming.served import (  # noqa: E402
    refresh_status, served_status, start_late_split, start_served_status, window_table_sink,
)


def run_stream(spark: SparkSession, source: str, facts_path: str, alerts_path: str | None, windows_path: str,
               kafka_servers: str | None = None, available_now: bool = False, max_files: int | None = None,
               checkpoint_base: str | None = None, dedup: bool = False, update_windows: bool = False,
               status_path: str | None = None, every: str = "1 minute", starting_offsets: str = "latest",
               max_offsets: int | None = None, served: bool = False, late_path: str | None = None,
               ledger: str | None = None, files_from_start: bool = True):
    """Start the facts/alerts sink and the window sink. Without ``alerts_path``
    facts, alerts and quarantine go to one exactly-once store at
    ``facts_path`` (read it with ``read_facts`` / ``read_alerts``). Each query
    has its own checkpoint (default: a folder of this store under the shared
    checkpoint root); restarting with the same checkpoints resumes where the
    previous run committed.

    ``dedup`` drops replayed readings within the watermark before they are
    stored and before final windows; ``update_windows`` logs each changed
    window every batch (read with ``latest_windows``) instead of final
    windows, which Spark can't chain after ``dedup``, so replays count
    there; ``status_path`` keeps the latest status table. Windows and status
    see valid readings only.

    With ``served`` the status and the updated windows are published tables
    (``served_status``, ``window_table``), readable at any time and bounded to
    read, instead of a folder overwritten in place and a growing log.
    ``late_path`` stores the readings that come too late for their window;
    ``ledger`` keeps a row of counts per query and batch.

    Without ``files_from_start`` a file source starts at the latest: files
    older than the job's first start are left out, and one that vanishes after
    it was listed is skipped."""
    own = hashlib.md5(facts_path.rstrip("/").encode()).hexdigest()
    base = (checkpoint_base or shared_dir(spark, f"stream/{own}")).rstrip("/")
    if kafka_servers:
        raw = kafka_source(spark, kafka_servers, source, starting_offsets, max_offsets_per_trigger=max_offsets)
    elif files_from_start:
        raw = read_wire_files(spark, source, max_files_per_trigger=max_files)
    else:
        raw = read_wire_files(spark, source, max_files, start_cutoff(spark, base), tolerate_loss=True)
    enriched = enrich_stream(raw)
    stored = dedup_events(enriched) if dedup else enriched
    # One micro-batch a minute: each batch adds (date, batch) partitions to
    # the facts table, so short triggers multiply partitions and small files.
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    if alerts_path is None:
        # One exactly-once store for facts, alerts and quarantine (kind partition).
        queries = [start_store_sink(stored, facts_path, f"{base}/store", trigger, "store")]
    else:
        queries = [start_fact_sinks(stored, facts_path, alerts_path, f"{base}/facts", trigger, "facts", ledger=ledger)]
    if update_windows:
        queries.append(start_windows(valid_only(enriched), f"{base}/window_log", output_mode="update",
                                     on_batch=(window_table_sink if served else window_update_sink)(windows_path),
                                     trigger=trigger, name="windows"))
    else:
        queries.append(start_windows(valid_only(stored), f"{base}/windows", path=windows_path, trigger=trigger,
                                     name="windows", delay=None if dedup else P.WATERMARK))
    if status_path:
        start = start_served_status if served else start_latest_status
        queries.append(start(enriched, status_path, f"{base}/status", trigger, "status"))
    if late_path:
        queries.append(start_late_split(enriched, late_path, f"{base}/late", ledger=ledger, trigger=trigger, name="late"))
    return queries


POLL_S = 0.5


def await_all(spark: SparkSession, queries: list) -> None:
    """Wait until every one of these queries has ended; the first failure of
    any of them stops the others and is raised. Other queries of the session,
    running or failed, don't matter."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(POLL_S / len(queries))   # raises what ended the query
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


BACKFILL_BATCH = -1


def run_ingest(spark: SparkSession, source: str, facts_path: str, alerts_path: str | None,
               quarantine_path: str | None = None, batch_id: int = BACKFILL_BATCH,
               checkpoint: str | None = None) -> None:
    """Backfill of wire-message files.

    With ``alerts_path``: the same decode, enrich, validate and write path as
    a ``foreachBatch`` micro-batch, as a writer named after ``source``: its
    partitions present in the input are replaced, so re-running one source
    is exact, and rows of other sources and of streams are untouched.
    Without it: ``facts_path`` is a new store of its own,
    written by the exactly-once store sink over the files (run once,
    ``availableNow``); read it together with the live store by passing
    both paths to ``read_facts`` / ``read_alerts``."""
    if alerts_path is not None:
        write_batch(enrich_stream(spark.read.format("text").load(source)), batch_id,
                    facts_path, alerts_path, quarantine_path,
                    writer=f"files-{hashlib.md5(source.rstrip('/').encode()).hexdigest()}")
        return
    ck = checkpoint or shared_dir(spark, f"backfill/{uuid.uuid4().hex}")
    q = start_store_sink(enrich_stream(read_wire_files(spark, source)), facts_path, ck,
                         {"availableNow": True}, None)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_nightly(spark: SparkSession, facts_path: str, reports_path: str, csv_path: str,
                as_of: dt.date, rollup_path: str | None = None, published: bool = False) -> None:
    """Report one closed day. The day's facts (one pruned partition) are
    summed per (sensor, hour) once; the report, the recommendations and the
    optional hourly rollup upsert all derive from those sums. With
    ``published`` the reports are a published table: the day is replaced after
    its key (date, sensor) was found unique, and stays readable meanwhile."""
    facts = read_facts(spark, facts_path)
    facts = on_day(facts, as_of)
    c = daily.DEFAULT
    hourly = _materialise(spark, A.measure_sums(facts, [c.key, c.date, c.hour]), "nightly")
    (publish_daily_report if published else write_daily_report)(daily.daily_report(hourly), reports_path, as_of)
    write_recommendations(daily.intervention_report(hourly), csv_path, as_of)
    if rollup_path:
        write_hourly_rollup(hourly, rollup_path)
    _discard(spark, hourly)


def _materialise(spark: SparkSession, df, name: str):
    """Write ``df`` once to a fresh folder under the shared checkpoint root and
    read it back: later jobs reuse it and its lineage ends here."""
    path = shared_dir(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._folder = path
    return out


def _discard(spark: SparkSession, df) -> None:
    """Delete a table that ``_materialise`` wrote, at the end of its job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_reports(spark: SparkSession, facts_path: str, alerts_path: str, out: str,
                as_of_ts: dt.datetime, days: int = P.TRAILING_DAYS,
                rollup_path: str | None = None) -> None:
    """Whole-history reports, and the trailing report of the last ``days``.

    The analysis table and the summaries read an hourly rollup (the nightly
    job's, if it holds as many readings as the facts; or one materialised
    here in a single pass over the facts). The trailing statistics, alerts,
    resample, heatmap, summary and raw export read the last days alone, by
    pruned partitions."""
    facts, alerts = read_facts(spark, facts_path), read_alerts(spark, alerts_path)
    c = daily.DEFAULT
    own = None
    if rollup_path:
        hourly = spark.read.parquet(rollup_path)
        held = hourly.agg(F.sum("record_count")).first()[0] or 0
        if held != facts.count():
            raise ValueError(f"the rollup at {rollup_path} holds {held} readings, the facts another number")
    else:
        hourly = own = _materialise(spark, A.measure_sums(facts, [c.key, c.date, c.hour]), "reports")
    export_csv(reports.analysis_table(reports.peak_hour_analysis(hourly, alerts)),
               os.path.join(out, "peak_hour_analysis"))
    write_summary(reports.summary_metrics(hourly, alerts), os.path.join(out, "summary_metrics"))
    write_text_report(reports.summary_lines(hourly, alerts), os.path.join(out, "summary_text"))
    write_text_report(reports.analytical_lines(hourly, alerts), os.path.join(out, "analytical_summary"))
    last, last_alerts = trailing(facts, as_of_ts, days), trailing(alerts, as_of_ts, days)
    write_text_report(reports.summary_lines(last, last_alerts), os.path.join(out, "trailing_summary"))
    for name, df in (("trailing_statistics", reports.sensor_statistics(last, last_alerts)),
                     ("trailing_alert_counts", reports.alert_counts(last_alerts)),
                     ("trailing_alerts", reports.trailing_alerts(alerts, as_of_ts, days)),
                     ("trailing_resample", resample_hourly(last, c.key, c.time, c.count)),
                     ("trailing_heatmap", reports.heatmap_pivot(last))):
        df.write.mode("overwrite").parquet(os.path.join(out, name))
    export_csv(reports.trailing_days(facts, as_of_ts, days).withColumn(c.date, F.to_date(c.time)),
               os.path.join(out, "trailing_export"), partition_by=c.date, order_by=[c.time])
    if own is not None:
        _discard(spark, own)


def run_dashboard(spark: SparkSession, facts_path: str, alerts_path: str, reports_path: str | None,
                  out: str, day: dt.date, status_path: str | None = None) -> None:
    """Materialise the dashboard's five views as small tables (re-run on a
    timer instead of a request per browser poll). With ``status_path`` the
    latest status is a published table that merges the batches that came
    since the last run; without it the whole history is scanned."""
    facts, alerts = read_facts(spark, facts_path), read_alerts(spark, alerts_path)
    if status_path:
        refresh_status(spark, facts_path, status_path)
    views = {
        "current_status": served_status(spark, status_path) if status_path else serving.latest_status(facts),
        "hourly_stats": serving.hour_grid(facts, day),
        "critical_alerts": serving.recent(newest(spark, alerts_path, alerts, P.RECENT_ALERTS, "alert"),
                                          P.RECENT_ALERTS),
        "stats_summary": serving.day_summary(facts, day),
        "checks": ingestion_checks(facts, alerts),
    }
    if reports_path:
        stored = read_daily_reports(spark, reports_path)
        if not Published(spark, reports_path).versions():
            stored = newest(spark, reports_path, stored, P.RECENT_REPORTS, cols=Cols(date="report_date"))
        views["daily_reports"] = serving.stored_recent_reports(stored)
    for name, df in views.items():
        df.write.mode("overwrite").parquet(os.path.join(out, name))


def run_archive(spark: SparkSession, facts_path: str, archive_path: str, before: dt.date) -> list[str]:
    """Pack the closed days before ``before`` of a streamed table, and delete
    the partitions of days packed a day ago or earlier."""
    days = archive_days(spark, facts_path, archive_path, before)
    drop_archived(spark, facts_path, archive_path)
    return days


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    sub = ap.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--source", required=True)
    s.add_argument("--kafka-servers")
    s.add_argument("--facts", required=True)
    s.add_argument("--alerts", help="separate alerts table; omit for one store at --facts")
    s.add_argument("--windows", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--checkpoints")
    s.add_argument("--dedup", action="store_true", help="drop replayed readings within the watermark")
    s.add_argument("--update-windows", action="store_true", help="log every changed window each batch")
    s.add_argument("--status", help="keep a table of the latest status per sensor here")
    s.add_argument("--served", action="store_true", help="status and updated windows as published tables")
    s.add_argument("--new-files", action="store_true", help="files from the first start on; vanished ones are skipped")
    s.add_argument("--late", help="store readings that come too late for their window here")
    s.add_argument("--ledger", help="keep counts of every batch here")
    s.add_argument("--rocksdb", action="store_true", help="streaming state off the heap")
    s.add_argument("--every", default="1 minute", help="trigger interval")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--max-offsets", type=int, help="messages of a micro-batch at most")
    s.add_argument("--max-files", type=int, help="files of a micro-batch at most")
    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True)
    i.add_argument("--facts", required=True)
    i.add_argument("--alerts", help="foreachBatch layout; omit to write a new store at --facts")
    i.add_argument("--quarantine")
    n = sub.add_parser("nightly")
    n.add_argument("--facts", required=True)
    n.add_argument("--reports", required=True)
    n.add_argument("--csv", required=True)
    n.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    n.add_argument("--rollup")
    n.add_argument("--published", action="store_true", help="reports as a published table")
    r = sub.add_parser("reports")
    r.add_argument("--facts", required=True)
    r.add_argument("--alerts", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--as-of", type=dt.datetime.fromisoformat, required=True)
    r.add_argument("--days", type=int, default=P.TRAILING_DAYS)
    r.add_argument("--rollup")
    d = sub.add_parser("dashboard")
    d.add_argument("--facts", required=True)
    d.add_argument("--alerts", required=True)
    d.add_argument("--reports")
    d.add_argument("--out", required=True)
    d.add_argument("--day", type=dt.date.fromisoformat, required=True)
    d.add_argument("--status", help="published status table, kept up batch by batch")
    c = sub.add_parser("archive")
    c.add_argument("--facts", required=True, help="a table of facts or alerts by event_date, writer and batch_id")
    c.add_argument("--archive", required=True)
    c.add_argument("--before", type=dt.date.fromisoformat, required=True)
    a = ap.parse_args(argv)
    spark = get_session(f"roadpulse-{a.job}", rocksdb_state=getattr(a, "rocksdb", False))
    if a.job == "stream":
        await_all(spark, run_stream(
            spark, a.source, a.facts, a.alerts, a.windows, a.kafka_servers, a.available_now, a.max_files,
            a.checkpoints, a.dedup, a.update_windows, a.status, a.every, a.starting_offsets, a.max_offsets,
            a.served, a.late, a.ledger, not a.new_files))
    elif a.job == "ingest":
        run_ingest(spark, a.source, a.facts, a.alerts, a.quarantine)
    elif a.job == "nightly":
        run_nightly(spark, a.facts, a.reports, a.csv, a.as_of, a.rollup, a.published)
    elif a.job == "dashboard":
        run_dashboard(spark, a.facts, a.alerts, a.reports, a.out, a.day, a.status)
    elif a.job == "archive":
        run_archive(spark, a.facts, a.archive, a.before)
    else:
        run_reports(spark, a.facts, a.alerts, a.out, a.as_of, a.days, a.rollup)


if __name__ == "__main__":
    main()
