"""Streams whose results are always readable, bounded to read, and accounted
for batch by batch: published tables instead of folders overwritten in place.

- ``start_served_status``: the latest reading per sensor, merged by update
  mode into hash buckets of which only the touched ones are rewritten.
- ``window_table_sink``: changed windows as deltas, folded into a snapshot by
  date, so a reader meets the snapshot and a bounded number of deltas.
- ``start_late_split``: readings whose window the watermark of earlier
  batches had closed go to a table of their own with their lateness; all
  others go on. Spark only counts what it drops, after partial aggregation.
- ``Ledger``: one row per (query, batch) of what came in and where it went.

Every sink records the last batch of its writer in the version it publishes,
so a replayed batch changes nothing.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from roadpulse import params as P
from roadpulse.operators.ranking import latest_per_key
from roadpulse.sinks.archive import read_batches, stored_batches
from roadpulse.sinks.published import Published
from roadpulse.streaming.pipeline import (
    WINDOW_KEY, latest_status_stream, valid_only, writer_of,
)

STATUS_BUCKETS = 16
FOLD_EVERY = 20     # deltas that a reader meets at most, about


def _start(df: DataFrame, mode: str, on_batch: Callable, checkpoint: str, trigger: dict | None,
           name: str | None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.queryName(name) if name else w
    return (w.trigger(**trigger) if trigger else w).start()


# --- latest status ------------------------------------------------------------

def merge_status(rows: DataFrame, path: str, writer: str | None, batch_id: int | None,
                 buckets: int = STATUS_BUCKETS, merged: dict[str, int] | None = None) -> None:
    """Merge latest readings into the status table: per sensor the later one
    (ties: larger event id) stays, also against what another checkpoint
    wrote. Only buckets of the sensors in ``rows`` are rewritten. ``merged``
    are the last batches of several writers that ``rows`` hold."""
    bucket = F.pmod(F.xxhash64("sensor_id"), F.lit(buckets))
    Published(rows.sparkSession, path).upsert(rows, ["sensor_id"], bucket, ["event_time", "event_id"], writer, batch_id,
                                              merged=merged)


def start_served_status(enriched: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                        name: str | None = None, buckets: int = STATUS_BUCKETS) -> StreamingQuery:
    """Keep the latest valid reading per sensor in a published table: update
    mode gives the changed sensors alone. Read with ``served_status``."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                merge_status(batch, path, writer_of(batch), batch_id, buckets)
        finally:
            batch.unpersist()
    return _start(latest_status_stream(valid_only(enriched)), "update", on_batch, checkpoint, trigger, name)


def served_status(spark: SparkSession, path: str) -> DataFrame:
    """The newest published status table."""
    return Published(spark, path).read()


def refresh_status(spark: SparkSession, facts_path: str, path: str, buckets: int = STATUS_BUCKETS) -> DataFrame | None:
    """Bring a status table up to a streamed facts table (partitions
    event_date, writer, batch_id): only batches it has not merged are listed
    and read, whatever the times of their readings. The rows read, None if
    there was nothing new. A batch counts as merged by its writer's batch id."""
    table = Published(spark, path)
    seen = table.manifest()["writers"]
    fresh = {k: f for k, f in stored_batches(spark, facts_path).items() if k[2] > seen.get(k[1], -2)}
    if not fresh:
        return None
    rows = read_batches(spark, facts_path, sorted(fresh.values()))
    columns = ["sensor_id", "event_id", "event_time", "vehicle_count", "avg_speed", "congestion_index", "traffic_status"]
    latest = latest_per_key(rows, "sensor_id", "event_time", "event_id", [c for c in columns if c != "sensor_id"])
    last = {w: max(b for _, x, b in fresh if x == w) for _, w, _ in fresh}
    merge_status(latest.select(*columns), path, None, None, buckets, last)
    return rows


# --- windows ------------------------------------------------------------------

def append_windows(changed: DataFrame, path: str, writer: str, batch_id: int, fold_every: int = FOLD_EVERY) -> None:
    """Log the new values of changed windows; with ``fold_every`` deltas they
    are folded into the snapshot of the dates they touch."""
    table = Published(changed.sparkSession, path)
    table.append(changed, writer, batch_id)
    table.fold(F.to_date("window_start"), WINDOW_KEY, fold_every)


def window_table_sink(path: str, fold_every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    """``on_batch`` of ``start_windows(output_mode="update")``: a delta per
    batch and a snapshot. Read with ``window_table``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                append_windows(batch, path, writer_of(batch), batch_id, fold_every)
        finally:
            batch.unpersist()
    return write


def window_table(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Current value of every window (from the date ``since`` on): the
    snapshot's dates that can hold it and the deltas since, the version
    written last. Other dates' files are not read."""
    table = Published(spark, path)
    wanted = None if since is None else (lambda s: s.startswith("delta-") or s >= since.isoformat())
    now = table.newest(WINDOW_KEY, wanted).drop("_seq")
    return now if since is None else now.filter(F.to_date("window_start") >= F.lit(since))


# --- late readings --------------------------------------------------------------

def _micros(time_: str | Column) -> Column:
    """Microseconds of a time since 1970, of naive times as they stand."""
    return F.unix_micros((F.col(time_) if isinstance(time_, str) else time_).cast("timestamp"))


def _length(interval: str) -> int:
    """Microseconds of an interval such as "10 minutes"."""
    return pd.Timedelta(interval) // pd.Timedelta(1, "us")


def closed_by(watermark_us: Column, time_: str = "event_time", duration: str = P.WINDOW) -> Column:
    """Whether a reading's window had ended by a watermark (in microseconds;
    no watermark or time: no)."""
    size = F.lit(_length(duration))
    end = _micros(time_) - F.pmod(_micros(time_), size) + size
    return F.coalesce(end <= watermark_us, F.lit(False))


def lateness(watermark_us: Column, time_: str = "event_time") -> Column:
    """Whole seconds that a reading lies behind a watermark."""
    return F.floor((watermark_us - _micros(time_)) / F.lit(1_000_000)).cast("long")


def late_by_batch(readings: DataFrame, batch: str, delay: str = P.WATERMARK, duration: str = P.WINDOW,
                  time_: str = "event_time") -> DataFrame:
    """Per arrival batch: rows, on-time rows, late rows and the largest
    lateness in whole seconds. A batch meets the watermark of the batches
    before it, their latest time less ``delay``; a reading is late if its
    window had closed by then. One row per batch is joined back; the readings
    are not sorted."""
    tops = readings.groupBy(batch).agg(F.max(_micros(time_)).alias("_top"))
    earlier = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)   # one row per batch
    marks = tops.select(F.col(batch), (F.max("_top").over(earlier) - _length(delay)).alias("_mark"))
    late = F.col("_late")
    return (readings.select(batch, time_).join(marks, batch).withColumn("_late", closed_by(F.col("_mark"), time_, duration))
            .groupBy(batch).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(~late).alias("on_time"),
                                F.count_if(late).alias("late"),
                                F.max(F.when(late, lateness(F.col("_mark"), time_))).alias("max_lateness_s")))


def split_late(batch: DataFrame, late_path: str, writer: str, batch_id: int, delay: str = P.WATERMARK,
               duration: str = P.WINDOW) -> tuple[DataFrame, dict]:
    """Store a batch's late rows with their lateness; its on-time rows, and
    the counts (rows, on_time, late). The watermark of the batches before is
    stored with the late rows: a replayed batch meets the same one, splits
    alike and is stored once."""
    table, key = Published(batch.sparkSession, late_path), f"watermark/{writer}"
    held = table.manifest()["meta"].get(key, {"batch": -1, "before": None, "after": None})
    before = held["before"] if held["batch"] == batch_id else held["after"]
    mark_us = F.lit(before).cast("long")
    late = closed_by(mark_us, "event_time", duration)
    got = batch.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(late).alias("late"),
                    F.max(_micros("event_time")).alias("top")).first()
    after = max((x for x in (before, got.top - _length(delay) if got.top is not None else None) if x is not None),
                default=None)
    rows = batch.filter(late).withColumn("lateness_s", lateness(mark_us))
    table.append(rows.withColumn("late_batch", F.lit(batch_id).cast("long")), writer, batch_id,
                 {key: {"batch": batch_id, "before": before, "after": after}})
    table.fold(F.to_date("event_time"), None, FOLD_EVERY)
    return batch.filter(~late), {"row_count": got.row_count, "on_time": got.row_count - got.late, "late": got.late}


def start_late_split(enriched: DataFrame, late_path: str, checkpoint: str,
                     on_batch: Callable[[DataFrame, int], None] | None = None, ledger: str | None = None,
                     delay: str = P.WATERMARK, duration: str = P.WINDOW, trigger: dict | None = None,
                     name: str | None = None) -> StreamingQuery:
    """Send valid readings that come too late for their window to a published
    table (all columns, ``lateness_s``, ``late_batch``), all others to
    ``on_batch``. On-time and late rows are together the valid input exactly;
    the ledger says how many each."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch)
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            on_time, counts = split_late(batch, late_path, writer, batch_id, delay, duration)
            if on_batch is not None:
                on_batch(on_time, batch_id)
            if ledger:
                Ledger(batch.sparkSession, ledger).record(writer, batch_id, name, counts)
        finally:
            batch.unpersist()
    return _start(valid_only(enriched), "append", write, checkpoint, trigger, name)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """All late rows stored so far."""
    return Published(spark, path).read().drop("_seq")


# --- batch ledger ---------------------------------------------------------------

LEDGER = ("query_id string, batch_id long, query_name string, recorded_at timestamp, row_count long, on_time long, "
          "late long, facts long, critical long, rejected long, dropped_by_watermark long")
LEDGER_KEY = ["query_id", "batch_id"]


class Ledger:
    """A published table with a row per (query id, batch id): counts of what a
    batch brought and where it went. A batch is recorded once, however often
    it is replayed; the table outlives sessions."""

    def __init__(self, spark: SparkSession, path: str, fold_every: int = FOLD_EVERY):
        self.spark, self.path, self.fold_every = spark, path, fold_every

    def record(self, query_id: str, batch_id: int, name: str | None, counts: dict) -> None:
        known = ("row_count", "on_time", "late", "facts", "critical", "rejected", "dropped_by_watermark")
        row = (query_id, batch_id, name, dt.datetime.fromtimestamp(time.time()), *(counts.get(c) for c in known))
        table = Published(self.spark, self.path)
        table.append(self.spark.createDataFrame([row], LEDGER), query_id, batch_id)
        table.fold(F.to_date("recorded_at"), LEDGER_KEY, self.fold_every)

    def read(self) -> DataFrame:
        return Published(self.spark, self.path).read().drop("_seq")


class LedgerListener(StreamingQueryListener):
    """Records the progress reports of every query of a session: input rows
    and rows that stateful operators dropped as late, for the whole life of a
    query. For queries without ``foreachBatch``, such as the file sinks; a
    report that comes after the session died is lost."""

    def __init__(self, spark: SparkSession, path: str):
        self.ledger = Ledger(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            dropped = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
            self.ledger.record(str(p.id), p.batchId, p.name, {"row_count": p.numInputRows, "dropped_by_watermark": dropped})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
