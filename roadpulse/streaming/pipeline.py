"""Structured Streaming: wire source -> decode/enrich -> facts + alerts sink,
watermarked 5-minute windows, and latest status per sensor.

- One parse per micro-batch: facts and alerts are written by the same
  ``foreachBatch`` from one persisted batch.
- Exactly-once output: each batch writes partitions (event_date, writer,
  batch_id) with dynamic overwrite, so a replayed batch replaces its own
  files and no other writer's. The writer is the streaming query's id, which
  its checkpoint holds; a new checkpoint is a new writer.
- Messages that can't be decoded keep their text in the quarantine.
- Sink errors propagate (the query fails and the batch is replayed).
- Every stateful operator is bounded: windows by the watermark, latest
  status by the number of sensors.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse import params as P
from roadpulse.operators.aggregates import window_measures
from roadpulse.operators.quality import with_reject_reason
from roadpulse.operators.ranking import latest_per_key
from roadpulse.schema import ALERT_COLUMNS, FACT_COLUMNS
from roadpulse.sources.telemetry import enrich
from roadpulse.sources.wire import decode_wire

log = logging.getLogger("roadpulse.streaming")

RAW = "raw_message"   # text of a message, kept with rejected rows


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to a topic (needs the spark-sql-kafka package on the classpath).
    ``max_offsets_per_trigger`` bounds each micro-batch (and its state work)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def read_wire_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    since: dt.datetime | None = None, tolerate_loss: bool = False) -> DataFrame:
    """Wire messages from newline-delimited JSON text files (one message per
    line). ``since`` leaves out files modified before it (``start_cutoff``:
    start at the latest); with ``tolerate_loss`` a file that vanishes after it
    was listed is skipped instead of ending the query."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if tolerate_loss:
        r = r.option("ignoreMissingFiles", True)
    df = r.load(path)
    if since is None:
        return df
    modified = F.unix_micros("_metadata.file_modification_time")
    return df.filter(modified >= F.lit(int(since.timestamp() * 1_000_000))).select("value")


def start_cutoff(spark: SparkSession, checkpoint: str, now: dt.datetime | None = None) -> dt.datetime:
    """The moment a stream first started, kept beside its checkpoint: written
    by the first start, read by every later one."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/start_cutoff")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        out = fs.create(at, False)
        out.write(bytearray((now or dt.datetime.now(dt.timezone.utc)).isoformat().encode()))
        out.close()
    stream = fs.open(at)
    try:
        return dt.datetime.fromisoformat(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def enrich_stream(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode and enrich a stream of wire messages.

    Event time becomes TIMESTAMP (session time zone UTC) because watermarks
    reject TIMESTAMP_NTZ. ``processing_time`` is the batch's current time.
    Rows without an event id get a deterministic 64-bit one from the message
    fields (a row identifier and tie-breaker; dedup uses the exact key).
    """
    keep = ("event_id",) if "event_id" in raw.columns else ()
    raw = raw.withColumn(RAW, F.col(value_col).cast("string"))
    d = decode_wire(raw, value_col=value_col, keep=(*keep, RAW))
    if not keep:
        fields = [F.col(c) for c in ("sensor_id", "timestamp", "vehicle_count", "avg_speed")]
        broken = F.coalesce(*[c.cast("string") for c in fields]).isNull()
        d = d.withColumn("event_id", F.when(broken, F.xxhash64(RAW)).otherwise(F.xxhash64(*fields)))
    # Hour and date come from the naive wall-clock time; only then does
    # event_time become TIMESTAMP for the watermark.
    e = enrich(d).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return e.withColumn("processing_time", F.current_timestamp())


def dedup_events(enriched: DataFrame, delay: str = P.WATERMARK,
                 keys: tuple[str, ...] = ("sensor_id", "event_time")) -> DataFrame:
    """Drop replayed messages within the watermark delay.

    The default key is the reading's natural identity (one reading per
    sensor and time), compared exactly; pass ("event_id",) when the source
    assigns ids."""
    return enriched.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def valid_only(enriched: DataFrame) -> DataFrame:
    """Rows that pass the quarantine checks; rejected readings must not reach
    windows or the latest status."""
    return with_reject_reason(enriched).filter(F.col("reject_reason").isNull()).drop("reject_reason", RAW)


def writer_of(batch: DataFrame) -> str:
    """Id of the streaming query that a foreachBatch frame belongs to: the
    same after a restart from its checkpoint, another for a new checkpoint."""
    writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not writer:
        raise ValueError("not a streaming batch: name the writer")
    return writer


def quarantine_path_for(facts_path: str) -> str:
    """Default quarantine table: a sibling of the facts table."""
    return facts_path.rstrip("/") + "_quarantine"


def _overwrite_batch(df: DataFrame, path: str, part: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(part, "writer", "batch_id").parquet(path))


def write_batch(batch: DataFrame, batch_id: int, facts_path: str, alerts_path: str,
                quarantine_path: str | None = None, writer: str | None = None, ledger: str | None = None,
                name: str | None = None) -> None:
    """One micro-batch: valid rows -> facts (all) and alerts (critical); rows
    failing the NOT NULL / range checks -> quarantine with their reasons and
    text. Every write replaces only the partitions of this writer and batch,
    so a replay is exact and other writers' rows stay. The counts go to the
    batch ledger last, if there is one: a batch it holds is stored."""
    writer = writer or writer_of(batch)
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        tagged = (with_reject_reason(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
                  .withColumn("writer", F.lit(writer)))
        valid = tagged.filter(F.col("reject_reason").isNull())
        # Row counts ride along with the facts write (no second job over the batch).
        counts = Observation(f"facts_batch_{batch_id}")
        _overwrite_batch(valid.select(*FACT_COLUMNS, "processing_time", "writer", "batch_id")
                              .observe(counts, F.count(F.lit(1)).alias("rows"),
                                       F.count_if(F.coalesce(F.col("traffic_status"), F.lit(False)))
                                        .alias("critical")),
                         facts_path, "event_date")
        held = counts.get
        log.info("batch %s: %s", batch_id, held)
        _overwrite_batch(valid.filter(F.col("traffic_status")).select(*ALERT_COLUMNS, "writer", "batch_id"),
                         alerts_path, "event_date")
        rejected = tagged.filter(F.col("reject_reason").isNotNull())
        bad = rejected.count()         # cheap: the batch is persisted
        if bad:
            # By the event's own date where it has one: a rerun on another day
            # replaces the same partitions.
            _overwrite_batch(rejected, quarantine_path or quarantine_path_for(facts_path), "event_date")
        if ledger:
            from roadpulse.streaming.served import Ledger
            Ledger(batch.sparkSession, ledger).record(writer, batch_id, name, {
                "row_count": held["rows"] + bad, "facts": held["rows"], "critical": held["critical"], "rejected": bad})
    finally:
        batch.unpersist()


def start_fact_sinks(enriched: DataFrame, facts_path: str, alerts_path: str, checkpoint: str,
                     trigger: dict | None = None, name: str | None = None,
                     quarantine_path: str | None = None, ledger: str | None = None) -> StreamingQuery:
    """Append valid events to the facts table, critical ones to the alerts
    table, and invalid ones (with reasons) to the quarantine table."""
    w = (enriched.writeStream
         .foreachBatch(lambda df, bid: write_batch(df, bid, facts_path, alerts_path, quarantine_path,
                                                     ledger=ledger, name=name))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(**trigger) if trigger else w
    return w.start()


def start_store_sink(enriched: DataFrame, store_path: str, checkpoint: str,
                     trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """One exactly-once file-sink query for facts, alerts and quarantine.

    Each reading becomes a ``kind=fact`` row (valid), plus a ``kind=alert``
    copy when critical, or a ``kind=quarantine`` row with its reasons. The
    rows go to one parquet store partitioned by (kind, event_date) whose
    metadata log makes the output exactly-once. Partitions stay kinds x
    dates however often the trigger fires. Read it with ``read_facts`` /
    ``read_alerts`` / ``read_quarantine``; never point a second query (or a
    new checkpoint) at the same store.
    """
    tagged = with_reject_reason(enriched)
    valid = F.col("reject_reason").isNull()
    critical = valid & F.coalesce(F.col("traffic_status"), F.lit(False))
    kinds = F.array(F.when(valid, F.lit("fact")), F.when(critical, F.lit("alert")),
                    F.when(~valid, F.lit("quarantine")))
    rows = (tagged.select(*[c for c in FACT_COLUMNS if c != "event_date"], "processing_time", "reject_reason",
                          F.coalesce(F.col("event_date"), F.to_date("processing_time")).alias("event_date"),
                          F.when(~valid, F.col(RAW)).alias(RAW), F.explode(kinds).alias("kind"))
                  .filter(F.col("kind").isNotNull()))
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("path", store_path).option("checkpointLocation", checkpoint)
         .partitionBy("kind", "event_date"))
    if name:
        w = w.queryName(name)
    w = w.trigger(**trigger) if trigger else w
    return w.start()


def windowed(enriched: DataFrame, duration: str = P.WINDOW, delay: str | None = P.WATERMARK) -> DataFrame:
    """Watermarked tumbling windows per sensor (same operator as batch); no
    ``delay``: the stream has its watermark already (``dedup_events``)."""
    return window_measures(enriched.withWatermark("event_time", delay) if delay else enriched, duration)


def start_windows(enriched: DataFrame, checkpoint: str, path: str | None = None,
                  output_mode: str = "append", on_batch: Callable | None = None,
                  trigger: dict | None = None, duration: str = P.WINDOW,
                  delay: str | None = P.WATERMARK, name: str | None = None) -> StreamingQuery:
    """Start the window aggregate.

    ``append`` emits each window once, when the watermark passes its end, to
    a parquet file sink partitioned by ``window_date`` (exactly-once).
    ``update`` emits changed windows every batch to ``on_batch(df, batch_id)``
    (for example ``window_update_sink``), which keys them on
    (window_start, sensor_id).
    """
    agg = windowed(enriched, duration, delay)
    if on_batch is None:
        if output_mode != "append" or path is None:
            raise ValueError("a file sink needs append mode and a path; pass on_batch otherwise")
        agg = agg.withColumn("window_date", F.to_date("window_start"))
    w = agg.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if on_batch is not None:
        w = w.foreachBatch(on_batch)
    else:
        w = w.format("parquet").option("path", path).partitionBy("window_date")
    w = w.trigger(**trigger) if trigger else w
    return w.start()


def latest_status_stream(enriched: DataFrame) -> DataFrame:
    """Latest reading per sensor as a streaming aggregate (update/complete
    mode). State is one row per sensor."""
    return latest_per_key(enriched, "sensor_id", "event_time", "event_id",
                          ["event_id", "event_time", "vehicle_count", "avg_speed",
                           "congestion_index", "traffic_status"])


def start_latest_status(enriched: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                        name: str | None = None) -> StreamingQuery:
    """Keep a table of the latest valid reading per sensor: the whole small
    result (a row per sensor) replaces the table every batch."""
    w = (latest_status_stream(valid_only(enriched)).writeStream.outputMode("complete")
         .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(**trigger) if trigger else w
    return w.start()


def watermark_drops(query: StreamingQuery) -> int:
    """Rows dropped as too late, summed over the stateful operators of the
    progress reports that the session still keeps
    (``spark.sql.streaming.numRecentProgressUpdates``); for the whole life of
    a long-running query add up the reports of a StreamingQueryListener."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(v or 0)
    return total


WINDOW_KEY = ["window_start", "sensor_id"]


def window_update_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback for update-mode windows: every emitted version of
    a window is appended under partition (window_date, writer, batch_id) with
    the time it was written; replaying a batch overwrites its own partition,
    another checkpoint's versions stay. Read with ``latest_windows``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _overwrite_batch(batch.withColumn("window_date", F.to_date("window_start"))
                         .withColumn("written_at", F.current_timestamp())
                         .withColumn("writer", F.lit(writer_of(batch)))
                         .withColumn("batch_id", F.lit(batch_id).cast("long")), path, "window_date")
    return write


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """Current value of each (window, sensor): the version written last
    (grouped max_by, partially aggregated)."""
    versions = spark.read.parquet(path)
    values = [c for c in versions.columns
              if c not in (*WINDOW_KEY, "window_date", "writer", "batch_id", "written_at")]
    return (versions.groupBy(*WINDOW_KEY)
                    .agg(F.max_by(F.struct(*values), F.struct("written_at", "batch_id")).alias("_v"))
                    .select(*WINDOW_KEY, "_v.*"))
