"""Closed days packed from micro-batch partitions; the latest status kept up
from new batches alone."""

import datetime as dt
import os

from pyspark.sql import functions as F

from roadpulse import jobs
from roadpulse.plans.serving import latest_status
from roadpulse.sinks import Published
from roadpulse.sinks.archive import archive_days, drop_archived, read_archived, stored_batches
from roadpulse.streaming import enrich_stream
from roadpulse.streaming.pipeline import write_batch
from roadpulse.streaming.served import refresh_status, served_status
from tests.test_streaming import message

DAY = dt.datetime(2024, 1, 14)


def store(spark, path, batch_id, times, writer="w", count=50):
    lines = [message(f"J{k % 4 + 1}", t, count + k, 5 + k % 40) for k, t in enumerate(times)]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    write_batch(enrich_stream(raw), batch_id, f"{path}/facts", f"{path}/alerts", writer=writer)


def days(first, n=6, hours=11):
    return [DAY + dt.timedelta(days=first, hours=hours, minutes=m) for m in range(n)]


def rows(df):
    return sorted((r.event_id, str(r.event_date), r.vehicle_count, r.writer, r.batch_id) for r in df.collect())


def test_closed_days_become_few_files(spark, tmp):
    for k in range(12):
        store(spark, tmp, k, days(k // 6, hours=k % 6))
    facts, archive = f"{tmp}/facts", f"{tmp}/archive"
    whole = rows(read_archived(spark, facts, archive))
    assert len(whole) == 72
    before = read_archived(spark, facts, archive)            # a reader of the old form
    assert archive_days(spark, facts, archive, dt.date(2024, 1, 15)) == ["2024-01-14"]
    table = Published(spark, archive)
    assert len(table.read().inputFiles()) == 1 and table.manifest()["meta"]["batches/2024-01-14"] == {"w": [[0, 5]]}
    assert rows(read_archived(spark, facts, archive)) == whole == rows(before)
    assert archive_days(spark, facts, archive, dt.date(2024, 1, 15)) == []
    assert drop_archived(spark, facts, archive) == 0 and drop_archived(spark, facts, archive, 0) == 6
    assert rows(read_archived(spark, facts, archive)) == whole
    assert len(stored_batches(spark, facts)) == 6
    live = [f for f in read_archived(spark, facts, archive).inputFiles() if "/facts/" in f]
    assert live and all("2024-01-15" in f for f in live)


def test_late_batches_of_a_packed_day(spark, tmp):
    facts, archive = f"{tmp}/facts", f"{tmp}/archive"
    store(spark, tmp, 0, days(0))
    archive_days(spark, facts, archive, dt.date(2024, 1, 20))
    store(spark, tmp, 1, days(0, 3, 15))
    store(spark, tmp, 0, days(0, 2, 17), writer="other")
    assert len(rows(read_archived(spark, facts, archive))) == 11      # not packed yet, read all the same
    jobs.run_archive(spark, facts, archive, dt.date(2024, 1, 20))
    table = Published(spark, archive)
    assert table.read().count() == 11 and len(table.read().inputFiles()) == 1
    assert table.manifest()["meta"]["batches/2024-01-14"] == {"w": [[0, 1]], "other": [[0, 0]]}
    assert len(rows(read_archived(spark, facts, archive))) == 11


def test_files_follow_the_size(spark, tmp):
    facts, archive = f"{tmp}/facts", f"{tmp}/archive"
    for k in range(8):
        store(spark, tmp, k, days(0, hours=k))
    size = sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(facts) for n in names if n.startswith("part-"))
    archive_days(spark, facts, archive, dt.date(2024, 1, 20), file_bytes=-(-size // 3))
    assert len(Published(spark, archive).read().inputFiles()) == 3


def test_status_reads_new_batches_alone(spark, tmp):
    facts, status = f"{tmp}/facts", f"{tmp}/status"
    store(spark, tmp, 0, days(0))
    store(spark, tmp, 1, days(1))

    def same():
        want = latest_status(spark.read.parquet(facts).withColumn("event_time", F.col("event_time")))
        cols = ["sensor_id", "event_id", "event_time", "vehicle_count"]
        assert sorted(map(tuple, served_status(spark, status).select(*cols).collect())) == sorted(
            map(tuple, want.select(*cols).collect()))

    refresh_status(spark, facts, status)
    same()
    assert refresh_status(spark, facts, status) is None
    store(spark, tmp, 2, days(2, 2))                               # two of four sensors
    read = refresh_status(spark, facts, status).inputFiles()
    assert read and all("event_date=2024-01-16" in f for f in read)
    same()
    store(spark, tmp, 0, days(1, 4, 23), writer="late", count=90)  # late for their day, newer for two sensors
    read = refresh_status(spark, facts, status).inputFiles()
    assert read and all("writer=late" in f for f in read)
    same()


def test_dashboard_with_a_status_table(spark, tmp):
    store(spark, tmp, 0, days(0))
    for k in (1, 2):
        store(spark, tmp, k, days(k))
        jobs.run_dashboard(spark, f"{tmp}/facts", f"{tmp}/alerts", None, f"{tmp}/out", dt.date(2024, 1, 15), f"{tmp}/status")
        got = spark.read.parquet(f"{tmp}/out/current_status")
        assert sorted(r.event_id for r in got.collect()) == sorted(
            r.event_id for r in latest_status(spark.read.parquet(f"{tmp}/facts")).collect())
