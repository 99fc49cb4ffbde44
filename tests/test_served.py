"""Streams into published tables: status, windows, late readings, ledger."""

import datetime as dt
import os
import threading

from pyspark.sql import functions as F

from roadpulse import jobs
from roadpulse.operators.aggregates import window_measures
from roadpulse.plans.serving import latest_status
from roadpulse.sinks import Published
from roadpulse.streaming import (Ledger, LedgerListener, enrich_stream, late_rows, read_wire_files, served_status,
                                 start_fact_sinks, start_late_split, start_served_status, start_store_sink,
                                 start_windows, window_table, window_table_sink)
from roadpulse.streaming import served
from roadpulse.streaming.pipeline import valid_only
from tests.test_streaming import BASE, in_order_batches, message, run, write_files


def stream(spark, src):
    return enrich_stream(read_wire_files(spark, src, max_files_per_trigger=1))


def replay(ck, batch):
    for name in (str(batch), f".{batch}.crc"):
        os.remove(os.path.join(ck, "commits", name))


def test_status_is_readable_while_it_changes(spark, tmp):
    src, path, ck = (os.path.join(tmp, x) for x in ("in", "status", "ck"))
    batches = [[message(f"J{(b + k) % 5 + 1}", BASE + dt.timedelta(minutes=b, seconds=k), 50 + b, 20) for k in range(3)]
               for b in range(12)]
    write_files(src, batches)
    seen, failed, done = [], [], threading.Event()

    def reader():
        while not done.is_set():
            try:
                seen.append(len(served_status(spark, path).collect()))
            except FileNotFoundError:
                pass             # before the first batch
            except Exception as error:
                failed.append(error)

    t = threading.Thread(target=reader)
    t.start()
    run(start_served_status(stream(spark, src), path, ck, {"availableNow": True}, buckets=4))
    done.set()
    t.join()
    assert not failed and seen == sorted(seen) and len(seen) > 3
    want = sorted(map(tuple, latest_status(enrich_stream(spark.read.text(src))).select("sensor_id", "event_id", "vehicle_count").collect()))
    got = lambda: sorted(map(tuple, served_status(spark, path).select("sensor_id", "event_id", "vehicle_count").collect()))
    assert got() == want
    replay(ck, 11)
    run(start_served_status(stream(spark, src), path, ck, {"availableNow": True}, buckets=4))
    assert got() == want


def test_an_older_reading_of_another_checkpoint_changes_nothing(spark, tmp):
    path = os.path.join(tmp, "status")
    for name, minute, count in (("new", 30, 90), ("old", 10, 40)):
        src = os.path.join(tmp, name)
        write_files(src, [[message("J1", BASE + dt.timedelta(minutes=minute), count, 20)]])
        run(start_served_status(stream(spark, src), path, os.path.join(tmp, "ck-" + name), {"availableNow": True}))
    assert [r.vehicle_count for r in served_status(spark, path).collect()] == [90]


def test_window_table_equals_batch_and_stays_bounded(spark, tmp):
    src, path, ck = (os.path.join(tmp, x) for x in ("in", "windows", "ck"))
    batches = [[message(f"J{k % 3 + 1}", BASE + dt.timedelta(minutes=3 * b + k), 50 + b, 20 + k) for k in range(4)]
               for b in range(9)]
    write_files(src, batches)
    for again in range(2):
        run(start_windows(valid_only(stream(spark, src)), ck, output_mode="update",
                          on_batch=window_table_sink(path, fold_every=3), trigger={"availableNow": True}))
        want = window_measures(enrich_stream(spark.read.text(src)), "5 minutes")
        got = window_table(spark, path)
        cols = sorted(want.columns)
        assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
        table = Published(spark, path)
        assert len(table.deltas(table.manifest())) < 3
        if not again:
            replay(ck, 8)
    assert window_table(spark, path, BASE.date()).count() == want.count()
    assert window_table(spark, path, BASE.date() + dt.timedelta(days=1)).count() == 0


def test_rows_read_stay_bounded_over_many_batches(spark, tmp):
    """200 logged batches of an hour of windows: a reader meets the snapshot
    and fewer than ``fold_every`` deltas."""
    table = Published(spark, os.path.join(tmp, "w"), keep=3)
    rows = spark.range(12).select(F.expr("timestamp'2024-01-15 10:00:00' + make_interval(0,0,0,0,0,5*id)").alias("window_start"),
                                  F.lit("J1").alias("sensor_id"), F.lit(0).cast("long").alias("record_count")).coalesce(1)
    for k in range(60):
        served.append_windows(rows.withColumn("record_count", F.lit(k).cast("long")), table.path, "w", k, fold_every=10)
    m = table.manifest()
    assert len(table.deltas(m)) < 10 and table.read(manifest=m).count() <= 12 * 11
    assert {r.record_count for r in window_table(spark, table.path).collect()} == {59}


def late_batches():
    out = in_order_batches()
    early = BASE + dt.timedelta(minutes=5)
    # Closed windows; within the delay; and a reading before its window closed.
    out.append([message("J1", early, 999, 3), message("J2", early + dt.timedelta(seconds=1), 998, 30),
                message("J1", BASE + dt.timedelta(minutes=58), 60, 20), message("J3", BASE + dt.timedelta(minutes=50), 61, 20)])
    out.append([message("J1", early, 997, 3), "{broken"])
    return out


def test_on_time_and_late_rows_are_the_input(spark, tmp):
    src, late, ck, ledger, on_time = (os.path.join(tmp, x) for x in ("in", "late", "ck", "ledger", "on_time"))
    write_files(src, late_batches())

    def keep(df, batch_id):
        df.select("event_id", "vehicle_count").write.mode("overwrite").parquet(f"{on_time}/batch={batch_id}")

    for again in range(2):
        run(start_late_split(stream(spark, src), late, ck, keep, ledger, trigger={"availableNow": True}, name="late"))
        got = late_rows(spark, late).collect()
        assert sorted(r.vehicle_count for r in got) == [997, 998, 999]
        assert {r.vehicle_count: (r.late_batch, r.lateness_s) for r in got} == {
            999: (3, 44 * 60 + 7), 998: (3, 44 * 60 + 6), 997: (4, 44 * 60 + 7)}
        kept = sorted(r.event_id for r in spark.read.parquet(on_time).collect())
        whole = sorted(r.event_id for r in valid_only(enrich_stream(spark.read.text(src))).collect())
        assert sorted(kept + [r.event_id for r in got]) == whole
        entries = {r.batch_id: (r.row_count, r.on_time, r.late) for r in Ledger(spark, ledger).read().collect()}
        assert entries == {0: (20, 20, 0), 1: (20, 20, 0), 2: (20, 20, 0), 3: (4, 2, 2), 4: (1, 0, 1)}
        if not again:
            replay(ck, 4)        # the last batch again: split alike, stored once


def test_ledger_sums_equal_the_stores_over_a_restart(spark, tmp):
    src, facts, alerts, ck, ledger = (os.path.join(tmp, x) for x in ("in", "facts", "alerts", "ck", "ledger"))
    batches = in_order_batches()
    batches[1] += ["{broken json"]

    def once():
        run(start_fact_sinks(stream(spark, src), facts, alerts, ck, {"availableNow": True}, "facts", ledger=ledger))

    write_files(src, batches[:2])
    once()
    write_files(src, batches)
    replay(ck, 1)
    once()
    rows = Ledger(spark, ledger).read().collect()
    assert len(rows) == len({(r.query_id, r.batch_id) for r in rows}) and len({r.query_id for r in rows}) == 1
    assert {r.query_name for r in rows} == {"facts"}
    total = lambda c: sum(r[c] for r in rows)
    assert total("facts") == spark.read.parquet(facts).count()
    assert total("critical") == spark.read.parquet(alerts).count()
    assert total("rejected") == 1 == spark.read.parquet(facts + "_quarantine").count()
    assert total("row_count") == total("facts") + 1


def test_listener_records_queries_without_a_batch_function(spark, tmp):
    src, store, ledger = (os.path.join(tmp, x) for x in ("in", "store", "ledger"))
    write_files(src, in_order_batches())
    listener = LedgerListener(spark, ledger)
    spark.streams.addListener(listener)
    try:
        q = start_store_sink(stream(spark, src), store, os.path.join(tmp, "ck"), {"availableNow": True}, "store")
        run(q)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(60):
            rows = Ledger(spark, ledger).read().filter(F.col("query_id") == str(q.id)).collect() \
                if Published(spark, ledger).versions() else []
            if len(rows) == 3:
                break
            threading.Event().wait(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert sorted((r.batch_id, r.row_count, r.query_name) for r in rows) == [(k, 20, "store") for k in range(3)]


def test_the_stream_job_with_served_tables(spark, tmp):
    src, store, windows, status, late, ledger = (os.path.join(tmp, x) for x in ("in", "s", "w", "st", "late", "led"))
    write_files(src, late_batches())
    jobs.await_all(spark, jobs.run_stream(
        spark, src, store, None, windows, available_now=True, max_files=1, update_windows=True, status_path=status,
        checkpoint_base=os.path.join(tmp, "ck"), served=True, late_path=late, ledger=ledger))
    valid = valid_only(enrich_stream(spark.read.text(src)))
    assert sorted(map(tuple, served_status(spark, status).select("sensor_id", "event_id").collect())) == sorted(
        map(tuple, latest_status(valid).select("sensor_id", "event_id").collect()))
    assert late_rows(spark, late).count() == 3
    assert window_table(spark, windows).agg(F.sum("record_count")).first()[0] <= valid.count()
    assert Ledger(spark, ledger).read().agg(F.sum("row_count")).first()[0] == valid.count()


def test_another_query_s_failure_does_not_end_the_job(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, in_order_batches()[:1])

    def fail(df, batch_id):
        raise RuntimeError("not ours")

    other = start_windows(stream(spark, src), os.path.join(tmp, "ck1"), output_mode="update", on_batch=fail,
                          trigger={"availableNow": True})
    try:
        other.awaitTermination(60)
    except Exception as error:
        assert "not ours" in str(error)
    mine = start_fact_sinks(stream(spark, src), os.path.join(tmp, "f"), os.path.join(tmp, "a"), os.path.join(tmp, "ck2"),
                            trigger={"availableNow": True})
    jobs.await_all(spark, [mine])
    assert mine.exception() is None and spark.read.parquet(os.path.join(tmp, "f")).count() == 20


