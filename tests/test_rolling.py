"""Reports kept up by the day, mergeable distinct counts, the start of a file
stream, and an entry without the optional packages."""

import datetime as dt
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from roadpulse import jobs
from roadpulse.operators import sketches as S
from roadpulse.plans import reports
from roadpulse.plans.rolling import add_day, rolling_statistics
from roadpulse.sinks import Published
from roadpulse.sources import read_facts
from roadpulse.sources.telemetry import alerts_of, facts, trailing
from roadpulse.streaming import enrich_stream, read_wire_files, start_cutoff, start_fact_sinks
from tests.conftest import SF001, SF0001
from tests.test_streaming import in_order_batches, run, write_files

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rolling_equals_trailing_for_successive_days(spark, tmp):
    f = facts(spark, SF0001).cache()
    first, path = dt.date(2024, 1, 3), f"{tmp}/parts"
    for k in range(14):
        day = first + dt.timedelta(days=k)
        add_day(f, alerts_of(f), path, day)
        as_of = day + dt.timedelta(days=1)
        if k >= 6:
            last = trailing(f, dt.datetime.combine(as_of, dt.time()), 7)
            got = rolling_statistics(spark, path, as_of)
            assert list(map(tuple, got.collect())) == list(map(tuple, reports.sensor_statistics(last, alerts_of(last)).collect()))
            assert all(f"_slice={as_of - dt.timedelta(days=8)}" not in x for x in got.inputFiles())
    f.unpersist()


def test_a_day_is_stored_anew(spark, telemetry, tmp):
    path, day = f"{tmp}/parts", dt.date(2024, 1, 15)
    rows = lambda n: telemetry([(i, "A", f"2024-01-15 {i:02d}:00:00", 10, 5) for i in range(n)])
    for n in (3, 5):
        add_day(rows(n), alerts_of(rows(n)), path, day)
        got, = rolling_statistics(spark, path, day + dt.timedelta(days=1)).collect()
        assert (got.total_vehicles, got.critical_alerts) == (10 * n, n)
    add_day(rows(0), alerts_of(rows(0)), path, day)
    assert rolling_statistics(spark, path, day + dt.timedelta(days=1)).collect() == []
    assert Published(spark, path).manifest()["slices"] == {}


def test_sketches_unite_within_two_percent(spark):
    f = facts(spark, SF001)
    by_day = S.distinct_sketches(f, ["event_date"], ["event_id", "sensor_id"]).cache()
    for low, high in ((1, 5), (3, 20), (1, 31)):
        span = F.dayofmonth("event_date").between(low, high)
        got = S.estimates(S.merge_sketches(by_day.filter(span))).first()
        want = f.filter(span).agg(F.count_distinct("event_id").alias("e"), F.count_distinct("sensor_id").alias("s")).first()
        assert abs(got.distinct_event_id - want.e) <= 0.02 * want.e and got.distinct_sensor_id == want.s
    by_day.unpersist()


def test_a_stream_that_starts_at_the_latest(spark, tmp):
    src, store, base = (os.path.join(tmp, x) for x in ("in", "store", "ck"))
    batches = in_order_batches()
    write_files(src, batches[:1])
    hour_ago = time.time() - 3600
    os.utime(os.path.join(src, "part-000.json"), (hour_ago, hour_ago))

    def once():
        jobs.await_all(spark, jobs.run_stream(spark, src, store, None, os.path.join(tmp, "w"), available_now=True,
                                              max_files=1, checkpoint_base=base, files_from_start=False))
    once()
    cutoff = start_cutoff(spark, base)
    write_files(src, [[], batches[1]])                       # rewrites part-000 as an empty new file
    os.utime(os.path.join(src, "part-000.json"), (hour_ago, hour_ago))
    once()
    assert read_facts(spark, store).count() == 20 and start_cutoff(spark, base) == cutoff


def test_a_file_that_vanished_after_it_was_listed(spark, tmp):
    src, ck = os.path.join(tmp, "in"), os.path.join(tmp, "ck")
    write_files(src, in_order_batches())

    def once(tolerate, fail):
        def sink(batch, batch_id):
            if fail:
                raise RuntimeError("before the batch was stored")
            seen.append(batch.count())
        q = (enrich_stream(read_wire_files(spark, src, tolerate_loss=tolerate)).writeStream.foreachBatch(sink)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        run(q)

    seen = []
    with pytest.raises(Exception, match="before the batch"):
        once(True, True)
    os.remove(os.path.join(src, "part-001.json"))            # listed in the batch that is replayed
    once(True, False)
    assert sum(seen) == 40


def test_facts_sink_and_latest_start_share_a_cutoff(spark, tmp):
    cutoff = start_cutoff(spark, f"{tmp}/ck", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    assert cutoff == start_cutoff(spark, f"{tmp}/ck") and cutoff.year == 2024
    src = os.path.join(tmp, "in")
    write_files(src, in_order_batches())
    run(start_fact_sinks(enrich_stream(read_wire_files(spark, src, since=cutoff)), f"{tmp}/f", f"{tmp}/a", f"{tmp}/ck2",
                         {"availableNow": True}))
    assert spark.read.parquet(f"{tmp}/f").count() == 60


@pytest.mark.parametrize("package", ["tiktoken", "ahocorasick", "tokenizers"])
def test_core_queries_without_an_optional_package(package):
    code = (f"import sys; sys.modules['{package}'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))")
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    core, oracles, has_llm = out.stdout.split()
    assert int(core) == int(oracles) >= 58 and has_llm == "False"
