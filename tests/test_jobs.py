"""End to end: stream job -> stored facts/alerts -> nightly report -> reports."""

import datetime as dt
import os

from pyspark.sql import functions as F

from roadpulse import jobs
from roadpulse.plans import daily
from roadpulse.sources.telemetry import read_facts
from tests.test_streaming import in_order_batches, write_files


def test_stream_nightly_reports(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, in_order_batches())
    facts, alerts, windows = (os.path.join(tmp, x) for x in ("facts", "alerts", "windows"))
    for q in jobs.run_stream(spark, src, facts, alerts, windows, available_now=True, max_files=1,
                            checkpoint_base=os.path.join(tmp, "ck")):
        q.awaitTermination(120)
        assert q.exception() is None
    stored = read_facts(spark, facts)
    assert stored.count() == 60
    assert spark.read.parquet(windows).count() > 0

    reports_path, csv = os.path.join(tmp, "reports"), os.path.join(tmp, "recs")
    day = dt.date(2024, 1, 15)
    rollup = os.path.join(tmp, "rollup")
    jobs.run_nightly(spark, facts, reports_path, csv, day, rollup)
    jobs.run_nightly(spark, facts, reports_path, csv, day, rollup)  # re-run: idempotent
    rep = spark.read.parquet(reports_path)
    assert rep.count() == 3
    expected = daily.daily_report(stored)
    cols = ["sensor_id", "peak_hour", "peak_hour_vehicle_count", "total_daily_vehicles", "requires_intervention"]
    assert sorted(map(tuple, rep.select(*cols).collect())) == sorted(map(tuple, expected.select(*cols).collect()))
    assert spark.read.option("header", True).csv(csv).count() == 3

    assert spark.read.parquet(rollup).agg(F.sum("record_count")).first()[0] == 60
    # Reports from the nightly rollup equal reports materialising their own.
    out, out2 = os.path.join(tmp, "out"), os.path.join(tmp, "out2")
    jobs.run_reports(spark, facts, alerts, out, dt.datetime(2024, 1, 16), 7)
    jobs.run_reports(spark, facts, alerts, out2, dt.datetime(2024, 1, 16), 7, rollup_path=rollup)
    for name in ("summary_metrics",):
        a = spark.read.parquet(os.path.join(out, name)).collect()
        b = spark.read.parquet(os.path.join(out2, name)).collect()
        assert sorted(map(str, a)) == sorted(map(str, b))
    pa = spark.read.option("header", True).csv(os.path.join(out, "peak_hour_analysis"))
    assert pa.count() == 3
    sm = spark.read.parquet(os.path.join(out, "summary_metrics"))
    assert sm.filter((F.col("metric") == "total_records")).first().value == 60.0
    assert spark.read.option("header", True).csv(os.path.join(out, "trailing_export")).count() == 60
    text_dir = os.path.join(out, "summary_text")
    text = [ln.rstrip("\n") for p in sorted(os.listdir(text_dir)) if p.startswith("part-")
            for ln in open(os.path.join(text_dir, p))]
    assert text[0].startswith("Report Period: 2024-01-15 10:00:07 to ")
    assert text[1] == "Total Records: 60"
    assert text[3] == "J1:" and text[4].startswith("  Total Vehicles: ") and len(text) == 3 + 3 * 5

    dash = os.path.join(tmp, "dash")
    jobs.run_dashboard(spark, facts, alerts, reports_path, dash, day)
    assert spark.read.parquet(os.path.join(dash, "current_status")).count() == 3
    assert spark.read.parquet(os.path.join(dash, "hourly_stats")).count() == 3 * 24
    assert spark.read.parquet(os.path.join(dash, "daily_reports")).count() == 3
    summary = spark.read.parquet(os.path.join(dash, "stats_summary")).first()
    assert summary.total_records == 60
    checks = {r.check_name: r.passed for r in spark.read.parquet(os.path.join(dash, "checks")).collect()}
    assert all(checks.values()) and len(checks) == 5


def test_backfill_ingest_is_rerunnable(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, in_order_batches())
    facts, alerts, quarantine = (os.path.join(tmp, x) for x in ("facts", "alerts", "quarantine"))
    for _ in range(2):
        jobs.run_ingest(spark, src, facts, alerts, quarantine)
    f = read_facts(spark, facts)
    assert f.count() == 60 and f.select("batch_id").distinct().first()[0] == jobs.BACKFILL_BATCH
    assert spark.read.parquet(alerts).count() == f.filter("traffic_status").count()


def test_store_layout_end_to_end(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, in_order_batches())
    store, windows = os.path.join(tmp, "store"), os.path.join(tmp, "windows")
    for q in jobs.run_stream(spark, src, store, None, windows, available_now=True, max_files=1,
                             checkpoint_base=os.path.join(tmp, "ck")):
        q.awaitTermination(120)
        assert q.exception() is None
    reports_path, csv = os.path.join(tmp, "reports"), os.path.join(tmp, "recs")
    jobs.run_nightly(spark, store, reports_path, csv, dt.date(2024, 1, 15))
    assert spark.read.parquet(reports_path).count() == 3
    out = os.path.join(tmp, "out")
    jobs.run_reports(spark, store, store, out, dt.datetime(2024, 1, 16), 7)
    sm = spark.read.parquet(os.path.join(out, "summary_metrics"))
    assert sm.filter(F.col("metric") == "total_records").first().value == 60.0
    alerts = read_facts(spark, store).filter("traffic_status").count()
    assert sm.filter(F.col("metric") == "total_alerts").first().value == float(alerts)


def test_live_store_plus_backfill_store(spark, tmp):
    from roadpulse.sources import read_alerts
    live_src, old_src = os.path.join(tmp, "live"), os.path.join(tmp, "old")
    batches = in_order_batches()
    write_files(live_src, batches[:2])
    write_files(old_src, batches[2:])
    live, back = os.path.join(tmp, "store_live"), os.path.join(tmp, "store_backfill")
    for q in jobs.run_stream(spark, live_src, live, None, os.path.join(tmp, "w"), available_now=True,
                             checkpoint_base=os.path.join(tmp, "ck")):
        q.awaitTermination(120)
    jobs.run_ingest(spark, old_src, back, None, checkpoint=os.path.join(tmp, "ck_backfill"))
    both = read_facts(spark, [live, back])
    assert both.count() == 60 and read_facts(spark, f"{live},{back}").count() == 60
    assert read_alerts(spark, [live, back]).count() == both.filter("traffic_status").count()


def test_cli_entry_points(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, in_order_batches())
    store = os.path.join(tmp, "store")
    jobs.main(["stream", "--source", src, "--facts", store, "--windows", os.path.join(tmp, "w"),
               "--available-now", "--checkpoints", os.path.join(tmp, "ck")])
    jobs.main(["nightly", "--facts", store, "--reports", os.path.join(tmp, "rep"), "--csv", os.path.join(tmp, "csv"),
               "--as-of", "2024-01-15", "--rollup", os.path.join(tmp, "rollup")])
    jobs.main(["reports", "--facts", store, "--alerts", store, "--out", os.path.join(tmp, "out"),
               "--as-of", "2024-01-16", "--rollup", os.path.join(tmp, "rollup")])
    jobs.main(["dashboard", "--facts", store, "--alerts", store, "--reports", os.path.join(tmp, "rep"),
               "--out", os.path.join(tmp, "dash"), "--day", "2024-01-15"])
    assert spark.read.parquet(os.path.join(tmp, "rep")).count() == 3
    assert spark.read.parquet(os.path.join(tmp, "dash", "stats_summary")).first().total_records == 60


def stored_days(spark, telemetry, tmp, days=4):
    """Facts and alerts tables of several days."""
    from roadpulse.sinks import write_alerts, write_facts
    facts, alerts = os.path.join(tmp, "facts"), os.path.join(tmp, "alerts")
    rows = telemetry([(10 * d + i, f"J{i % 2 + 1}", f"2024-01-{11 + d} {5 + i:02d}:00:00", 10 + d + i, 5 + 10 * (i % 3))
                      for d in range(days) for i in range(6)])
    write_facts(rows, facts)
    write_alerts(rows, alerts)
    return facts, alerts


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if "PartitionFilters" in ln]


def test_stored_scans_prune_partitions(spark, telemetry, tmp):
    from roadpulse.plans import reports, serving
    from roadpulse.sources import newest, read_alerts
    facts_path, alerts_path = stored_days(spark, telemetry, tmp)
    f, a = read_facts(spark, facts_path), read_alerts(spark, alerts_path)
    day, as_of = dt.date(2024, 1, 12), dt.datetime(2024, 1, 14)
    for df, rows in ((reports.day_scan(f, day), 6), (reports.trailing_days(f, as_of, 2), 12), (serving.hour_grid(f, day), 48),
                     (serving.day_summary(f, day), 1), (reports.trailing_alerts(a, as_of, 2), 4)):
        assert df.count() == rows
        found = partition_filters(df)
        assert found and all("event_date" in ln.split("PartitionFilters")[1].split("]")[0] for ln in found)
    cut = newest(spark, alerts_path, a, 3)
    assert sorted(str(r[0]) for r in cut.select("event_date").distinct().collect()) == ["2024-01-13", "2024-01-14"]
    assert serving.recent(cut, 3).collect() == serving.recent(a, 3).collect()
    assert newest(spark, alerts_path, a, 100).count() == a.count()


def test_nightly_outputs_last(spark, telemetry, tmp):
    facts_path, _ = stored_days(spark, telemetry, tmp)
    reports_path, csv = os.path.join(tmp, "reports"), os.path.join(tmp, "csv")
    for d in (11, 12, 11):
        jobs.run_nightly(spark, facts_path, reports_path, csv, dt.date(2024, 1, d))
    assert spark.read.parquet(reports_path).count() == 4
    back = spark.read.option("header", True).csv(csv)
    assert sorted({str(r.report_date) for r in back.collect()}) == ["2024-01-11", "2024-01-12"] and back.count() == 4
    # A day that has lost its rows loses its report, and no other day's.
    empty = os.path.join(tmp, "empty")
    read_facts(spark, facts_path).limit(0).drop("congestion_x100").write.parquet(empty)
    jobs.run_nightly(spark, empty, reports_path, csv, dt.date(2024, 1, 11))
    assert {str(r.report_date) for r in spark.read.parquet(reports_path).collect()} == {"2024-01-12"}
    from roadpulse.session import shared_dir
    tables = shared_dir(spark, "tables").removeprefix("file:")
    assert not [x for x in os.listdir(tables) if x.startswith("nightly")]


def test_sorted_partitioned_export(spark, telemetry, tmp):
    from roadpulse.sinks import export_csv
    facts_path, _ = stored_days(spark, telemetry, tmp)
    out = os.path.join(tmp, "csv")
    export_csv(read_facts(spark, facts_path).repartition(3), out, partition_by="event_date", order_by=["event_time"])
    files = [os.path.join(d, x) for d, _, names in os.walk(out) for x in names if x.endswith(".csv")]
    for path in files:
        lines = open(path).read().splitlines()
        at = lines[0].split(",").index("event_time")
        times = [ln.split(",")[at] for ln in lines[1:]]
        assert times == sorted(times)
    assert len(files) >= 4


def test_stale_rollup_is_refused(spark, telemetry, tmp):
    import pytest
    facts_path, alerts_path = stored_days(spark, telemetry, tmp)
    rollup = os.path.join(tmp, "rollup")
    jobs.run_nightly(spark, facts_path, os.path.join(tmp, "r"), os.path.join(tmp, "c"), dt.date(2024, 1, 11), rollup)
    with pytest.raises(ValueError, match="rollup"):
        jobs.run_reports(spark, facts_path, alerts_path, os.path.join(tmp, "out"), dt.datetime(2024, 1, 15), 2,
                         rollup_path=rollup)
    jobs.run_reports(spark, facts_path, alerts_path, os.path.join(tmp, "out"), dt.datetime(2024, 1, 15), 2)
    trailing = spark.read.parquet(os.path.join(tmp, "out", "trailing_statistics")).collect()
    assert sum(r.total_vehicles for r in trailing) == sum(10 + d + i for d in (2, 3) for i in range(6))
    assert spark.read.parquet(os.path.join(tmp, "out", "trailing_alerts")).count() == 4


def test_analytical_summary_layout(spark, telemetry):
    from roadpulse.plans import reports
    from roadpulse.sources import alerts_of
    f = telemetry([(1, "J1_North_Gate", "2024-01-15 03:10:00", 100, 40),
                   (2, "J1_North_Gate", "2024-01-15 03:20:00", 50, 20),
                   (3, "J1_North_Gate", "2024-01-16 05:20:00", 20, 8)])
    lines = [r.line for r in reports.analytical_lines(f, alerts_of(f))
             .orderBy(F.col("first_seen").asc_nulls_first(), "sensor_id", "line_no").collect()]
    assert lines == [
        "ANALYTICAL REPORT SUMMARY", "Data Period: 2024-01-15 03:10:00 to 2024-01-16 05:20:00", "OVERALL STATISTICS",
        "Total Traffic Records: 3", "Total Critical Alerts (Speed < 10 km/h): 1", "Junctions Monitored: 1",
        "Date Range: 2 day(s)", "JUNCTION-WISE ANALYSIS", "J1 North Gate", "   Peak Hour: 3:00 (150 vehicles)",
        "   Average Speed: 22.7 km/h", "   Congestion Index: 2.50", "   Critical Alerts: 1", "   Intervention: NO",
        "   LOW: Continue monitoring"]


def test_pivots_keep_every_sensor(spark, telemetry):
    from roadpulse.operators import aggregates as A
    from roadpulse.plans import reports
    f = telemetry([(i, f"J{i % 4}_Road", f"2024-01-15 {i % 5:02d}:10:00", 10 + i, 20) for i in range(40)])
    sums = A.measure_sums(f, ["sensor_id", "event_date", "hour_of_day"])
    for source in (f, sums):
        wide = reports.volume_pivot(source, ["J1_Road", "J9"]).collect()
        assert sum((r["J1_Road"] or 0) + (r["J9"] or 0) + (r.other or 0) for r in wide) == sum(10 + i for i in range(40))
        assert sum(r["J1_Road"] or 0 for r in wide) == sum(10 + i for i in range(40) if i % 4 == 1)
    cols = ["sensor_id", *[f"h{h}" for h in range(24)]]
    assert sorted(map(str, reports.heatmap_pivot(f).select(*cols).collect())) == sorted(
        map(str, reports.heatmap_pivot(sums).select(*cols).collect()))


def test_long_gaps_and_rows_without_id(spark, telemetry):
    from roadpulse.operators.joins import resample_hourly
    from roadpulse.plans import serving
    f = telemetry([(1, "A", "2024-01-01 00:30:00", 5, 20), (2, "A", "2026-03-01 07:30:00", 7, 20),
                   (None, "B", "2024-01-01 00:30:00", 9, 20)])
    got = resample_hourly(f, "sensor_id", "event_time", "vehicle_count").filter("sensor_id = 'A'")
    hours = (dt.datetime(2026, 3, 1, 7) - dt.datetime(2024, 1, 1)) // dt.timedelta(hours=1) + 1
    assert got.count() == got.select("bucket").distinct().count() == hours
    assert got.agg(F.sum("vehicle_count")).first()[0] == 12
    assert {r.sensor_id: r.vehicle_count for r in serving.latest_status(f).collect()} == {"A": 7, "B": 9}
