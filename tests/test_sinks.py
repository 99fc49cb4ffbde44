"""Sinks: report upsert by partition overwrite, partitioned facts, CSV exports."""

import os

from roadpulse.operators.quality import duplicate_keys
from roadpulse.plans import daily, reports
from roadpulse.sinks import export_csv, write_alerts, write_daily_report, write_facts
from roadpulse.sources.telemetry import alerts_of


def rows(telemetry, day, bump=0):
    return telemetry([(i, s, f"{day} {h:02d}:10:00", 10 + i + bump, sp)
                      for i, (s, h, sp) in enumerate([("A", 1, 40), ("A", 2, 5), ("B", 3, 30)])])


def test_rerun_day_replaces_only_that_day(spark, telemetry, tmp):
    path = os.path.join(tmp, "reports")
    write_daily_report(daily.daily_report(rows(telemetry, "2024-01-14")), path)
    write_daily_report(daily.daily_report(rows(telemetry, "2024-01-15")), path)
    # Re-run 2024-01-15 with different numbers.
    write_daily_report(daily.daily_report(rows(telemetry, "2024-01-15", bump=100)), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    assert duplicate_keys(stored, ["report_date", "sensor_id"]).count() == 0
    by_key = {(str(r.report_date), r.sensor_id): r.total_daily_vehicles for r in stored.collect()}
    assert by_key[("2024-01-14", "A")] == 10 + 11
    assert by_key[("2024-01-15", "A")] == 110 + 111


def test_facts_and_alerts_partitioned(spark, telemetry, tmp):
    f = rows(telemetry, "2024-01-15")
    write_facts(f, os.path.join(tmp, "facts"))
    write_alerts(f, os.path.join(tmp, "alerts"))
    assert os.path.isdir(os.path.join(tmp, "facts", "event_date=2024-01-15"))
    assert spark.read.parquet(os.path.join(tmp, "facts")).count() == 3
    assert spark.read.parquet(os.path.join(tmp, "alerts")).count() == 1


def test_csv_exports(spark, telemetry, tmp):
    f = rows(telemetry, "2024-01-15")
    export_csv(daily.intervention_report(f), os.path.join(tmp, "recs"))
    export_csv(reports.peak_hour_analysis(f, alerts_of(f)), os.path.join(tmp, "analysis"))
    export_csv(reports.trailing_days(f), os.path.join(tmp, "raw"), partition_by="hour_of_day",
               order_by=["event_time"])
    back = spark.read.option("header", True).csv(os.path.join(tmp, "analysis"))
    assert back.columns[:3] == ["sensor_id", "junction", "peak_hour"] and back.count() == 2
    assert spark.read.option("header", True).csv(os.path.join(tmp, "recs")).count() == 2
    assert spark.read.option("header", True).csv(os.path.join(tmp, "raw")).count() == 3


def test_analysis_csv_matches_published_layout(spark, telemetry, tmp):
    # Header and row format of the published peak-hour table.
    f = telemetry([(1, "J1_North_Gate", "2024-01-15 03:10:00", 100, 40),
                   (2, "J1_North_Gate", "2024-01-15 03:20:00", 50, 20),
                   (3, "J1_North_Gate", "2024-01-15 05:20:00", 20, 8)])
    path = os.path.join(tmp, "analysis")
    export_csv(reports.analysis_table(reports.peak_hour_analysis(f, alerts_of(f))), path)
    part = [p for p in os.listdir(path) if p.endswith(".csv")]
    lines = [ln.rstrip("\n") for p in part for ln in open(os.path.join(path, p))]
    assert lines[0] == ("Junction,Peak Hour,Peak Vehicles,Total Vehicles,Avg Speed (km/h),"
                        "Avg Congestion Index,Critical Alerts,Intervention Required,Recommendation")
    # speed (40+20+8)/3 = 22.67 -> 22.7; congestion (250+250+250)/300 = 2.50; 1 alert
    assert lines[1] == "J1 North Gate,3:00,150,170,22.7,2.50,1,NO,LOW: Continue monitoring"
