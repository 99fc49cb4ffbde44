"""Operators on hand-built edge fixtures (ties, gaps, empty days, NULL flags)."""

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.operators.joins import resample_hourly
from roadpulse.operators.quality import duplicate_keys, reconcile_alerts
from roadpulse.plans import daily, reports, serving
from roadpulse.sources.telemetry import alerts_of

D = "2024-01-15"


def test_peak_tie_goes_to_earlier_hour(spark, telemetry):
    f = telemetry([
        (1, "A", f"{D} 09:10:00", 100, 40),
        (2, "A", f"{D} 07:05:00", 60, 40),
        (3, "A", f"{D} 07:50:00", 40, 40),
        (4, "A", f"{D} 12:00:00", 20, 40),
    ])
    r = daily.daily_report(f).first()
    assert r.peak_hour == 7 and r.peak_hour_vehicle_count == 100 and r.total_daily_vehicles == 220
    a = reports.peak_hour_analysis(f, alerts_of(f)).first()
    assert a.peak_hour == "7:00" and a.peak_vehicles == 100


def test_latest_tie_breaks_on_event_id(spark, telemetry):
    f = telemetry([
        (1, "A", f"{D} 10:00:00", 10, 40),
        (7, "A", f"{D} 11:00:00", 20, 5),
        (9, "A", f"{D} 11:00:00", 30, 50),
        (2, "B", f"{D} 08:00:00", 40, 40),
    ])
    got = {r.sensor_id: (r.event_id, r.vehicle_count) for r in serving.latest_status(f).collect()}
    assert got == {"A": (9, 30), "B": (2, 40)}
    top = serving.recent(f, 2).collect()
    assert [r.event_id for r in top] == [9, 7]


def test_hour_grid_fills_missing_hours_with_zero(spark, telemetry):
    f = telemetry([
        (1, "A", f"{D} 01:00:00", 10, 40),
        (2, "A", f"{D} 05:00:00", 30, 20),
        (3, "B", f"{D} 23:59:59", 11, 8),
        (4, "C", "2024-01-16 00:00:00", 50, 50),  # another day: not in the grid
    ])
    g = serving.hour_grid(f).collect()
    assert len(g) == 48
    cells = {(r.sensor_id, r.hour_of_day): (r.avg_vehicles, r.avg_speed, r.critical_count) for r in g}
    assert cells[("A", 1)] == (10, 40, 0) and cells[("A", 2)] == (0, 0, 0)
    assert cells[("B", 23)] == (11, 8, 1)


def test_resample_contiguous_buckets(spark, telemetry):
    f = telemetry([
        (1, "A", "2024-01-15 22:10:00", 10, 40),
        (2, "A", "2024-01-16 01:20:00", 30, 40),
        (3, "A", "2024-01-16 01:50:00", 5, 40),
        (4, "B", "2024-01-15 03:00:00", 7, 40),
    ])
    got = [(r.sensor_id, r.bucket, r.vehicle_count)
           for r in resample_hourly(f, "sensor_id", "event_time", "vehicle_count").orderBy("sensor_id", "bucket").collect()]
    h = lambda s: dt.datetime.fromisoformat(s)
    assert got == [("A", h("2024-01-15 22:00:00"), 10), ("A", h("2024-01-15 23:00:00"), 0),
                   ("A", h("2024-01-16 00:00:00"), 0), ("A", h("2024-01-16 01:00:00"), 35),
                   ("B", h("2024-01-15 03:00:00"), 7)]


def test_no_alerts_gives_zero(spark, telemetry):
    f = telemetry([(1, "A", f"{D} 01:00:00", 10, 40), (2, "B", f"{D} 01:00:00", 10, 5)])
    st = {r.sensor_id: r.critical_alerts for r in reports.sensor_statistics(f, alerts_of(f)).collect()}
    assert st == {"A": 0, "B": 1}
    none = f.filter(F.lit(False))
    assert reports.alert_counts(none).count() == 0
    st2 = {r.sensor_id: r.critical_alerts for r in reports.sensor_statistics(f, none).collect()}
    assert st2 == {"A": 0, "B": 0}


def test_empty_day(spark, telemetry):
    f = telemetry([(1, "A", "2024-01-14 01:00:00", 10, 40)])
    s = serving.day_summary(f).collect()
    assert [tuple(r) for r in s] == [(0, 0, 0, "N/A")]
    r = daily.daily_report(f, as_of=dt.date(2024, 1, 15))
    assert r.count() == 0
    assert r.columns[:3] == ["report_date", "sensor_id", "peak_hour"]


def test_day_summary_busiest_tie_goes_to_smaller_id(spark, telemetry):
    f = telemetry([(1, "B", f"{D} 01:00:00", 10, 5), (2, "A", f"{D} 02:00:00", 10, 40),
                   (3, "A", f"{D} 03:00:00", 1, 40), (4, "B", f"{D} 04:00:00", 1, 40)])
    assert tuple(serving.day_summary(f).first()) == (4, 1, 31, "A")


def test_null_flag_rows(spark, telemetry):
    f = telemetry([(1, "A", f"{D} 01:00:00", 10, 5), (2, "A", f"{D} 01:30:00", 10, 5)])
    # The ingestion bridge stored no flag: traffic_status NULL on one row.
    f = f.withColumn("traffic_status", F.when(F.col("event_id") == 2, F.lit(None).cast("boolean"))
                     .otherwise(F.col("traffic_status")))
    h = serving.hourly_traffic_summary(f).first()
    assert h.critical_count == 1 and h.record_count == 2
    alerts = f.filter(F.col("avg_speed") < 10)  # the alerts table got both rows
    rec = reconcile_alerts(f, alerts).first()
    assert (rec.flagged_facts, rec.unflagged_facts, rec.alert_rows, rec.difference) == (1, 1, 2, 1)


def test_report_keys_unique(spark, telemetry):
    f = telemetry([(i, s, f"2024-01-{d} {h:02d}:00:00", 10 + i, 30)
                   for i, (s, d, h) in enumerate([("A", 14, 1), ("A", 14, 2), ("A", 15, 1), ("B", 15, 3)])])
    assert duplicate_keys(daily.daily_report(f), ["report_date", "sensor_id"]).count() == 0
    assert daily.daily_report(f).count() == 3


def test_window_measures_batch(spark, telemetry):
    from roadpulse.operators.aggregates import window_measures
    f = telemetry([(1, "A", f"{D} 10:01:00", 100, 10), (2, "A", f"{D} 10:04:59", 50, 5),
                   (3, "A", f"{D} 10:05:00", 20, 40)])
    w = window_measures(f, "5 minutes").orderBy("window_start").collect()
    assert len(w) == 2
    assert (w[0].record_count, w[0].max_vehicle_count, w[0].min_speed, w[0].avg_speed) == (2, 100, 5, 7.5)
    assert w[0].avg_congestion_index == (1000 + 1000) / 200


def test_extent_exact_and_approx(spark, telemetry):
    f = telemetry([(i, f"S{i % 7}", f"2024-01-{10 + i % 5} 0{i % 9}:00:00", 10, 30) for i in range(70)])
    exact = reports.extent(f).first()
    approx = reports.extent(f, approx_rsd=0.01).first()
    assert (exact.sensors, exact.dates_with_data, exact.total_records) == (7, 5, 70)
    assert (approx.sensors, approx.dates_with_data) == (7, 5)


def test_latest_order_ignores_session_clock(spark, telemetry):
    # Naive times inside a daylight-saving gap keep their wall-clock order
    # whatever the session time zone is.
    f = telemetry([(1, "A", "2024-03-10 02:30:00", 10, 40), (2, "A", "2024-03-10 03:15:00", 20, 40)])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = serving.latest_status(f).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.event_id == 2


def test_operators_take_their_columns_as_parameters(spark, telemetry):
    from roadpulse.sources.telemetry import Cols
    f = telemetry([(1, "A", f"{D} 01:10:00", 30, 5), (2, "A", f"{D} 01:50:00", 40, 40),
                   (3, "B", f"{D} 07:00:00", 50, 20), (4, "A", f"{D} 09:00:00", 10, 9)])
    names = {"sensor_id": "junction", "event_time": "ts", "vehicle_count": "cars", "avg_speed": "kmh",
             "congestion_index": "ci", "congestion_x100": "ci100", "traffic_status": "slow",
             "hour_of_day": "hr", "event_date": "day", "event_id": "rid"}
    g = f.select(*[F.col(a).alias(b) for a, b in names.items()])
    c = Cols(key="junction", time="ts", count="cars", speed="kmh", congestion="ci", x100="ci100",
             flag="slow", hour="hr", date="day", id="rid")
    a = daily.daily_report(f).drop("sensor_id").collect()
    b = daily.daily_report(g, cols=c).drop("junction").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    la = {tuple(r) for r in serving.latest_status(f).collect()}
    lb = {tuple(r) for r in serving.latest_status(g, cols=c).collect()}
    assert la == lb


def test_plans_with_renamed_columns_match(spark, telemetry):
    from roadpulse.operators import quality as Q
    from roadpulse.operators.aggregates import window_measures
    from roadpulse.sources.telemetry import Cols
    from tests.oracle_check import _norm
    f = telemetry([(i, "AB"[i % 2], f"2024-01-{14 + i % 3} {i % 24:02d}:{i % 60:02d}:00", 10 + i, 3 + (i * 7) % 50)
                   for i in range(80)])
    names = {"sensor_id": "junction", "event_time": "ts", "vehicle_count": "cars", "avg_speed": "kmh",
             "congestion_index": "ci", "congestion_x100": "ci100", "traffic_status": "slow",
             "hour_of_day": "hr", "event_date": "day", "event_id": "rid"}
    g = f.select(*[F.col(a).alias(b) for a, b in names.items()])
    c = Cols(key="junction", time="ts", count="cars", speed="kmh", congestion="ci", x100="ci100",
             flag="slow", hour="hr", date="day", id="rid")
    fa, ga = alerts_of(f), alerts_of(g, c)
    cases = [
        lambda d, a, k: daily.hourly_stats(d, cols=k), lambda d, a, k: daily.intervention_report(d, cols=k),
        lambda d, a, k: serving.hourly_traffic_summary(d, k), lambda d, a, k: serving.hour_grid(d, cols=k),
        lambda d, a, k: serving.day_summary(d, cols=k), lambda d, a, k: serving.recent(d, 5, k),
        lambda d, a, k: serving.recent_daily_reports(d, cols=k),
        lambda d, a, k: reports.peak_hour_analysis(d, a, k), lambda d, a, k: reports.sensor_statistics(d, a, k),
        lambda d, a, k: reports.summary_metrics(d, a, k), lambda d, a, k: reports.summary_lines(d, a, k),
        lambda d, a, k: reports.extent(d, k), lambda d, a, k: reports.hour_band_profile(d, k),
        lambda d, a, k: reports.trailing_days(d, cols=k), lambda d, a, k: reports.history_scan(d, k),
        lambda d, a, k: window_measures(d, "5 minutes", k), lambda d, a, k: Q.profile(d, k),
        lambda d, a, k: Q.reconcile_alerts(d, a, k), lambda d, a, k: Q.ingestion_checks(d, a, k),
    ]
    for i, case in enumerate(cases):
        a = sorted(tuple(_norm(v) for v in r) for r in case(f, fa, c.__class__()).collect())
        b = sorted(tuple(_norm(v) for v in r) for r in case(g, ga, c).collect())
        assert a == b and a, f"case {i}"


def test_top_per_group_and_argmax_agree(spark):
    from roadpulse.operators.ranking import argmax_per_group, top_per_group
    rows = [("A", h, v) for h, v in [(3, 10), (5, 30), (7, 30), (9, 5)]] + [("B", 1, 7), ("B", 2, 9)]
    df = spark.createDataFrame(rows, "k string, h int, v long")
    top2 = top_per_group(df, ["k"], [F.col("v").desc(), F.col("h")], n=2, rank_col="rank")
    assert sorted(tuple(r) for r in top2.collect()) == [("A", 5, 30, 1), ("A", 7, 30, 2), ("B", 1, 7, 2), ("B", 2, 9, 1)]
    best = argmax_per_group(df, ["k"], "v", "h", 24, ["h", "v"], {"total": "v"})
    assert sorted(tuple(r) for r in best.collect()) == [("A", 5, 30, 75), ("B", 2, 9, 16)]


def test_resample_ignores_session_clock(spark, telemetry):
    f = telemetry([(1, "A", "2024-03-10 01:10:00", 10, 40), (2, "A", "2024-03-10 02:30:00", 20, 40),
                   (3, "A", "2024-03-10 03:15:00", 30, 40)])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [(r.bucket.hour, r.vehicle_count) for r in
               resample_hourly(f, "sensor_id", "event_time", "vehicle_count").orderBy("bucket").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [(1, 10), (2, 20), (3, 30)]
