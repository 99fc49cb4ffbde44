"""Property tests: exact rounding and gap filling against brute-force Python."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.functions import exprs as X
from roadpulse.operators.joins import fill_gaps, resample_hourly
from roadpulse.plans import daily

pairs = st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 5000)), min_size=1, max_size=200)


def half_up(num, den, digits):
    return (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


@settings(max_examples=10, deadline=None)
@given(pairs)
def test_congestion_x100_is_half_up(spark, data):
    df = spark.createDataFrame(data, "c int, s int")
    got = [r[0] for r in df.select(X.congestion_x100("c", "s")).collect()]
    assert got == [int(half_up(c, s, 2) * 100) for c, s in data]


@settings(max_examples=10, deadline=None)
@given(pairs, st.sampled_from([0, 1, 2, 3]))
def test_fixed_text_is_half_up(spark, data, digits):
    df = spark.createDataFrame(data, "c long, s long")
    got = [r[0] for r in df.select(X.fixed_text("c", "s", digits)).collect()]
    assert got == [str(half_up(c, s, digits)) for c, s in data]


cells = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 23), st.integers(1, 100)),
                 min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=10, deadline=None)
@given(cells)
def test_fill_gaps_equals_dense_grid(spark, data):
    df = spark.createDataFrame(data, "k string, h int, v int")
    got = sorted(tuple(r) for r in fill_gaps(df, ["k"], "h", {"v": 0}, 1, 0, 23).collect())
    present = {(k, h): v for k, h, v in data}
    expected = sorted((k, h, present.get((k, h), 0)) for k in {k for k, _, _ in data} for h in range(24))
    assert got == expected


events = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 96 * 60 - 1), st.integers(10, 60)),
                  min_size=1, max_size=60)
BASE = dt.datetime(2024, 1, 14)


@settings(max_examples=10, deadline=None)
@given(events)
def test_resample_equals_brute_force(spark, data):
    rows = [(k, BASE + dt.timedelta(minutes=m), v) for k, m, v in data]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    got = sorted(tuple(r) for r in resample_hourly(df, "k", "t", "v").collect())
    expected = []
    for k in {k for k, _, _ in rows}:
        sums = {}
        for kk, t, v in rows:
            if kk == k:
                b = t.replace(minute=0, second=0, microsecond=0)
                sums[b] = sums.get(b, 0) + v
        b = min(sums)
        while b <= max(sums):
            expected.append((k, b, sums.get(b, 0)))
            b += dt.timedelta(hours=1)
    assert got == sorted(expected)


readings = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 2 * 24 * 60 - 1),
                              st.integers(10, 30), st.integers(3, 60)), min_size=1, max_size=50)


@settings(max_examples=10, deadline=None)
@given(readings)
def test_daily_report_equals_brute_force(spark, data):
    from roadpulse.sources.telemetry import enrich
    from tests.conftest import TELEMETRY
    f = enrich(spark.createDataFrame(
        [(i, k, BASE + dt.timedelta(minutes=m), c, s) for i, (k, m, c, s) in enumerate(data)], TELEMETRY))
    got = {(str(r.report_date), r.sensor_id): (r.peak_hour, r.peak_hour_vehicle_count, r.total_daily_vehicles,
                                                r.total_critical_alerts, r.requires_intervention)
           for r in daily.daily_report(f).collect()}
    expected = {}
    groups = {}
    for k, m, c, s in data:
        t = BASE + dt.timedelta(minutes=m)
        groups.setdefault((str(t.date()), k), []).append((t.hour, c, s))
    for key, rs in groups.items():
        by_hour = {}
        for h, c, s in rs:
            by_hour.setdefault(h, []).append((c, s))
        peak = min(by_hour, key=lambda h: (-sum(c for c, _ in by_hour[h]), h))
        pr = by_hour[peak]
        cong = sum(int(half_up(c, s, 2) * 100) for c, s in pr) / (100 * len(pr))
        crit = sum(1 for _, s in pr if s < 10)
        spd = sum(s for _, s in pr) / len(pr)
        expected[key] = (peak, sum(c for c, _ in pr), sum(c for _, c, _ in rs), sum(1 for _, _, s in rs if s < 10),
                         cong > 5.0 or crit > 10 or spd < 15)
    assert got == expected


stamps = st.lists(st.tuples(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)),
                            st.integers(-2**63, 2**63 - 1)), min_size=2, max_size=60)


@settings(max_examples=10, deadline=None)
@given(stamps)
def test_time_id_key_orders_like_the_pair(spark, data):
    from roadpulse.operators.ranking import time_id_key
    df = spark.createDataFrame(data, "t timestamp_ntz, i long")
    got = [(r.t, r.i) for r in df.withColumn("k", time_id_key(df, "t", "i")).orderBy("k").collect()]
    assert got == sorted(data)


groups = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 23), st.integers(0, 5)),
                  min_size=1, max_size=50, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=15, deadline=None)
@given(groups)
def test_argmax_per_group_equals_brute_force(spark, data):
    from roadpulse.operators.ranking import argmax_per_group
    df = spark.createDataFrame(data, "k string, h int, v long")
    got = {r.k: (r.h, r.v, r.total) for r in argmax_per_group(df, ["k"], "v", "h", 24, ["h", "v"],
                                                                   {"total": "v"}).collect()}
    expected = {}
    for k in {k for k, _, _ in data}:
        rows = [(h, v) for kk, h, v in data if kk == k]
        h, v = min(rows, key=lambda r: (-r[1], r[0]))      # largest v, then earliest h
        expected[k] = (h, v, sum(v for _, v in rows))
    assert got == expected
