"""Plans built on exact sums give identical results from a materialised
(sensor, date, hour) rollup as from the raw facts (sf0.01)."""

import pytest

from roadpulse.operators import aggregates as A
from roadpulse.plans import daily, reports, serving
from roadpulse.sources.telemetry import DEFAULT as C
from roadpulse.sources.telemetry import alerts_of, facts
from tests.conftest import SF001
from tests.oracle_check import canon

PLANS = {
    "hourly_stats": lambda d, a: daily.hourly_stats(d),
    "daily_totals": lambda d, a: daily.daily_totals(d),
    "peak_hours": lambda d, a: daily.peak_hours(d),
    "intervention_report": lambda d, a: daily.intervention_report(d),
    "daily_report": lambda d, a: daily.daily_report(d),
    "daily_report_one_day": lambda d, a: daily.daily_report(d, as_of=serving.P.AS_OF_DATE),
    "hourly_traffic_summary": lambda d, a: serving.hourly_traffic_summary(d),
    "hourly_stats_day": lambda d, a: serving.hourly_stats_day(d),
    "day_summary": lambda d, a: serving.day_summary(d),
    "busiest_sensor": lambda d, a: serving.busiest_sensor(d),
    "hour_grid": lambda d, a: serving.hour_grid(d),
    "recent_daily_reports": lambda d, a: serving.recent_daily_reports(d),
    "peak_hour_analysis": lambda d, a: reports.peak_hour_analysis(d, a),
    "volume_by_hour": lambda d, a: reports.volume_by_hour(d),
    "sensor_statistics": lambda d, a: reports.sensor_statistics(d, a),
    "speed_band_by_sensor": lambda d, a: reports.speed_band_by_sensor(d),
    "hour_band_profile": lambda d, a: reports.hour_band_profile(d),
    "extent": lambda d, a: reports.extent(d),
    "summary_metrics": lambda d, a: reports.summary_metrics(d, a),
    "summary_lines": lambda d, a: reports.summary_lines(d, a),
    "hour_rollup": lambda d, a: reports.hour_rollup(d),
    "sensor_summary": lambda d, a: reports.sensor_summary(d),
}


@pytest.fixture(scope="module")
def inputs(spark):
    f = facts(spark, SF001)
    hourly = A.measure_sums(f, [C.key, C.date, C.hour])
    return f, hourly, alerts_of(f)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_rollup_equals_facts(spark, inputs, name):
    f, hourly, alerts = inputs
    assert A.is_sums(hourly) and not A.is_sums(f)
    a = PLANS[name](f, alerts)
    b = PLANS[name](hourly, alerts)
    assert sorted(a.columns) == sorted(b.columns)
    assert canon(a.columns, [tuple(r) for r in a.collect()]) == canon(b.columns, [tuple(r) for r in b.collect()])
