"""Decision rules at their thresholds, reason texts, tiers, and golden rows."""

from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.operators import aggregates as A
from roadpulse.operators import rules as R

SCHEMA = "x100_sum long, x100_n long, critical_count long, speed_sum long, speed_n long"


def evaluate(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    req = R.requires_intervention(A.avg_congestion(), F.col("critical_count"), A.avg_speed())
    return [tuple(r) for r in df.select(
        req.alias("req"),
        R.reasons("x100_sum", "x100_n", "critical_count", "speed_sum", "speed_n").alias("why"),
        R.recommendation(req, F.col("critical_count"), A.avg_congestion()).alias("tier"),
    ).collect()]


def test_boundaries_do_not_fire(spark):
    # congestion exactly 5.00, alerts exactly 10, speed exactly 15.0
    (req, why, tier), = evaluate(spark, [(500, 1, 10, 150, 10)])
    assert req is False and why == P.NORMAL_FLOW and tier == P.TIER_LOW


def test_just_past_boundaries_fire_in_order(spark):
    (req, why, tier), = evaluate(spark, [(501, 1, 11, 149, 10)])
    assert req is True
    assert why == "High congestion index: 5.01 | Multiple alerts: 11 | Low average speed: 14.9 km/h"
    assert tier == P.TIER_MEDIUM


def test_each_rule_alone(spark):
    got = evaluate(spark, [(501, 1, 0, 300, 10), (100, 1, 11, 300, 10), (100, 1, 0, 149, 10)])
    assert [g[1] for g in got] == ["High congestion index: 5.01", "Multiple alerts: 11",
                                   "Low average speed: 14.9 km/h"]
    assert all(g[0] for g in got)


def test_tiers(spark):
    got = evaluate(spark, [
        (100, 1, 31, 300, 10),   # alerts > 30 -> URGENT
        (701, 1, 30, 300, 10),   # alerts 30, congestion 7.01 -> HIGH
        (700, 1, 30, 300, 10),   # congestion exactly 7.0 -> MEDIUM
        (100, 1, 5, 300, 10),    # nothing fires -> LOW
    ])
    assert [g[2] for g in got] == [P.TIER_URGENT, P.TIER_HIGH, P.TIER_MEDIUM, P.TIER_LOW]


def test_golden_rows_from_published_table(spark):
    # Whole-period aggregates of the published peak-hour table: speed 32.4,
    # congestion 4.13/3.86/2.56/1.90, alerts 60/90/65/44 -> all YES/URGENT.
    rows = [(413, 1, 60, 324, 10), (386, 1, 90, 309, 10), (256, 1, 65, 328, 10), (190, 1, 44, 349, 10)]
    got = evaluate(spark, rows)
    assert all(g[0] for g in got)
    assert {g[2] for g in got} == {P.TIER_URGENT}
    assert got[0][1] == "Multiple alerts: 60"


def test_null_measures_never_fire(spark):
    df = spark.createDataFrame([(None, 0, None, None, 0)], SCHEMA)
    req = R.requires_intervention(A.avg_congestion(), F.col("critical_count"), A.avg_speed())
    assert df.select(req).first()[0] is False


def test_congestion_over_five_case(spark):
    # A run where congestion, not alerts, decides: 6.45 > 5.0 with 0 alerts.
    (req, why, tier), = evaluate(spark, [(645, 1, 0, 327, 10)])
    assert req and why == "High congestion index: 6.45" and tier == P.TIER_MEDIUM
