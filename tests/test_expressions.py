"""Scalar expressions: rounding, labels, bands, time parsing."""

import datetime as dt

from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.functions import exprs as X


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_congestion_rounding_half_up(spark):
    df = spark.createDataFrame([(23, 40), (41, 40), (51, 40), (180, 9), (10, 3), (5, 0), (7, None)],
                               "c int, s int")
    got = [r[0] for r in df.select(X.congestion_x100("c", "s")).collect()]
    # 0.575 -> 0.58, 1.025 -> 1.03, 1.275 -> 1.28, 20.0, 3.333 -> 3.33, zero/NULL speed -> NULL
    assert got == [58, 103, 128, 2000, 333, None, None]


def test_congestion_index_from_wire_value(spark):
    df = spark.createDataFrame([(1.15,), (20.0,), (0.57,), (None,)], "x double")
    assert [r[0] for r in df.select(X.x100_from_index("x")).collect()] == [115, 2000, 57, None]


def test_fixed_text_half_up(spark):
    r = one(spark, X.fixed_text(F.lit(9), F.lit(4), 1), X.fixed_text(F.lit(41), F.lit(40), 2),
            X.fixed_text(F.lit(413), F.lit(100), 2), X.fixed_text(F.lit(7), F.lit(1), 1),
            X.fixed_text(F.lit(1), F.lit(200), 2))
    assert list(r) == ["2.3", "1.03", "4.13", "7.0", "0.01"]


def test_div_half_up(spark):
    r = one(spark, X.div_half_up(F.lit(5), F.lit(2)), X.div_half_up(F.lit(7), F.lit(2)),
            X.div_half_up(F.lit(4), F.lit(3)), X.div_half_up(F.lit(1), F.lit(0)))
    assert list(r) == [3, 4, 1, None]


def test_critical_flag_is_strict(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "s int")
    assert [r[0] for r in df.select(X.critical_flag("s")).collect()] == [True, False, None]


def test_labels(spark):
    r = one(spark, X.label(F.lit("J1_North_Gate")), X.hour_label(F.lit(3)), X.hour_label(F.lit(3), padded=True),
            X.yes_no(F.lit(True)), X.yes_no(F.lit(False)))
    assert list(r) == ["J1 North Gate", "3:00", "03:00", "YES", "NO"]


def test_hour_bands_cover_every_hour(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = {r.h: r.b for r in df.select("h", X.hour_band("h").alias("b")).collect()}
    assert got[7] == "rush" and got[19] == "rush"
    assert got[10] == "midday" and got[16] == "midday"
    assert got[22] == "night" and got[5] == "night" and got[0] == "night"
    assert got[6] == "normal" and got[20] == "normal" and got[21] == "normal"


def test_speed_bands_thresholds(spark):
    df = spark.createDataFrame([(14.9,), (15.0,), (24.9,), (25.0,)], "s double")
    assert [r[0] for r in df.select(X.speed_band("s")).collect()] == \
        [P.SPEED_BANDS[0], P.SPEED_BANDS[1], P.SPEED_BANDS[1], P.SPEED_BANDS[2]]


def test_parse_event_time(spark):
    df = spark.createDataFrame([("2026-02-07T17:38:36.973711",), ("2026-02-07T17:38:36",), ("garbage",), (None,)],
                               "t string")
    got = [r[0] for r in df.select(X.parse_event_time("t")).collect()]
    assert got == [dt.datetime(2026, 2, 7, 17, 38, 36, 973711), dt.datetime(2026, 2, 7, 17, 38, 36), None, None]


def test_iso_text_omits_zero_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 2, 7, 17, 38, 36),), (dt.datetime(2026, 2, 7, 1, 2, 3, 5),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(X.iso_text("t")).collect()] == ["2026-02-07T17:38:36", "2026-02-07T01:02:03.000005"]


def test_integer_rounding_is_exact_for_large_sums(spark):
    # Beyond 2**53 a double quotient loses digits; the helpers stay exact.
    n, d = 10**17 + 7, 3
    df = spark.createDataFrame([(n, d)], "n long, d long")
    r = df.select(X.div_half_up("n", "d"), X.fixed_text("n", "d", 0), X.idiv("n", "d")).first()
    assert r[0] == (2 * n + d) // (2 * d)
    assert r[1] == str((2 * n + d) // (2 * d))
    assert r[2] == n // d


def test_parse_event_time_ignores_session_clock(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.createDataFrame([("2024-03-10T02:30:00",)], "t string") \
                   .select(X.parse_event_time("t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 3, 10, 2, 30)
