"""Wire decode on malformed input and the quarantine split."""

import datetime as dt

from roadpulse.operators.quality import split_valid
from roadpulse.sources.wire import decode_wire

GOOD = '{"sensor_id":"J1_North_Gate","timestamp":"2026-02-07T17:38:36.973711","vehicle_count":180,"avg_speed":9,"congestion_index":20.0}'


def decode(spark, lines):
    return decode_wire(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_good_message(spark):
    r = decode(spark, [GOOD]).first()
    assert r.sensor_id == "J1_North_Gate" and r.vehicle_count == 180 and r.avg_speed == 9
    assert r.congestion_index == 20.0
    assert r.event_time == dt.datetime(2026, 2, 7, 17, 38, 36, 973711)


def test_bad_messages_become_nulls(spark):
    rows = decode(spark, [
        "{not json",
        '{"sensor_id":"J2","timestamp":"yesterday","vehicle_count":1,"avg_speed":2}',
        '{"sensor_id":"J3","timestamp":"2026-02-07T17:38:36","vehicle_count":18.5,"avg_speed":"7"}',
        '{"sensor_id":"J4","vehicle_count":3,"avg_speed":30}',
        '{"sensor_id":"J5","timestamp":"2026-02-07T17:38:36","vehicle_count":3,"avg_speed":30}',
    ]).collect()
    assert rows[0].sensor_id is None and rows[0].event_time is None
    assert rows[1].event_time is None and rows[1].vehicle_count == 1
    assert rows[2].vehicle_count is None and rows[2].avg_speed is None
    assert rows[3].timestamp is None and rows[3].event_time is None
    assert rows[4].event_time == dt.datetime(2026, 2, 7, 17, 38, 36)


def test_quarantine_split(spark):
    df = decode(spark, [GOOD, "{not json", '{"sensor_id":"J9","timestamp":"2026-02-07T17:38:36",'
                                            '"vehicle_count":3,"avg_speed":0}'])
    valid, bad = split_valid(df)
    assert valid.count() == 1
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert reasons == ["nonpositive_avg_speed",
                       "null_sensor_id;null_event_time;null_vehicle_count;null_avg_speed"]
