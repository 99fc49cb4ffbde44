import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from roadpulse.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("roadpulse-tests", master="local[*]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("rp"))


TELEMETRY = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("avg_speed", T.IntegerType()),
])


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture()
def telemetry(spark):
    """Build an enriched telemetry DataFrame from (id, sensor, time, count, speed) tuples."""
    from roadpulse.sources.telemetry import enrich

    def make(rows):
        data = [(i, s, ts(t) if isinstance(t, str) else t, c, v) for i, s, t, c, v in rows]
        return enrich(spark.createDataFrame(data, TELEMETRY))
    return make
