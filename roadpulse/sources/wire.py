"""JSON wire format: encode telemetry rows to sensor messages and decode them.

Decoding never throws on bad input: malformed JSON yields an all-NULL
struct, a bad timestamp or a non-integer count yields a NULL field. Rows
with NULLs in required fields are routed by the quarantine split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import exprs as X
from roadpulse.schema import WIRE_SCHEMA


def encode_wire(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Telemetry rows -> JSON messages in the sensor wire format."""
    payload = F.struct(
        F.col("sensor_id"),
        X.iso_text("event_time").alias("timestamp"),
        F.col("vehicle_count"),
        F.col("avg_speed"),
        F.col("congestion_index"),
    )
    return df.select(*keep, F.to_json(payload).alias(value_col))


def decode_wire(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON messages (string or binary) -> flat wire columns plus event_time."""
    text = F.col(value_col).cast("string")
    data = F.from_json(text, WIRE_SCHEMA).alias("data")
    return (df.select(*keep, data)
              .select(*keep, "data.*")
              .withColumn("event_time", X.parse_event_time("timestamp")))
