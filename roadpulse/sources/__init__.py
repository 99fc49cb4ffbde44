from roadpulse.sources.telemetry import (  # noqa: F401
    Cols, alerts_of, enrich, facts, load_table, newest, on_day, read_alerts, read_facts, read_quarantine,
    telemetry_from_events, trailing,
)
from roadpulse.sources.wire import decode_wire, encode_wire  # noqa: F401
