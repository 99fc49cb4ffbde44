from roadpulse.streaming.pipeline import (  # noqa: F401
    dedup_events, enrich_stream, kafka_source, latest_status_stream, read_wire_files,
    latest_windows, start_fact_sinks, start_latest_status, start_cutoff, start_store_sink, start_windows, valid_only,
    watermark_drops, window_update_sink,
)
from roadpulse.streaming.served import (  # noqa: F401
    Ledger, LedgerListener, late_by_batch, late_rows, served_status, start_late_split, start_served_status,
    window_table, window_table_sink,
)
