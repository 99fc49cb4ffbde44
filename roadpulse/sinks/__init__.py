from roadpulse.sinks.published import AuditFailed, Conflict, Published  # noqa: F401
from roadpulse.sinks.writers import (  # noqa: F401
    export_csv, publish_daily_report, read_daily_reports, upsert_daily_report, write_alerts, write_daily_report, write_facts, write_hourly_rollup, write_recommendations,
    write_summary,
    write_text_report,
)
