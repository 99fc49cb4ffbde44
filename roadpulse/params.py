"""Fixed values (thresholds, texts, labels: must equal the behaviour being
reproduced) and default run parameters."""

from __future__ import annotations

import datetime as dt

# --- fixed thresholds -------------------------------------------------------
CRITICAL_SPEED = 10
CONGESTION_LIMIT = 5.0
ALERT_LIMIT = 10
LOW_SPEED_LIMIT = 15.0
URGENT_ALERTS = 30
HIGH_CONGESTION = 7.0
SPEED_BAND_LIMITS = (15, 25)

WINDOW = "5 minutes"
WATERMARK = "10 minutes"

RECENT_ALERTS = 50
RECENT_REPORTS = 20
LATEST_EVENTS = 5
LATEST_HOURS = 5

REASON_SEPARATOR = " | "
NORMAL_FLOW = "Normal traffic flow"
TIER_URGENT = "URGENT: Deploy traffic police immediately"
TIER_HIGH = "HIGH: Deploy traffic police during peak hours"
TIER_MEDIUM = "MEDIUM: Monitor closely, consider deployment"
TIER_LOW = "LOW: Continue monitoring"

SUMMARY_PERIOD = "Report Period: "
SUMMARY_RECORDS = "Total Records: "
SUMMARY_ALERTS = "Total Critical Alerts: "
SENSOR_VEHICLES = "  Total Vehicles: "
SENSOR_SPEED = "  Average Speed: "
SENSOR_CONGESTION = "  Average Congestion Index: "
SENSOR_ALERTS = "  Critical Alerts: "

ANALYSIS_HEADERS = ("Junction", "Peak Hour", "Peak Vehicles", "Total Vehicles", "Avg Speed (km/h)",
                    "Avg Congestion Index", "Critical Alerts", "Intervention Required", "Recommendation")

# Hour bands: (name, hours). Order is the evaluation order.
HOUR_BANDS = (
    ("rush", (7, 8, 9, 17, 18, 19)),
    ("midday", (10, 11, 12, 13, 14, 15, 16)),
    ("night", (22, 23, 0, 1, 2, 3, 4, 5)),
)
DEFAULT_BAND = "normal"

# Analytical summary: fixed labels, in order of appearance.
ANALYTICAL_TITLE = "ANALYTICAL REPORT SUMMARY"
ANALYTICAL_PERIOD = "Data Period: "
ANALYTICAL_OVERALL = "OVERALL STATISTICS"
ANALYTICAL_RECORDS = "Total Traffic Records: "
ANALYTICAL_ALERTS = "Total Critical Alerts (Speed < 10 km/h): "
ANALYTICAL_SENSORS = "Junctions Monitored: "
ANALYTICAL_DATES = "Date Range: "
ANALYTICAL_BY_SENSOR = "JUNCTION-WISE ANALYSIS"
ANALYTICAL_PEAK = "   Peak Hour: "
ANALYTICAL_SPEED = "   Average Speed: "
ANALYTICAL_CONGESTION = "   Congestion Index: "
ANALYTICAL_SENSOR_ALERTS = "   Critical Alerts: "
ANALYTICAL_DECISION = "   Intervention: "

SPEED_BANDS = ("slow", "moderate", "free_flow")

# --- run parameters (explicit "as of", never the wall clock) -----------------
AS_OF_DATE = dt.date(2024, 1, 15)
AS_OF_TS = dt.datetime(2024, 1, 16, 0, 0, 0)
TRAILING_DAYS = 7

# Canonical telemetry derived from the driver's `events` table: sensors are
# user_id buckets J1..J20 (rule: "J" + (user_id % SENSOR_BUCKETS + 1)).
SENSOR_BUCKETS = 20
SPEED_MODULUS = 58
SPEED_OFFSET = 3
COUNT_OFFSET = 10


def sensor_ids(n: int = SENSOR_BUCKETS) -> list[str]:
    """Sensor ids produced by the canonical bucketing rule, in bucket order."""
    return [f"J{i}" for i in range(1, n + 1)]
