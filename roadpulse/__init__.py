"""roadpulse: event-telemetry analytics on Spark DataFrames and Structured Streaming.

Sensors report (sensor, time, vehicle count, speed). The library decodes and
validates that telemetry, flags critical readings, aggregates it by key, hour,
day and event-time window, ranks peak hours and latest states, fills gaps,
pivots, and turns the results into rule-based recommendations and daily
reports. Every operator is a native Spark expression plan.
"""

__version__ = "0.1.0"
