"""DataFrame operators over telemetry: aggregate, rank, join, reshape, rules, quality."""
