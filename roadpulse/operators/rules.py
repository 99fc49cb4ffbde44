"""Decision rules: intervention flag, reasons text and recommendation tier.

Inputs are exact sums (see ``measure_sums``), so threshold tests are exact
and the numbers printed in reasons are rounded half-up from the exact means.
NULL measures never make a rule fire (each predicate is coalesced to false).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import params as P
from roadpulse.functions import exprs as X


def _fires(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def high_congestion(avg_congestion: Column, limit: float = P.CONGESTION_LIMIT) -> Column:
    return _fires(avg_congestion > F.lit(limit))


def many_alerts(alerts: Column, limit: int = P.ALERT_LIMIT) -> Column:
    return _fires(alerts > F.lit(limit))


def low_speed(avg_speed: Column, limit: float = P.LOW_SPEED_LIMIT) -> Column:
    return _fires(avg_speed < F.lit(limit))


def requires_intervention(avg_congestion: Column, alerts: Column, avg_speed: Column) -> Column:
    return high_congestion(avg_congestion) | many_alerts(alerts) | low_speed(avg_speed)


def priority(required: Column) -> Column:
    return F.when(required, F.lit("HIGH")).otherwise(F.lit("LOW"))


def reasons(x100_sum: str, x100_n: str, alerts: str, speed_sum: str, speed_n: str) -> Column:
    """Reasons that fired, in rule order, joined by ' | ', or the normal-flow text."""
    cong = X.exact_mean(x100_sum, x100_n, 100)
    spd = X.exact_mean(speed_sum, speed_n)
    parts = F.concat_ws(
        P.REASON_SEPARATOR,
        F.when(high_congestion(cong),
               F.concat(F.lit("High congestion index: "),
                        X.fixed_text(F.col(x100_sum), F.col(x100_n) * 100, 2))),
        F.when(many_alerts(F.col(alerts)),
               F.concat(F.lit("Multiple alerts: "), F.col(alerts).cast("long").cast("string"))),
        F.when(low_speed(spd),
               F.concat(F.lit("Low average speed: "), X.fixed_text(speed_sum, speed_n, 1), F.lit(" km/h"))),
    )
    return F.when(parts == "", F.lit(P.NORMAL_FLOW)).otherwise(parts)


def recommendation(required: Column, alerts: Column, avg_congestion: Column) -> Column:
    """Tier text: URGENT (alerts > 30), HIGH (congestion > 7.0), MEDIUM, or LOW."""
    return (F.when(~required, F.lit(P.TIER_LOW))
             .when(_fires(alerts > F.lit(P.URGENT_ALERTS)), F.lit(P.TIER_URGENT))
             .when(_fires(avg_congestion > F.lit(P.HIGH_CONGESTION)), F.lit(P.TIER_HIGH))
             .otherwise(F.lit(P.TIER_MEDIUM)))
