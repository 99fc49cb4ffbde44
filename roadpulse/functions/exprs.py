"""Scalar column expressions (all native Spark, no Python UDFs).

Numbers that feed comparisons or text are kept exact: congestion indexes are
carried as integer hundredths, means are one division of two exact integers,
and rounding for display is integer half-up arithmetic. That makes results
independent of partitioning and summation order, and equal to any other SQL
engine that does the same integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import params as P

__all__ = [
    "col_of", "idiv", "congestion_x100", "congestion_from_x100", "x100_from_index",
    "critical_flag", "hour_of_day", "event_date", "date_text", "label",
    "hour_label", "div_half_up", "fixed_text", "exact_mean", "yes_no",
    "status_glyph", "hour_band", "speed_band",
    "iso_text", "ts_text", "parse_event_time", "hour_bucket",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(num: str | Column, den: str | Column) -> Column:
    """Exact integral division of longs (SQL ``div``); callers guard den > 0."""
    return F.call_function("div", col_of(num).cast("long"), col_of(den).cast("long"))


def congestion_x100(count: str | Column, speed: str | Column) -> Column:
    """count / speed rounded half-up to 2 decimals, as integer hundredths.

    (200*count + speed) div (2*speed); zero or NULL speed gives NULL.
    """
    c, s = col_of(count).cast("long"), col_of(speed).cast("long")
    return F.when(s > 0, idiv(c * 200 + s, s * 2))


def congestion_from_x100(x100: str | Column) -> Column:
    return col_of(x100) / F.lit(100)


def x100_from_index(index: str | Column) -> Column:
    """Integer hundredths of a congestion index given as a double, half-up.

    An index that is not finite or does not fit gives NULL (never throws);
    further decimals than two are rounded away before averaging."""
    return F.round(col_of(index) * 100).try_cast("long")


def critical_flag(speed: str | Column, threshold: int = P.CRITICAL_SPEED) -> Column:
    """True when the reading is critical: speed strictly below the threshold."""
    return col_of(speed) < F.lit(threshold)


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(col_of(ts)).cast("int")


def event_date(ts: str | Column) -> Column:
    return F.to_date(col_of(ts))


def date_text(ts: str | Column) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd")


def label(c: str | Column) -> Column:
    """Display label: underscores become spaces."""
    return F.translate(col_of(c), "_", " ")


def hour_label(hour: str | Column, padded: bool = False) -> Column:
    """'7:00' (unpadded) or '07:00' (padded)."""
    h = col_of(hour).cast("string")
    return F.concat(F.lpad(h, 2, "0") if padded else h, F.lit(":00"))


def div_half_up(num: str | Column, den: str | Column) -> Column:
    """num / den rounded half-up to an integer, for num >= 0 and den > 0
    (exact integer arithmetic at any magnitude)."""
    n, d = col_of(num).cast("long"), col_of(den).cast("long")
    return F.when(d > 0, idiv(n * 2 + d, d * 2))


def fixed_text(num: str | Column, den: str | Column, digits: int) -> Column:
    """Text of num / den with ``digits`` decimals, rounded half-up (num >= 0)."""
    scale = 10 ** digits
    scaled = div_half_up(col_of(num).cast("long") * scale, den)
    whole = idiv(scaled, F.lit(scale)).cast("string")
    if digits == 0:
        return whole
    frac = F.lpad((scaled % scale).cast("string"), digits, "0")
    return F.concat(whole, F.lit("."), frac)


def exact_mean(total: str | Column, n: str | Column, scale: int = 1) -> Column:
    """total / (n * scale) as one correctly rounded double; NULL when n = 0."""
    return F.try_divide(col_of(total).cast("double"), (col_of(n) * scale).cast("double"))


def yes_no(flag: str | Column) -> Column:
    return F.when(col_of(flag), F.lit("YES")).otherwise(F.lit("NO"))


def status_glyph(flag: str | Column) -> Column:
    return F.when(col_of(flag), F.lit("critical")).otherwise(F.lit("normal"))


def hour_band(hour: str | Column) -> Column:
    h = col_of(hour)
    expr = None
    for name, hours in P.HOUR_BANDS:
        cond = h.isin(*hours)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(P.DEFAULT_BAND))


def speed_band(mean_speed: str | Column, limits: tuple[int, int] = P.SPEED_BAND_LIMITS) -> Column:
    s = col_of(mean_speed)
    low, mid = limits
    return (F.when(s < low, F.lit(P.SPEED_BANDS[0]))
            .when(s < mid, F.lit(P.SPEED_BANDS[1]))
            .otherwise(F.lit(P.SPEED_BANDS[2])))


def hour_bucket(ts: str | Column, naive: bool = True) -> Column:
    """Start of the hour containing ``ts``. Naive times are truncated on their
    wall-clock fields (no session time zone involved); zoned times use
    ``date_trunc``."""
    t = col_of(ts)
    if naive:
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))
    return F.date_trunc("hour", t)


def ts_text(ts: str | Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.ffffff]' text of a timestamp (fraction omitted at 0 us)."""
    return iso_text(ts, sep=" ")


def iso_text(ts: str | Column, sep: str = "T") -> Column:
    """ISO-8601 text of a naive timestamp; the fraction is omitted at 0 us.
    One format call; the always-6-digit fraction is dropped only when it is
    exactly zero."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" if sep == "T" else f"yyyy-MM-dd{sep}HH:mm:ss.SSSSSS"
    return F.regexp_replace(F.date_format(col_of(ts), pattern), r"\.000000$", "")


def parse_event_time(text: str | Column) -> Column:
    """ISO text -> naive event time; unparseable text gives NULL (never throws).
    Parsed straight to TIMESTAMP_NTZ, so no session time zone is involved
    (a wall-clock time inside a daylight-saving gap is kept as written)."""
    return col_of(text).try_cast("timestamp_ntz")
