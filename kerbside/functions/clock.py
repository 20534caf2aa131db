"""Wall-clock helpers. Every instant of interest is a GMT+8 ``timestamp_ntz``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60 * 1_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE


def ntz(as_of: str | datetime) -> Column:
    """Literal wall clock; folds to a constant, so comparisons reach the scan."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a wall clock, whatever the session time zone is."""
    whole = F.unix_date(ts.cast("date")).cast("bigint") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    second = F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)
    return whole * F.lit(1_000_000) + second.cast("bigint")


def to_gmt8(ts: Column, instant: bool = False) -> Column:
    """UTC -> GMT+8 wall clock. A naive value is read as UTC; pass ``instant=True`` for
    a ``timestamp`` (an instant), which must not pass through the session time zone."""
    if instant:
        seconds = F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)
        epoch = ntz("1970-01-01 00:00:00")
        return epoch + F.make_dt_interval(F.lit(0), F.lit(8), F.lit(0), seconds.cast("decimal(18,6)"))
    return ts.cast("timestamp_ntz") + hours(8)


def gmt8_instant(ts: Column) -> Column:
    """The instant a GMT+8 wall clock shows: event time of a stream must be a ``timestamp``."""
    return F.timestamp_micros(wall_micros(ts) - F.lit(8 * MICROS_PER_HOUR))


def within_service_hours(ts: Column, tz: str = "Asia/Singapore", start: int = 9, end: int = 21) -> Column:
    """Is the local hour in [start, end)? Wraps over midnight; equal bounds mean always."""
    if start == end:
        return F.lit(True)
    hour = F.hour(F.convert_timezone(F.lit("+08:00"), F.lit(tz), ts))
    if start < end:
        return (hour >= start) & (hour < end)
    return (hour >= start) | (hour < end)


def recency_score(posted: Column, as_of: str | datetime, span_hours: int = 6) -> Column:
    """1 for a post at (or after) ``as_of``, falling to 0 at ``span_hours``; 0 if unreadable."""
    age = (wall_micros(ntz(as_of)) - wall_micros(posted.try_cast("timestamp_ntz"))) / F.lit(float(MICROS_PER_HOUR))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(float(span_hours)), age))
    return F.coalesce(F.when(age.isNotNull(), F.lit(1.0) - clamped / F.lit(float(span_hours))), F.lit(0.0))
