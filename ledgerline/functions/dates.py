"""Zone-free time arithmetic on ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of the wall-clock time."""
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of the wall-clock time."""
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def day_start(ts: Column) -> Column:
    return ts.cast("date").cast(NTZ)


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast(NTZ)


def quarter_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "quarter").cast(NTZ)


def year_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "year").cast(NTZ)


def add_months(ts: Column, months: Column | int) -> Column:
    """Months later at the same time of day; a day past the month end is clamped."""
    n = F.lit(months) if isinstance(months, int) else months
    return F.timestamp_add("MONTH", n, ts).cast(NTZ)


def local_time(ts: Column, hours: int = 9) -> Column:
    """UTC wall clock shifted to local wall clock (Korea by default)."""
    return ts + F.expr(f"INTERVAL '{hours}' HOUR")


def minutes_apart(a: Column, b: Column) -> Column:
    """Minute boundaries crossed between two times, as the warehouse counts."""
    return F.abs(F.floor(epoch_seconds(a) / 60) - F.floor(epoch_seconds(b) / 60))


def seconds_apart(a: Column, b: Column) -> Column:
    return F.abs(epoch_seconds(a) - epoch_seconds(b))


def recent_since(as_of: Column, months: int = 1, hours: int = 9) -> Column:
    """Text of the local day ``months`` before ``as_of``."""
    return F.date_format(add_months(local_time(as_of, hours), -months), "yyyy-MM-dd")


def next_reset_date(ts: Column, reset_day: Column) -> Column:
    """Day of the next monthly reset.

    Before the reset day of the month: that day, counted from the first (in a
    short month it runs over into the next). Otherwise that day of the next
    month, or the same day next month when the next month is too short.
    """
    today = ts.cast("date")
    same_day_next = F.add_months(today, 1)
    offset = (reset_day - 1).cast("int")
    this_month = F.date_add(F.trunc(today, "month"), offset)
    next_month = F.date_add(F.trunc(same_day_next, "month"), offset)
    fits = F.dayofmonth(F.last_day(same_day_next)) >= reset_day
    ahead = F.dayofmonth(today) < reset_day
    return F.when(ahead, this_month).when(fits, next_month).otherwise(same_day_next).cast(NTZ)
