"""Time columns: epochs, reversed keys, calendar parts and date ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ..schemas import MAX_TICKS


def decode_reversed_key(row_key: Column) -> Column:
    """Epoch second behind a reversed row key (the newest record has the smallest key)."""
    return F.lit(MAX_TICKS) - row_key.cast("bigint")


def encode_reversed_key(epoch_second: Column) -> Column:
    """Inverse of :func:`decode_reversed_key`, as text."""
    return (F.lit(MAX_TICKS) - epoch_second).cast("string")


def from_epoch_nanos(nanos: Column) -> Column:
    """Nanoseconds since the epoch as a timestamp, exact to the microsecond."""
    return F.timestamp_micros(F.floor(nanos / F.lit(1000).cast("decimal(4,0)")).cast("bigint"))


def to_utc(ts: Column, zone: str = "UTC") -> Column:
    """Read the wall-clock time of ``ts`` as local to ``zone`` and return it in UTC."""
    return F.to_utc_timestamp(ts, zone)


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def year_week(year: Column, week: Column) -> Column:
    """``year-week`` label. Weeks are ISO weeks, years are calendar years, as the reports use them."""
    return F.concat(year.cast("string"), F.lit("-"), week.cast("string"))


def long_form(ts: Column, zone: str, standard: str, daylight: str) -> Column:
    """``December 3, 2026 1:17:33 PM PST``: long date and time of a UTC timestamp in ``zone``."""
    local = F.from_utc_timestamp(ts, zone)
    january = F.make_timestamp_ntz(F.year(ts), F.lit(1), F.lit(1), F.lit(12), F.lit(0), F.lit(0)).cast("timestamp")
    winter = F.unix_timestamp(F.from_utc_timestamp(january, zone)) - F.unix_timestamp(january)
    name = F.when(F.unix_timestamp(local) - F.unix_timestamp(ts) == winter, standard).otherwise(daylight)
    return F.concat_ws(" ", F.date_format(local, "MMMM d, yyyy h:mm:ss a"), name)


def preset_range(name: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of a named range, both included."""
    day = dt.timedelta(days=1)
    this_month = as_of.replace(day=1)
    last_month_end = this_month - day
    next_month = (this_month + 31 * day).replace(day=1)
    ranges = {
        "Today": (as_of, as_of),
        "Yesterday": (as_of - day, as_of - day),
        "Last 7 Days": (as_of - 6 * day, as_of),
        "Last 30 Days": (as_of - 29 * day, as_of),
        "This Month": (this_month, next_month - day),
        "Last Month": (last_month_end.replace(day=1), last_month_end),
    }
    if name not in ranges:
        raise ValueError(f"unknown range {name!r}; choose one of {sorted(ranges)}")
    return ranges[name]


def in_preset(ts: Column, as_of: dt.date, name: str = "Last 30 Days") -> Column:
    """Half-open range predicate on ``ts``; plain comparisons, so parquet scans can use it."""
    first, last = preset_range(name, as_of)
    start = dt.datetime.combine(first, dt.time())
    end = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    return (ts >= F.lit(start.isoformat(" ")).cast("timestamp_ntz")) & (
        ts < F.lit(end.isoformat(" ")).cast("timestamp_ntz")
    )
