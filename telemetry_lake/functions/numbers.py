"""Numeric columns: rounding and human-readable sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400

# Decimal size steps, largest first.
SIZE_STEPS = [(1e12, "TB"), (1e9, "GB"), (1e6, "MB"), (1e3, "KB")]


def long_from_bytes(value: Column) -> Column:
    """Eight big-endian bytes, as stream clients write numbers, as a signed long."""
    return F.conv(F.hex(value), 16, -10).cast("bigint")


def si_prefix(value: Column) -> Column:
    """A size as text: two decimals from 1 KB up, the plain number and ``B`` below."""
    value = value.cast("double")
    text = None
    for step, unit in SIZE_STEPS:
        # NaN sorts above every number in Spark; it belongs to the plain branch.
        applies = (value >= step) & ~F.isnan(value)
        scaled = F.format_string(f"%3.2f {unit}", value / step)
        text = F.when(applies, scaled) if text is None else text.when(applies, scaled)
    return text.otherwise(F.concat(value.cast("string"), F.lit(" B")))


def round_half_down(value: Column, digits: int = 1) -> Column:
    """Round to ``digits`` decimals; an exact half goes towards zero. Returns float."""
    scale = 10**digits
    exact = value.try_cast("decimal(30,15)")
    steps = F.ceil(F.abs(exact) * scale - F.lit(0.5).cast("decimal(2,1)"))
    signed = F.when(exact < 0, -steps).otherwise(steps)
    number = value.cast("double")
    # So large a double has no decimals to round; NaN stays.
    as_it_is = F.isnan(number) | (F.abs(number) >= float(2**53) / scale)
    return F.when(as_it_is, number).otherwise((signed / scale).cast("double")).cast("float")


def days(seconds: Column) -> Column:
    """Seconds as fractional days."""
    return seconds / SECONDS_PER_DAY


def format_days(seconds: Column) -> Column:
    """Seconds as days with one decimal, as text."""
    return F.format_string("%.1f", days(seconds))
