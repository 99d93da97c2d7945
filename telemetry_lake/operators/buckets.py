"""Ordered work per key in buckets of fixed width along the order.

A window over ``partitionBy(key)`` puts a whole key into one task. Here rows meet by ``(key, bucket)``,
and a bucket learns from one more row what the buckets before it hand over: the last row of each
bucket is an aggregate, and a second scan carries it along a key's buckets. The width is fixed beforehand, so
neither the size of a key nor its range of values is asked for: an outlying value is a bucket of
its own, a missing key is a key like others, and no key is too hot or one too many. What a task sees of a key are
the rows of one width, and in the second scan one row for each of its buckets.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = "__bucket"
#: Widths unless the caller names one: an hour of time, or so many steps of an integral order.
HOUR, STEPS = dt.timedelta(hours=1), 1 << 16


def micros(width: dt.timedelta | int) -> int:
    """A width in the unit of its order: microseconds for times."""
    return width // dt.timedelta(microseconds=1) if isinstance(width, dt.timedelta) else width


def bucket_of(order: Column, width: int) -> Column:
    """The bucket of an integral order value; it never falls as the value rises."""
    return F.floor(order / F.lit(width))


def handed_over(rows: DataFrame, keys: Sequence[str], ends: Mapping[str, Column], wanted: Column | None = None) -> DataFrame:
    """``keys``, :data:`BUCKET` and for each bucket the last of ``ends`` that earlier buckets of the key know.

    ``ends`` are aggregates of a bucket, null where it knows nothing. Buckets without a ``wanted`` row are
    passed over, as are those before which nothing is known.
    """
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    asked = F.lit(True) if wanted is None else F.max(wanted)
    carried = rows.groupBy(*keys, BUCKET).agg(*[end.alias(name) for name, end in ends.items()], asked.alias("__asked"))
    carried = carried.withColumns({name: F.last(name, ignorenulls=True).over(earlier) for name in ends})
    known = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in ends])
    return carried.filter(F.col("__asked") & known).drop("__asked")


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, into: str, tiebreak: Sequence[str] = (), width: int = STEPS
) -> DataFrame:
    """Add ``into``: the ``order`` value of the row before, per key (null on the first row).

    ``order`` is an integral column without nulls; rows without a key are a group like others.
    """
    rows = df.withColumn(BUCKET, bucket_of(F.col(order), width))
    before = handed_over(rows, keys, {"__end": F.max(order)})
    extra = before.select(*keys, BUCKET, F.col("__end").alias(order), F.lit(True).alias("__extra"))
    both = rows.withColumn("__extra", F.lit(False)).unionByName(extra, allowMissingColumns=True)
    in_bucket = Window.partitionBy(*keys, BUCKET).orderBy(order, F.desc("__extra"), *tiebreak)
    return both.withColumn(into, F.lag(order).over(in_bucket)).filter(~F.col("__extra")).drop("__extra", BUCKET)
