"""Cutting hot groups into slices, for callers that know which keys are hot.

The ordered operators of this library use :mod:`buckets` instead, which need no counting pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from . import buckets

#: Rows one task should see of one key; larger keys are cut.
MAX_GROUP_ROWS = 2_000_000
#: Slices per ``max_rows`` share, so that uneven arrival still stays near the limit.
OVERSPLIT = 8

SLICE = "__slice"


def with_slices(df: DataFrame, keys: Sequence[str], order: str, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add :data:`SLICE`: equal-width pieces of the integral ``order`` axis for keys over ``max_rows``."""
    hot = (
        df.filter(F.col(order).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__lo"), F.max(order).alias("__hi"))
        .filter(F.col("__n") > max_rows)
        .select(
            *[F.col(k).alias(f"__hot_{k}") for k in keys],
            "__lo",
            ((F.col("__hi") - F.col("__lo")) / (F.ceil(F.col("__n") / max_rows) * OVERSPLIT) + 1)
            .cast("bigint")
            .alias("__width"),
        )
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    piece = F.floor((F.col(order) - F.col("__lo")) / F.col("__width"))
    return df.join(hot, same, "left").withColumn(SLICE, piece).drop("__lo", "__width", *[f"__hot_{k}" for k in keys])


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    into: str,
    tiebreak: Sequence[str] = (),
    max_rows: int | None = None,
    width: int = buckets.STEPS,
) -> DataFrame:
    """:func:`buckets.with_previous`. ``max_rows`` belonged to an earlier layout; it has no effect."""
    return buckets.with_previous(df, keys, order, into, tiebreak, width)
