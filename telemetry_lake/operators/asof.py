"""As-of left joins: the nearest earlier (or later) row of other tables, per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .buckets import BUCKET, HOUR, STEPS, bucket_of, handed_over, micros

#: Pieces over which left rows without a key or time spread; they match nothing.
UNMATCHABLE_PIECES = 4096


@dataclass(frozen=True)
class Lookup:
    """A table to look up as of a time: its time column, reach and order among equal times."""

    table: DataFrame
    time: str
    tolerance: dt.timedelta | int | None = None
    tiebreak: Sequence[str] = ()


def _as_long(df: DataFrame, name: str) -> Column:
    """A time as microseconds; an integral order column as it is."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(F.col(name))
    return F.col(name).cast("bigint")


def _all_present(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    tolerance: dt.timedelta | int | None = None,
    direction: str = "backward",
    strict: bool = False,
    tiebreak: Sequence[str] = (),
    max_group_rows: int | None = None,
    width: dt.timedelta | int | None = None,
) -> DataFrame:
    """:func:`asof_join_all` with one table."""
    lookup = Lookup(right, right_time, tolerance, tiebreak)
    return asof_join_all(left, [lookup], on, left_time, direction, strict, max_group_rows, width)


def asof_join_all(
    left: DataFrame,
    lookups: Sequence[Lookup],
    on: Sequence[str],
    left_time: str,
    direction: str = "backward",
    strict: bool = False,
    max_group_rows: int | None = None,
    width: dt.timedelta | int | None = None,
) -> DataFrame:
    """Keep every ``left`` row and add the matching columns of each lookup, or nulls.

    ``backward`` takes the latest row at or before the left time, ``forward`` the earliest one at
    or after it; ``strict`` leaves equal times out. Rows further away than the tolerance do not
    match, nor do null keys or times. Among rows of equal time the last one by ``tiebreak`` wins
    backward and the first one forward; without it the choice is open.

    All tables meet in one shuffle and one sort on ``(key, bucket)``: looked-up rows sort among the
    left rows and the last one of each table is carried along, so no pairs are produced. Buckets have
    the fixed ``width``, an hour by default or 65,536 steps of an integral order, so that a task's rows
    do not grow with a key's; what a bucket inherits is aggregated from a second reading of the
    inputs: hand in stored tables, not long lineages. ``max_group_rows`` belonged to an earlier layout;
    it is accepted and has no effect.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be 'backward' or 'forward', not {direction!r}")
    on = list(on)
    added = {i: [c for c in lookup.table.columns if c not in on] for i, lookup in enumerate(lookups)}
    left_only = [c for c in left.columns if c not in on]
    names = [*left_only, *[c for columns in added.values() for c in columns]]
    clash = {c for c in names if names.count(c) > 1}
    if clash:
        raise ValueError(f"rename columns present on several sides: {sorted(clash)}")
    backward = direction == "backward"
    # Forward runs the same way on the mirrored time axis.
    sign = 1 if backward else -1
    left_rank, right_rank = (0, 1) if strict else (1, 0)

    both = left.select(
        *on,
        F.when(_all_present([*on, left_time]), _as_long(left, left_time) * sign).alias("__o"),
        F.lit(left_rank).alias("__rank"),
        F.struct(*[F.col(c) for c in left_only], F.lit(1).alias("__row")).alias("__l"),
    )
    for i, lookup in enumerate(lookups):
        table = lookup.table.filter(_all_present([*on, lookup.time]))
        rows = table.withColumn("__o", _as_long(table, lookup.time) * sign).select(
            *on,
            "__o",
            F.lit(right_rank).alias("__rank"),
            F.struct("__o", *[F.col(c) for c in added[i]]).alias(f"__r{i}"),
        )
        both = both.unionByName(rows, allowMissingColumns=True)
    if width is None:
        width = HOUR if isinstance(left.schema[left_time].dataType, (T.TimestampType, T.TimestampNTZType)) else STEPS
    # Left rows that cannot match need no order: spread them instead of meeting in one null group.
    unmatchable = F.col("__o").isNull()
    piece = F.when(unmatchable, F.pmod(F.xxhash64("__l"), F.lit(UNMATCHABLE_PIECES)))
    both = both.withColumns({BUCKET: bucket_of(F.col("__o"), micros(width)), "__piece": piece})

    ends, tie_order = {}, []
    for i, lookup in enumerate(lookups):
        row = F.col(f"__r{i}")
        ties = [row[c] for c in lookup.tiebreak]
        if backward:
            last = F.max_by(row, F.when(row.isNotNull(), F.struct(F.col("__o"), *ties)))
            tie_order += [t.asc_nulls_first() for t in ties]
        else:
            last = F.min_by(row, F.when(row.isNotNull(), F.struct(-F.col("__o"), *ties)))
            tie_order += [t.desc_nulls_last() for t in ties]
        ends[f"__r{i}"] = last
    carried = [f"__r{i}" for i in added]
    last_time = F.greatest(*[F.col(c)["__o"] for c in carried]) if len(carried) > 1 else F.col(carried[0])["__o"]
    # What a bucket with left rows inherits from the buckets before enters as one more looked-up row.
    inherited = handed_over(both.filter(~unmatchable), on, ends, F.col("__l").isNotNull())
    inherited = inherited.withColumns({"__o": last_time, "__rank": F.lit(right_rank)})
    so_far = (
        Window.partitionBy(*on, BUCKET, "__piece")
        .orderBy("__o", "__rank", *tie_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = (
        both.unionByName(inherited, allowMissingColumns=True)
        .withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in carried})
        .filter(F.col("__l").isNotNull())
    )
    columns = [*on, *[F.col("__l")[c].alias(c) for c in left_only]]
    for i, lookup in enumerate(lookups):
        row = F.col(f"__r{i}")
        close = row.isNotNull() & ~unmatchable
        if lookup.tolerance is not None:
            reach = lookup.tolerance
            if isinstance(reach, dt.timedelta):
                reach = reach // dt.timedelta(microseconds=1)
            close &= F.col("__o") - row["__o"] <= reach
        columns += [F.when(close, row[c]).alias(c) for c in added[i]]
    return seen.select(*columns)
