"""Calendar roll-ups and nested breakdowns.

Only plain ``groupBy`` aggregates: they combine on the map side, so a hot series reaches
the shuffle as one row per task and period.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def period_columns(ts: Column, period: str) -> list[Column]:
    """Grouping columns of a calendar period.

    Years, months and ``date`` follow the session's time zone; ``day`` is the tumbling window of 24
    hours from the epoch on, which a local month may cut. Parts of a month are therefore dates.
    """
    year, month = F.year(ts).alias("year"), F.month(ts).alias("month")
    if period == "year":
        return [year]
    if period == "month":
        return [year, month]
    if period == "day":
        return [F.window(ts, "1 day").alias("window")]
    if period == "date":
        return [F.to_date(ts).alias("date")]
    raise ValueError(f"unknown period {period!r}")


def statistics(value: Column) -> list[Column]:
    """Average, extremes and sample deviation (null for a single record)."""
    return [
        F.avg(value).alias("avg"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.stddev(value).alias("stddev"),
    ]


def roll_up(
    df: DataFrame, keys: Sequence[str], ts: str, period: str, measures: Sequence[Column], calendar: Sequence[str] = ()
) -> DataFrame:
    """First and last time, record count and ``measures`` per key and calendar period.

    ``calendar`` names those of ``year`` and ``month`` that stay. A day is grouped with its month, so that rows
    dealt by key and month are not shuffled again; not so in zones where a month cuts the UTC day.
    """
    time = F.col(ts)
    parts = period_columns(time, period)
    if period == "date" or period == "day" and df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC":
        parts = [*period_columns(time, "month"), *parts]
    grouped = df.groupBy(*keys, *parts).agg(
        F.min(time).alias("start"), F.max(time).alias("end"), F.count(time).alias("records"), *measures
    )
    return grouped.drop(*{"year", "month", "window", "date"} - {*calendar})


def with_calendar(df: DataFrame, *parts: str) -> DataFrame:
    """Add ``year`` and/or ``month`` of the period start, unless they are there."""
    known = {"year": F.year("start"), "month": F.month("start")}
    return df.select("*", *[known[part].alias(part) for part in parts if part not in df.columns])


def nest(
    children: DataFrame, keys: Sequence[str], parts: Sequence[str], fields: Sequence[str | Column],
    measures: Sequence[Column] = (),
) -> DataFrame:
    """Sum sub-periods up to their period, with their ordered list as ``breakdown``.

    ``parts`` names the calendar columns of the period. Start, end and record count come from the
    children, so the records are not aggregated a second time and nothing is joined; ``measures``
    adds further aggregates of the children. A list is as long as the calendar allows: 12
    months per year, 31 days per month.
    """
    return (
        with_calendar(children, *parts)
        .groupBy(*keys, *parts)
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("records").alias("records"),
            *measures,
            F.sort_array(F.collect_list(F.struct(*fields))).alias("breakdown"),
        )
    )


def pooled_deviation(items: Column, mean: Column, records: Column) -> Column:
    """Sample deviation of a period from the count, average and deviation of its parts.

    Sums squares around the common mean (no difference of large numbers); null for one record.
    """

    def squares(total: Column, i: Column) -> Column:
        inner = F.coalesce(i["stddev"] * i["stddev"] * (i["records"] - 1), F.lit(0.0))
        return total + inner + i["records"] * (i["avg"] - mean) * (i["avg"] - mean)

    total = F.aggregate(items, F.lit(0.0), squares)
    return F.when(records > 1, F.sqrt(total / (records - 1)))


def with_group_stats(df: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Add per-group aggregates to every row.

    Aggregates first and joins back: unlike a window, no group is held in one task. A missing key
    is a group like any other.
    """
    named = {f"__{k}": k for k in keys}
    stats = df.groupBy(*[F.col(k).alias(own) for own, k in named.items()]).agg(*measures)
    same = [df[k].eqNullSafe(stats[own]) for own, k in named.items()]
    others = [c for c in df.columns if c not in keys]
    added = [c for c in stats.columns if c not in named]
    return df.join(stats, reduce(and_, same)).select(*[df[c] for c in [*keys, *others]], *[stats[c] for c in added])
