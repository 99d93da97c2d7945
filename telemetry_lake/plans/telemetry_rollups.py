"""Yearly, monthly and daily statistics per device and metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.reshape import melt, rename_columns
from ..operators.rollups import nest, period_columns, pooled_deviation, roll_up, statistics
from ..schemas import METRIC_CODES

KEYS = ["ASMSerial", "ASMMetric"]
#: Values of a task after the melt, and the most tasks asked for.
TASK_VALUES, MOST_TASKS = 500_000, 20_000
ITEM = ["start", "end", "records", "avg", "max", "min", "stddev"]


def _month() -> list[Column]:
    return period_columns(F.col("timestamp"), "month")


def _dealt(rows: DataFrame, values: int) -> DataFrame:
    tasks = max(-(-values // TASK_VALUES), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(min(tasks, MOST_TASKS), "ASMSerial", *_month())


def dealt(records: DataFrame) -> DataFrame:
    """Stored :func:`long_records` in the partitions they had, of which Spark does not know after reading them.

    Worth the shuffle where the records are rolled up by day, hardly by month or year.
    """
    return _dealt(records, records.count())


def long_records(device_metrics: DataFrame, prefix: str = "AAE") -> DataFrame:
    """Distinct ``(ASMSerial, timestamp, ASMMetric, data)`` of the dictionary's metrics.

    Copies are removed while the rows are still wide, one row instead of one per metric. Then the rows of
    a device and month (of the session's time zone) are dealt to one partition of about
    :data:`TASK_VALUES` values; the rows are counted for that. What is grouped below a month, such as the
    values a device reports twice for one second, needs no shuffle any more. Every granularity builds on
    the result: materialise it once when several are wanted.
    """
    moment = ["ASMSerial", "timestamp"]
    present = {column: code for column, code in METRIC_CODES.items() if column in device_metrics.columns}
    wanted = device_metrics.filter(F.col("ASMSerial").startswith(prefix) & F.col("timestamp-S").isNotNull())
    # Columns take their codes before they become values, so no row needs a lookup.
    time = F.timestamp_seconds("timestamp-S").alias("timestamp")
    readings = rename_columns(wanted.select("ASMSerial", time, *[f"`{c}`" for c in present]), present).distinct()
    placed = _dealt(readings, device_metrics.count() * max(len(present), 1))
    melted = melt(placed, moment, list(present.values()), "ASMMetric", "data").dropna()
    # The months are named wherever rows are grouped, as the rows are dealt by them.
    return melted.select("*", *_month()).distinct().select(*moment, "ASMMetric", "data")


def intervals(records: DataFrame, period: str) -> DataFrame:
    """Statistics per device, metric and ``year``, ``month``, ``day`` (from midnight UTC) or ``date`` (local)."""
    rolled = _with_total(records, period)
    return rolled.select(*KEYS, F.lit(period).alias("duration"), *ITEM)


def _with_total(records: DataFrame, period: str, calendar: Sequence[str] = ()) -> DataFrame:
    """Statistics with the sum, from which longer periods can be built, and the ``calendar`` columns of these."""
    measures = [*statistics(F.col("data")), F.sum("data").alias("total")]
    return roll_up(records, KEYS, "timestamp", period, measures, calendar)


def _nested(records: DataFrame, period: str, part: str, calendar: list[str]) -> DataFrame:
    """Periods with the ordered list of their parts. The records are aggregated once, to parts."""
    measures = [F.sum("total").alias("total"), F.max("max").alias("max"), F.min("min").alias("min")]
    summed = nest(_with_total(records, part, calendar), KEYS, calendar, ITEM, measures)
    averaged = summed.withColumn("avg", F.col("total") / F.col("records"))
    deviation = pooled_deviation(F.col("breakdown"), F.col("avg"), F.col("records"))
    return averaged.withColumn("stddev", deviation).select(
        *KEYS, *calendar, F.lit(period).alias("duration"), *ITEM, "breakdown"
    )


def yearly_breakdown(records: DataFrame) -> DataFrame:
    """Years with the ordered list of their months."""
    return _nested(records, "year", "month", ["year"])


def monthly_breakdown(records: DataFrame) -> DataFrame:
    """Months with the ordered list of their days, both in the session's time zone."""
    return _nested(records, "month", "date", ["year", "month"])
