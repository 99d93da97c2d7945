"""Event time: rows that come after their time, kept and counted.

A watermark drops late rows inside a stateful operator and leaves a number behind. Here they are told
apart before any state sees them, so that totals of the rows in time and a report of the others are both whole.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sinks.commits import Files
from .io import each_batch

MARKS = "_marks"


def _micros(time: str):
    return F.unix_micros(F.col(time).cast("timestamp"))


def split_late(
    stream: DataFrame, time: str, delay: dt.timedelta, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Write every micro-batch below ``path`` with a column ``late``.

    As with a watermark, a row is late if it lies more than ``delay`` before the highest time of all micro-batches
    before its own. Rows of the first one, and rows without a time, are in time. The highest time is one
    number per micro-batch, written beside its rows; a replayed micro-batch finds the number of the one before
    it unchanged and overwrites itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        marks = Files(batch.sparkSession, f"{path.rstrip('/')}/{MARKS}")
        before, own = (f"{n:012d}" for n in (max(batch_id - 1, 0), batch_id))
        seen = json.loads(marks.read(before)) if batch_id and marks.exists(before) else None
        late = F.lit(False) if seen is None else F.coalesce(_micros(time) < seen - delay // dt.timedelta(microseconds=1), F.lit(False))
        folder = f"{path.rstrip('/')}/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(folder)
        written = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        highest = written.agg(F.max(_micros(time))).first()[0]
        marks.make()
        marks.write(own, json.dumps(max((n for n in (seen, highest) if n is not None), default=None)))

    return each_batch(stream, store, checkpoint, "append", once)


def read_split(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with the micro-batch they came in and whether they were ``late``."""
    return spark.read.schema(T.StructType([*schema, *T.StructType.fromDDL("batch long, late boolean")])).parquet(path)


def lateness(rows: DataFrame, *by: str) -> DataFrame:
    """Rows ``in_time`` and ``late`` per group; groups of late rows only are listed as well."""
    return rows.groupBy(*by).agg(F.count_if(~F.col("late")).alias("in_time"), F.count_if("late").alias("late"))
