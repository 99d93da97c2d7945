"""Table-table joins on two change streams.

Spark has no join of two continuously updated tables: a stream-stream join would keep and
pair every old version. Here a streaming aggregate holds the current value per key and side; its partial
aggregates reduce each micro-batch to one change per key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import render_pair


def join_table_streams(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join two change streams ``(key string, value, offset)`` as tables; null values delete.

    The offsets of a stream order its own changes only; those of the two need not be comparable. Among
    changes of one offset the larger value counts. Emits ``(key, value, offset)`` whenever either side
    changes, once per key and micro-batch; a null value says the pair left the result. The ``offset``
    emitted is the number of changes of the key so far: it rises with each row of a key, whichever side
    changed, so the newest row of a key has the largest. A key's state stays after both sides deleted it.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unsupported table join {how!r}")

    def tagged(df: DataFrame, side: str) -> DataFrame:
        value = F.col("value").cast("string").alias("value")
        return df.select("key", F.lit(side).alias("side"), F.struct(F.col("offset").cast("bigint").alias("offset"), value).alias("change"))

    def newest(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("change")))

    changes = tagged(left, "l").unionByName(tagged(right, "r"))
    pairs = changes.groupBy("key").agg(newest("l").alias("l"), newest("r").alias("r"), F.count(F.lit(1)).alias("offset"))
    l, r = F.col("l.value"), F.col("r.value")
    in_result = {"inner": l.isNotNull() & r.isNotNull(), "left": l.isNotNull(), "full": l.isNotNull() | r.isNotNull()}[how]
    text = render_pair(l, left.schema["value"].dataType, r, right.schema["value"].dataType)
    return pairs.select("key", F.when(in_result, text).alias("value"), "offset")
