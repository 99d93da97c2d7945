"""Joins of tables, streams and their current state.

The functions take DataFrames, batch or streaming alike; topic and store names become
sources and sinks. None broadcasts by hint: Spark replicates a side whose size it knows
to be below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles it, with
adaptive execution splitting hot keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import render_pair
from .asof import asof_join


def latest_per_key(changes: DataFrame, key: str | Sequence[str], offset: str) -> DataFrame:
    """Current state of a changelog: the row with the highest ``offset`` of every key."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(offset)).alias("__row")
    return changes.groupBy(*keys).agg(newest).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def current_table(changes: DataFrame, key: str, value: str, offset: str) -> DataFrame:
    """Table behind a changelog, ``(key, value)``: the latest value, where null deletes the key."""
    return (
        latest_per_key(changes.select(key, value, offset), key, offset)
        .filter(F.col(value).isNotNull())
        .select(key, value)
    )


def latest_with_ties(df: DataFrame, key: str, ts: str) -> DataFrame:
    """All rows that carry their key's highest ``ts``; rows without a time are dropped.

    The maximum is pre-aggregated and joined back on ``(key, ts)``, which spreads a hot key
    over its times where a window over the key would not.
    """
    newest = df.groupBy(key).agg(F.max(ts).alias(ts))
    return df.join(newest, [key, ts])


def without_tagged(df: DataFrame, tags: DataFrame, name: str = "ignore", id_column: str = "Id") -> DataFrame:
    """Rows whose id carries no tag ``name``; rows without an id stay."""
    tagged = tags.filter(F.col("Name") == name).select(F.col("EntityId").alias(id_column))
    return df.join(tagged, id_column, "left_anti")


def with_key_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs in ``keys``; copies there shrink to one before they are shuffled."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def join_dimension(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, columns: dict[str, str]) -> DataFrame:
    """Inner join on differently named keys, taking ``columns`` (old name to new name) along."""
    picked = dimension.select(
        F.col(key).alias("__key"), *[F.col(old).alias(new) for old, new in columns.items()]
    )
    return facts.join(picked, F.col(fact_key) == F.col("__key")).drop("__key")


def join_tables(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, how: str = "inner") -> DataFrame:
    """Join two current tables (one row per key) into ``(key, value)`` with ``left/right`` text."""
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unsupported table join {how!r}")
    joined = left.select(key, F.col(left_value).alias("__l")).join(
        right.select(key, F.col(right_value).alias("__r")), key, how
    )
    text = render_pair(
        F.col("__l"), left.schema[left_value].dataType, F.col("__r"), right.schema[right_value].dataType
    )
    return joined.select(key, text.alias("value"))


def join_stream_table(
    stream: DataFrame, table: DataFrame, stream_key: Column | str, table_key: str, stream_value: str,
    table_value: str, how: str = "inner",
) -> DataFrame:
    """Look every stream record up in a table; ``stream_key`` may be any expression of the record.

    Adds ``value`` (``stream/table`` text) to the stream's other columns. Works for a batch and
    for a streaming left side. A table larger than the broadcast threshold is shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported stream-table join {how!r}")
    lookup = F.col(stream_key) if isinstance(stream_key, str) else stream_key
    entries = table.select(F.col(table_key).alias("__k"), F.col(table_value).alias("__t"))
    text = render_pair(
        F.col(stream_value), stream.schema[stream_value].dataType, F.col("__t"), table.schema[table_value].dataType
    )
    keep = [c for c in stream.columns if c != "value"]
    return (
        stream.withColumn("__lookup", lookup)
        .join(entries, F.col("__lookup") == F.col("__k"), how)
        .select(*keep, text.alias("value"))
    )


def replay_stream_table(
    stream: DataFrame, changes: DataFrame, key: str, offset: str, stream_value: str, table_value: str,
    how: str = "inner",
) -> DataFrame:
    """Stream-table join over recorded history: every record sees the table as of its own offset.

    ``stream`` and ``changes`` share the ``offset`` order; null table values delete.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported stream-table join {how!r}")
    versions = changes.select(
        key, F.col(offset).alias("__changed"), F.col(table_value).alias("__t")
    )
    seen = asof_join(stream, versions, [key], offset, "__changed")
    if how == "inner":
        seen = seen.filter(F.col("__t").isNotNull())
    text = render_pair(
        F.col(stream_value), stream.schema[stream_value].dataType, F.col("__t"), changes.schema[table_value].dataType
    )
    keep = [c for c in stream.columns if c != "value"]
    return seen.select(*keep, text.alias("value"))


def join_within(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    within: dt.timedelta = dt.timedelta(minutes=5), how: str = "inner",
) -> DataFrame:
    """Join records of equal key whose times differ by at most ``within`` (both ways, inclusive).

    Returns ``key``, the other left columns and the other right columns, which must not clash.
    The equality also covers a time bucket of width ``within``, so a hot key spreads over its
    buckets. Only the side that needs no padding is listed under several buckets; a full join is
    the left join plus the right rows that met nobody. For outer joins on streams give both
    sides a watermark.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unsupported stream-stream join {how!r}")
    micros = max(within // dt.timedelta(microseconds=1), 1)

    def one_sided(kept, other, kept_time, other_time, join_type):
        bucket = F.floor(F.unix_micros(F.col(kept_time).cast("timestamp")) / F.lit(micros))
        near = F.floor(F.unix_micros(F.col(other_time).cast("timestamp")) / F.lit(micros))
        single = kept.withColumn("__b", bucket)
        spread = other.withColumnRenamed(key, "__key").withColumn(
            "__ob", F.explode(F.sequence(near - 1, near + 1))
        )
        span = F.expr(f"INTERVAL '{micros / 1_000_000:f}' SECOND")
        condition = (
            (F.col(key) == F.col("__key"))
            & (F.col("__b") == F.col("__ob"))
            & (F.col(other_time) >= F.col(kept_time) - span)
            & (F.col(other_time) <= F.col(kept_time) + span)
        )
        return single.join(spread, condition, join_type)

    left_rest = [c for c in left.columns if c != key]
    right_rest = [c for c in right.columns if c != key]
    matched = one_sided(left, right, left_time, right_time, "left" if how == "full" else how)
    result = matched.select(key, *left_rest, *right_rest)
    if how != "full":
        return result
    if left.isStreaming or right.isStreaming:
        lonely = one_sided(right, left, right_time, left_time, "left").filter(F.col("__key").isNull())
    else:
        lonely = one_sided(right, left, right_time, left_time, "left_anti")
    nulls = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left_rest]
    return result.unionByName(lonely.select(key, *nulls, *right_rest))
