"""Record streams, transformed or joined, with their results kept as tables.

Inputs are streams of ``key, value, ts, offset`` from any source. A result table is the change log
``out/table``; within a key the change with the highest offset counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import render_pair
from ..operators import joins
from ..sinks.changelog import append_changes, create_log, current_of, fold_levels, read_current
from ..sinks.commits import Files
from . import io, tables, transforms

CHANGE = ("key", "value", "offset")


def run(*queries: StreamingQuery) -> None:
    """Wait for all of them; the first that fails ends the others."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(5)
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()


def keep(records: DataFrame, out: str, once: bool = False) -> StreamingQuery:
    """The latest value per key of records that were filtered or mapped."""
    return io.to_table(records.select(*CHANGE), f"{out}/table", f"{out}/checkpoint", *CHANGE, once=once)


def keep_branches(records: DataFrame, prefixes: Sequence[str], out: str, once: bool = False) -> StreamingQuery:
    """A table ``out/<prefix>/table`` per key prefix; a record belongs to the first prefix it has."""
    branched = transforms.branch_by_prefix(records, prefixes)

    def store(batch: DataFrame, batch_id: int) -> None:
        for n, prefix in enumerate(prefixes):
            _store(batch.filter(F.col("branch") == n), f"{out}/{prefix}/table", batch_id)

    return io.each_batch(branched, store, f"{out}/checkpoint", "append", once)


def keep_counts(records: DataFrame, out: str, once: bool = False) -> StreamingQuery:
    """Records per value, as ``value, count, version``."""
    io.use_rocksdb(records.sparkSession)
    with io.state_partitions(records.sparkSession):
        return io.to_count_table(transforms.count_by(records, "value"), f"{out}/table", f"{out}/checkpoint", "value", once)


def join_tables(left: DataFrame, right: DataFrame, how: str, out: str, once: bool = False) -> StreamingQuery:
    """Two change streams joined as tables."""
    io.use_rocksdb(left.sparkSession)
    pairs = tables.join_table_streams(left, right, how)
    with io.state_partitions(left.sparkSession):
        return io.to_table(pairs, f"{out}/table", f"{out}/checkpoint", *CHANGE, mode="update", once=once)


def join_streams(
    left: DataFrame, right: DataFrame, how: str, out: str, within: dt.timedelta = dt.timedelta(minutes=5),
    delay: str = "10 minutes", once: bool = False,
) -> StreamingQuery:
    """Records of equal key at most ``within`` apart.

    A key keeps the pair whose later record is the newest; among pairs of one moment the larger text. So
    the result does not depend on how the streams were cut into micro-batches.
    """
    io.use_rocksdb(left.sparkSession)
    sides = [
        df.select("key", F.col("ts").alias(f"{name}_ts"), F.col("value").alias(f"{name}_value")).withWatermark(f"{name}_ts", delay)
        for name, df in (("left", left), ("right", right))
    ]
    met = joins.join_within(*sides, "key", "left_ts", "right_ts", within, how)
    text = render_pair(
        F.col("left_value"), met.schema["left_value"].dataType, F.col("right_value"), met.schema["right_value"].dataType
    )
    time = F.greatest("left_ts", "right_ts").cast("timestamp")
    pairs = met.select("key", text.alias("value"), F.struct(F.unix_micros(time).alias("at"), text.alias("text")).alias("offset"))
    with io.state_partitions(left.sparkSession):
        return io.to_table(pairs, f"{out}/table", f"{out}/checkpoint", *CHANGE, once=once)


def join_stream_with_table(
    records: DataFrame, changes: DataFrame, how: str, out: str, replicated: bool = False, once: bool = False
) -> list[StreamingQuery]:
    """Records against a change stream kept as a table, ``out/lookup``, as it is when their micro-batch runs.

    By default a micro-batch reads the buckets of its keys. A ``replicated`` table is read whole and sent to all
    tasks up to :data:`~telemetry_lake.streaming.io.BROADCAST_BYTES`; it is then joined like others. With ``once`` the
    table is worked off before the records.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported stream-table join {how!r}")
    spark, lookup = records.sparkSession, f"{out}/lookup"
    create_log(spark, lookup, changes.select(*CHANGE).schema)
    maintained = io.to_table(changes.select(*CHANGE), lookup, f"{out}/lookup-checkpoint", *CHANGE, once=once)
    if once:
        maintained.awaitTermination()

    def store(batch: DataFrame, batch_id: int) -> None:
        if replicated:
            table = read_current(batch.sparkSession, lookup, *CHANGE)
            if Files(batch.sparkSession, lookup).size() <= io.BROADCAST_BYTES:
                table = F.broadcast(table)
        else:
            table = current_of(batch, lookup, *CHANGE)
        joined = joins.join_stream_table(batch, table, "key", "key", "value", "value", how)
        _store(joined, f"{out}/table", batch_id)

    return [maintained, io.each_batch(records.select(*CHANGE), store, f"{out}/checkpoint", "append", once)]


def _store(changes: DataFrame, path: str, batch_id: int) -> None:
    append_changes(changes, path, batch_id, *CHANGE)
    fold_levels(changes.sparkSession, path, "key", "offset")
