"""Streaming runs over the events, each worked off once and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import joins
from ..sinks.changelog import append_changes, create_log, current_of, read_current
from ..streaming import io, late, tables, transforms
from . import joins as batch_joins
from .aggregates import WORDS_SQL
from .registry import query
from .views import Lake

#: All test events lie within a month; nothing is late for this delay.
DELAY = "40 days"
END = "2100-01-01"


class _StreamLake(Lake):
    """The same views on a stream of the table's files."""

    def table(self, name: str) -> DataFrame:
        schema = super().table(name).schema
        return io.file_records(self.spark, self.path(name) + "*", schema)


def _streaming(lake: Lake) -> _StreamLake:
    return _StreamLake(lake.spark, lake.sf_dir)


def _records(lake: Lake) -> DataFrame:
    """Events as keyed text records."""
    return _streaming(lake).events.select(
        F.concat(F.lit("sensor-"), F.col("user_id").cast("string")).alias("key"),
        F.concat_ws("-", "event_type", F.col("k").cast("string")).alias("value"),
    )


RECORDS_SQL = "SELECT 'sensor-' || user_id AS key, event_type || '-' || k AS value, event_type FROM ev"


def _written(lake: Lake, records: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    out = lake.work_dir(label)
    io.to_files(records, f"{out}/data", f"{out}/checkpoint", by=by).awaitTermination()
    return lake.spark.read.parquet(f"{out}/data")


@query(f"SELECT key, value FROM ({RECORDS_SQL}) WHERE value = 'view-7'")
def stream_filter(lake: Lake) -> DataFrame:
    return _written(lake, transforms.filter_values(_records(lake), "view-7"), "filter")


@query(
    f"""SELECT key, value, CAST(CASE WHEN starts_with(key, 'sensor-1') THEN 0 ELSE 1 END AS INTEGER) AS branch
    FROM ({RECORDS_SQL}) WHERE starts_with(key, 'sensor-1') OR starts_with(key, 'sensor-2')"""
)
def stream_branch(lake: Lake) -> DataFrame:
    """Two branches by key prefix, each in a folder of its own."""
    branched = transforms.branch_by_prefix(_records(lake), ["sensor-1", "sensor-2"])
    return _written(lake, branched, "branch", by=("branch",))


@query(f"SELECT key, value || '-new' AS value FROM ({RECORDS_SQL})")
def stream_map(lake: Lake) -> DataFrame:
    return _written(lake, transforms.append_suffix(_records(lake)), "map")


@query(
    f"""SELECT p.prefix || '-' || value AS key, value FROM ({RECORDS_SQL}),
        (VALUES ('temp'), ('location'), ('codename')) AS p(prefix)"""
)
def stream_flatmap(lake: Lake) -> DataFrame:
    return _written(lake, transforms.flat_map_prefixes(_records(lake), ["temp", "location", "codename"]), "flatmap")


@query("SELECT doc_id AS key, lower(text) AS value FROM documents")
def stream_mapvalues(lake: Lake) -> DataFrame:
    documents = _streaming(lake).table("documents").select(F.col("doc_id").alias("key"), F.col("text").alias("value"))
    return _written(lake, transforms.lower_values(documents), "lower")


def _counted(lake: Lake, counts: DataFrame, key: str) -> DataFrame:
    out = lake.work_dir("counts")
    io.use_rocksdb(lake.spark)
    with io.state_partitions(lake.spark):
        io.to_count_table(counts, f"{out}/table", f"{out}/checkpoint", key).awaitTermination()
    return read_current(lake.spark, f"{out}/table", key, "count", "version")


@query(f"SELECT word, count(*) AS count FROM ({WORDS_SQL}) GROUP BY word")
def stream_word_count(lake: Lake) -> DataFrame:
    documents = _streaming(lake).table("documents")
    return _counted(lake, transforms.word_count(documents, "text"), "word")


@query(f"SELECT value, count(*) AS count FROM ({RECORDS_SQL}) GROUP BY value")
def stream_group_count(lake: Lake) -> DataFrame:
    return _counted(lake, transforms.count_by(_records(lake), "value"), "value")


@query("SELECT key, value FROM region_table")
def stream_latest_table(lake: Lake) -> DataFrame:
    """A change stream kept as a table."""
    out = lake.work_dir("table")
    changes = _streaming(lake).region_changes
    io.to_table(changes, f"{out}/table", f"{out}/checkpoint", "key", "value", "offset").awaitTermination()
    return read_current(lake.spark, f"{out}/table", "key", "value", "offset")


def _table_join(lake: Lake, how: str) -> DataFrame:
    io.use_rocksdb(lake.spark)
    out = lake.work_dir("tables")
    live = _streaming(lake)
    pairs = tables.join_table_streams(live.region_changes, live.metric_changes, how)
    with io.state_partitions(lake.spark):
        io.to_table(
            pairs, f"{out}/table", f"{out}/checkpoint", "key", "value", "offset", mode="update"
        ).awaitTermination()
    return read_current(lake.spark, f"{out}/table", "key", "value", "offset")


def _within(lake: Lake, how: str) -> DataFrame:
    """Both sides as files, joined, then one far-off record per side that lets the watermark pass the data.

    A live stream goes on and needs no such record; a run that ends would hold back the
    padded rows of its last stretch.
    """
    io.use_rocksdb(lake.spark)
    out = lake.work_dir("within")
    sides = dict(zip(("left", "right"), batch_joins.within_sides(lake)))
    for name, side in sides.items():
        side.write.parquet(f"{out}/{name}")

    def run() -> None:
        live = {
            name: io.file_records(lake.spark, f"{out}/{name}", side.schema).withWatermark(f"{name}_ts", DELAY)
            for name, side in sides.items()
        }
        joined = joins.join_within(
            live["left"], live["right"], "key", "left_ts", "right_ts", batch_joins.WITHIN, how
        )
        with io.state_partitions(lake.spark):
            io.to_files(joined, f"{out}/data", f"{out}/checkpoint").awaitTermination()

    run()
    for name, side in sides.items():
        end = lake.spark.range(1).select(
            *[F.lit(END).cast("timestamp").alias(c) if c.endswith("_ts") else F.lit("" if c == "key" else None).cast(side.schema[c].dataType).alias(c) for c in side.columns]
        )
        end.write.mode("append").parquet(f"{out}/{name}")
    run()
    rows = lake.spark.read.parquet(f"{out}/data").filter(F.col("key") != "")
    return batch_joins.within_result(rows)


#: Deliveries of the events in :func:`stream_late_rows`, each with every fifth of them.
DELIVERIES, LATE_AFTER = 5, dt.timedelta(days=10)


@query(
    f"""SELECT batch, event_type, count(*) FILTER (WHERE NOT coalesce(ts < top - INTERVAL {LATE_AFTER.days} DAY, false)) AS in_time,
        count(*) FILTER (WHERE ts < top - INTERVAL {LATE_AFTER.days} DAY) AS late
    FROM (SELECT ts, event_type, event_id % {DELIVERIES} AS batch FROM ev) LEFT JOIN (
        SELECT g.go AS batch, max(ts) AS top FROM range({DELIVERIES}) AS g(go) JOIN ev ON event_id % {DELIVERIES} < g.go GROUP BY g.go
    ) USING (batch) GROUP BY batch, event_type"""
)
def stream_late_rows(lake: Lake) -> DataFrame:
    """Events delivered in several goes, of which all but the first bring rows that are too late."""
    out = lake.work_dir("late")
    events = lake.events.select("event_id", "ts", "event_type")
    for go in range(DELIVERIES):
        events.filter(F.col("event_id") % DELIVERIES == go).write.mode("append").parquet(f"{out}/in")
        # A delivery is a micro-batch, however many files it has.
        stream = io.file_records(lake.spark, f"{out}/in", events.schema, files_per_batch=1_000_000)
        late.split_late(stream, "ts", LATE_AFTER, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return late.lateness(late.read_split(lake.spark, f"{out}/rows", events.schema), "batch", "event_type")


def _lookup(lake: Lake, how: str) -> DataFrame:
    """Stream records against a change log, of which every micro-batch reads the buckets of its keys afresh."""
    out = lake.work_dir("lookup")
    create_log(lake.spark, f"{out}/table", lake.region_changes.select("key", "value", "offset").schema)
    append_changes(lake.region_changes, f"{out}/table", 0, "key", "value", "offset")

    def look_up(batch: DataFrame) -> DataFrame:
        regions = current_of(batch, f"{out}/table", "key", "value", "offset")
        joined = joins.join_stream_table(batch, regions, "key", "key", "metric", "value", how)
        return joined.select("offset", "key", "value")

    stream = _streaming(lake).keyed_records("purchase").select("key", "offset", "metric")
    io.lookup_to_files(stream, look_up, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return lake.spark.read.parquet(f"{out}/data").drop("batch")


def _global(lake: Lake, how: str) -> DataFrame:
    """Stream records against a replicated table, read afresh for every micro-batch."""
    out = lake.work_dir("global")
    lake.table("customer").write.parquet(f"{out}/table")

    def look_up(batch: DataFrame) -> DataFrame:
        return batch_joins.global_lookup(batch, io.live_lookup(batch.sparkSession, f"{out}/table"), how)

    io.lookup_to_files(_streaming(lake).keyed_records("purchase"), look_up, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return lake.spark.read.parquet(f"{out}/data").drop("batch")


_LOOKUP_SQL = """
    SELECT k."offset", k.key, k.metric || '/' || coalesce(r.value, 'null') AS value
    FROM keyed k {how} JOIN region_table r ON k.key = r.key WHERE k.event_type = 'purchase'"""


def _register() -> None:
    for how, short in (("inner", "inner"), ("left", "left"), ("full", "outer")):
        query(batch_joins.TABLE_JOIN_SQL[how], name=f"stream_tt_join_{short}")(lambda lake, how=how: _table_join(lake, how))
        query(batch_joins.WITHIN_SQL[how], name=f"stream_ss_join_{short}")(lambda lake, how=how: _within(lake, how))
    for how, word in (("inner", ""), ("left", "LEFT")):
        query(_LOOKUP_SQL.format(how=word), name=f"stream_st_join_{how}")(lambda lake, how=how: _lookup(lake, how))
        query(batch_joins.GLOBAL_SQL[how], name=f"stream_sg_join_{how}")(lambda lake, how=how: _global(lake, how))


_register()
