"""The jobs from stored inputs to stored results.

``spark-submit ... -m telemetry_lake.jobs NAME input=path ... out=path`` runs one; without a name it
lists them. Each is also a plain function of a session and paths.
"""

from __future__ import annotations

import datetime
import inspect
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators.joins import without_tagged
from .plans import checkins as checkin_plan
from .plans import compaction, metric_history, service_desk, signal, telemetry_rollups, ticket_activity, usage as usage_plan
from .schemas import SNAPSHOTS, snapshot_columns
from .session import get_session, work_dir
from .sinks import files as sinks
from .sources import files as sources
from .streaming import io, topologies, transforms

JOBS: dict[str, Callable[..., None]] = {}


def job(fn: Callable[..., None]) -> Callable[..., None]:
    JOBS[fn.__name__] = fn
    return fn


# --- raw files to tables ------------------------------------------------------


@job
def compact_metrics(spark: SparkSession, root: str, out: str, files: str = "") -> None:
    compaction.compact(compaction.device_metrics_table(spark, root), out, int(files) if files else None)


@job
def compact_self_tests(spark: SparkSession, root: str, out: str, files: str = "") -> None:
    compaction.compact(compaction.self_test_table(spark, root), out, int(files) if files else None)


@job
def compact_chamber(spark: SparkSession, root: str, out: str, more: str = "") -> None:
    compaction.compact(compaction.chamber_table(spark, root, more), out)


@job
def snapshot(spark: SparkSession, table: str, url: str, query: str, out: str) -> None:
    """Copy a database table; ``table`` names its schema in :data:`telemetry_lake.schemas.SNAPSHOTS`.

    Other tables (accounts, devices, remotes, service plans ...) are copied with all their columns.
    """
    source = spark.read.format("jdbc").options(url=url, dbtable=query).load()
    sources.snapshot_ingest(source, snapshot_columns(table) if table in SNAPSHOTS else sources.passed_through(source), out)


# --- metric history -------------------------------------------------------------


@job
def history_load(spark: SparkSession, history: str, terminals: str, metrics: str, out: str) -> None:
    rows = sources.read_parquet_tree(spark, history)
    loaded = metric_history.load(rows, spark.read.parquet(terminals), spark.read.parquet(metrics))
    loaded.write.mode("overwrite").parquet(out)


@job
def history_process(spark: SparkSession, staging: str, base: str, ledger: str, against: str = "latest") -> None:
    metric_history.process_staging(spark, staging, base, ledger, against)


@job
def history_high_water_mark(spark: SparkSession, base: str, staging: str, out: str) -> None:
    metric_history.save_high_water_mark(spark, base, staging, out)


# --- devices ----------------------------------------------------------------------


@job
def device_checkins(spark: SparkSession, checkins: str, out: str) -> None:
    """All cleaned check-ins and the latest of each device."""
    raw = spark.read.parquet(checkins)
    checkin_plan.cleaned(raw).write.mode("overwrite").parquet(f"{out}/cleaned")
    checkin_plan.latest(raw).write.mode("overwrite").parquet(f"{out}/latest")


@job
def metric_rollups(spark: SparkSession, metrics: str, out: str) -> None:
    """Yearly and monthly breakdowns per device and metric as JSON trees."""
    records = sinks.materialize(
        telemetry_rollups.long_records(spark.read.parquet(metrics)), work_dir(spark, "records")
    )
    years = telemetry_rollups.yearly_breakdown(records)
    months = telemetry_rollups.monthly_breakdown(telemetry_rollups.dealt(records))
    sinks.write_nested_periods(years, months, out, telemetry_rollups.KEYS)


@job
def signal_quality(
    spark: SparkSession, metrics: str, devices: str, history: str, beam_map: str, coverage: str, cell: str, out: str
) -> None:
    samples = spark.read.parquet(metrics).withColumn("time", F.timestamp_seconds("timestamp-S"))
    tidy = spark.read.parquet(history).withColumn("timestamp", F.timestamp_seconds("timestamp"))
    result = signal.signal_vs_coverage(
        samples, spark.read.parquet(devices), tidy, sources.read_csv_header(spark, beam_map),
        sources.read_geojson(spark, coverage, signal.COVERAGE_PROPERTIES), float(cell),
    )
    result.write.mode("overwrite").parquet(out)


@job
def usage(
    spark: SparkSession, history: str, terminals: str, metrics: str, properties: str, remotes: str, out: str
) -> None:
    """Monthly traffic per remote as a JSON tree."""
    documents = sources.read_json(spark, properties)
    traffic = usage_plan.traffic(
        sources.read_parquet_tree(spark, history), spark.read.parquet(terminals), spark.read.parquet(metrics),
        usage_plan.terminal_properties(documents),
    )
    report = usage_plan.usage_by_remote(traffic, spark.read.parquet(remotes))
    sinks.write_partitioned(report, out, ["RemoteId", "year", "month"])


# --- service desk -------------------------------------------------------------------


def _tickets(spark: SparkSession, tickets: str, tags: str) -> DataFrame:
    return without_tagged(spark.read.parquet(tickets), spark.read.parquet(tags))


@job
def ticket_reports(spark: SparkSession, tickets: str, tags: str, out: str) -> None:
    """The reports that need tickets and tags only. Bounded ones are single files."""
    kept = _tickets(spark, tickets, tags)
    single = {
        "breakdown-status-priority": service_desk.status_priority(kept),
        "tickets/last-20-created": service_desk.last_created(kept),
        "tickets/last-20-closed": service_desk.last_closed(kept),
        "ticket-stats": service_desk.ticket_stats(kept),
    }
    for name, report in single.items():
        sinks.write_report(report, f"{out}/{name}", single_file=True)
    sinks.write_report(service_desk.work_in_progress(kept), f"{out}/wip-tickets")


@job
def account_reports(spark: SparkSession, tickets: str, tags: str, accounts: str, excluded: str, out: str) -> None:
    kept, customers = _tickets(spark, tickets, tags), spark.read.parquet(accounts)
    sinks.write_report(service_desk.resolution_by_account(kept, customers, excluded), f"{out}/resolution-time-by-account")
    sinks.write_partitioned(service_desk.tickets_by_account(kept, customers, excluded), f"{out}/by-account", ["AccountId"], order=["Number"])
    sinks.write_report(service_desk.account_list(kept, customers, excluded), f"{out}/account-list")


@job
def status_durations(spark: SparkSession, activity: str, out: str) -> None:
    ticket_activity.status_durations(spark.read.parquet(activity)).write.mode("overwrite").parquet(out)


@job
def index_documents(spark: SparkSession, report: str, by: str, order: str, out: str) -> None:
    """Turn a JSON report tree into one array document per folder (``by``, ``order``: comma-separated columns)."""
    groups = by.split(",")
    documents = sinks.json_array_documents(spark.read.json(report), groups, order.split(","))
    sinks.write_index_documents(documents, out, groups)


# --- streams ------------------------------------------------------------------------


@job
def word_count(spark: SparkSession, servers: str, lines: str, counts: str, checkpoint: str) -> None:
    """Running word counts from one topic to another; runs until stopped."""
    io.use_rocksdb(spark)
    counted = transforms.word_count(io.topic_records(spark, servers, lines))
    records = counted.select(F.col("word").alias("key"), F.col("count").alias("value"))
    with io.state_partitions(spark):
        query = io.to_topic(records, servers, counts, checkpoint, mode="update")
    query.awaitTermination()


# Each of the following keeps its result as a table below ``out`` (read it with
# :func:`telemetry_lake.sinks.changelog.read_current`). It runs until stopped, or with any ``once`` until it
# has worked off what is there. ``*_type`` is the type of a topic's values: ``string`` or ``bigint``.


@job
def stream_filter(spark: SparkSession, servers: str, records: str, value: str, out: str, once: str = "") -> None:
    """Records with one value."""
    topologies.run(topologies.keep(transforms.filter_values(io.topic_records(spark, servers, records), value), out, bool(once)))


@job
def stream_branch(spark: SparkSession, servers: str, records: str, prefixes: str, out: str, once: str = "") -> None:
    """A table per key prefix (comma-separated), ``out/<prefix>``."""
    topologies.run(topologies.keep_branches(io.topic_records(spark, servers, records), prefixes.split(","), out, bool(once)))


@job
def stream_map(spark: SparkSession, servers: str, records: str, out: str, suffix: str = "-new", once: str = "") -> None:
    topologies.run(topologies.keep(transforms.append_suffix(io.topic_records(spark, servers, records), suffix), out, bool(once)))


@job
def stream_flat_map(spark: SparkSession, servers: str, records: str, prefixes: str, out: str, once: str = "") -> None:
    """A record per prefix (comma-separated), keyed ``prefix-value``."""
    expanded = transforms.flat_map_prefixes(io.topic_records(spark, servers, records), prefixes.split(","))
    topologies.run(topologies.keep(expanded, out, bool(once)))


@job
def stream_lower(spark: SparkSession, servers: str, records: str, out: str, once: str = "") -> None:
    topologies.run(topologies.keep(transforms.lower_values(io.topic_records(spark, servers, records)), out, bool(once)))


@job
def stream_count(spark: SparkSession, servers: str, records: str, out: str, once: str = "") -> None:
    """Records per value."""
    topologies.run(topologies.keep_counts(io.topic_records(spark, servers, records), out, bool(once)))


@job
def join_tables(
    spark: SparkSession, servers: str, left: str, right: str, how: str, out: str, left_type: str = "string",
    right_type: str = "bigint", once: str = "",
) -> None:
    """Two topics as tables: ``inner``, ``left`` or ``full``."""
    sides = (io.topic_records(spark, servers, topic, kind) for topic, kind in ((left, left_type), (right, right_type)))
    topologies.run(topologies.join_tables(*sides, how, out, bool(once)))


@job
def join_streams(
    spark: SparkSession, servers: str, left: str, right: str, how: str, out: str, left_type: str = "bigint",
    right_type: str = "string", seconds: str = "300", delay: str = "10 minutes", once: str = "",
) -> None:
    """Records of equal key at most ``seconds`` apart: ``inner``, ``left`` or ``full``; ``delay`` is how late one may be."""
    sides = (io.topic_records(spark, servers, topic, kind) for topic, kind in ((left, left_type), (right, right_type)))
    within = datetime.timedelta(seconds=float(seconds))
    topologies.run(topologies.join_streams(*sides, how, out, within, delay, bool(once)))


@job
def join_stream_with_table(
    spark: SparkSession, servers: str, records: str, table: str, how: str, out: str, records_type: str = "bigint",
    table_type: str = "string", replicated: str = "", once: str = "",
) -> None:
    """Records against a topic as table, ``inner`` or ``left``; with any ``replicated`` the table goes to all tasks while it is small."""
    stream, changes = (io.topic_records(spark, servers, t, kind) for t, kind in ((records, records_type), (table, table_type)))
    topologies.run(*topologies.join_stream_with_table(stream, changes, how, out, bool(replicated), bool(once)))


def main(arguments: Sequence[str]) -> None:
    if not arguments or arguments[0] not in JOBS:
        for name, fn in JOBS.items():
            print(name, *[str(p) for p in list(inspect.signature(fn).parameters.values())[1:]], sep="\n    ")
        raise SystemExit(2 if arguments else 0)
    fn = JOBS[arguments[0]]
    named = dict(a.split("=", 1) for a in arguments[1:])
    try:
        inspect.signature(fn).bind(None, **named)
    except TypeError as problem:
        raise SystemExit(f"{arguments[0]}: {problem}") from None
    fn(get_session(arguments[0]), **named)


if __name__ == "__main__":
    main(sys.argv[1:])
