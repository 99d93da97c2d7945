"""Sinks, each written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import encode_reversed_key
from ..plans import metric_history as history_plan, telemetry_rollups
from ..sinks import changelog, files, ledger
from ..sources.files import read_parquet_tree
from .registry import query
from .views import Lake


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def compact_parquet(lake: Lake) -> DataFrame:
    path = lake.work_dir("compact")
    files.compact_parquet(lake.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path, 4)
    return lake.spark.read.parquet(path)


@query(
    """SELECT o_orderpriority, o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY o_orderpriority, o_orderstatus"""
)
def json_report_roundtrip(lake: Lake) -> DataFrame:
    """A small aggregate as a single JSON file."""
    path = lake.work_dir("report")
    report = lake.table("orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    files.write_report(report, path, single_file=True)
    return lake.spark.read.schema(report.schema).json(path)


@query("SELECT c_mktsegment, c_custkey, c_name, c_acctbal FROM customer")
def json_partitioned_roundtrip(lake: Lake) -> DataFrame:
    path = lake.work_dir("partitioned")
    customers = lake.table("customer").select("c_mktsegment", "c_custkey", "c_name", "c_acctbal")
    files.write_partitioned(customers, path, ["c_mktsegment"])
    return lake.spark.read.schema(customers.schema).json(path).select(customers.columns)


@query(
    """SELECT 'year' AS tree, y."ASMSerial", y."ASMMetric", CAST(year(y.start) AS INTEGER) AS year,
        CAST(NULL AS INTEGER) AS month, y.records, count(*) AS items, CAST(sum(m.records) AS BIGINT) AS item_records
    FROM yearly y JOIN monthly m ON y."ASMSerial" = m."ASMSerial" AND y."ASMMetric" = m."ASMMetric"
        AND year(y.start) = year(m.start)
    GROUP BY ALL
    UNION ALL
    SELECT 'month', m."ASMSerial", m."ASMMetric", CAST(year(m.start) AS INTEGER), CAST(month(m.start) AS INTEGER),
        m.records, count(*), CAST(sum(d.records) AS BIGINT)
    FROM monthly m JOIN daily d ON m."ASMSerial" = d."ASMSerial" AND m."ASMMetric" = d."ASMMetric"
        AND date_trunc('month', m.start) = date_trunc('month', d.start)
    GROUP BY m."ASMSerial", m."ASMMetric", m.start, m.records"""
)
def nested_tree_write(lake: Lake) -> DataFrame:
    """Yearly and monthly breakdowns written as partitioned JSON trees."""
    root = lake.work_dir("tree")
    records = files.materialize(telemetry_rollups.long_records(lake.device_metrics), f"{root}/records")
    years = telemetry_rollups.yearly_breakdown(records)
    months = telemetry_rollups.monthly_breakdown(telemetry_rollups.dealt(records))
    year_path, month_path = files.write_nested_periods(years, months, f"{root}/report", ["ASMMetric"], "gzip")
    year_rows = lake.spark.read.schema(years.schema).json(year_path)
    month_rows = lake.spark.read.schema(months.drop("duration").schema).json(month_path)

    def summary(df: DataFrame, tree: str, month) -> DataFrame:
        total = F.aggregate("breakdown", F.lit(0).cast("bigint"), lambda acc, i: acc + i["records"])
        return df.select(
            F.lit(tree).alias("tree"), "ASMSerial", "ASMMetric", "year", month.alias("month"), "records",
            F.size("breakdown").cast("bigint").alias("items"), total.alias("item_records"),
        )

    return summary(year_rows, "year", F.lit(None).cast("int")).unionByName(summary(month_rows, "month", F.col("month")))


@query(
    """SELECT n_regionkey, CAST(0 AS INTEGER) AS part,
        CAST(to_json(list(struct_pack(n_nationkey := n_nationkey, n_name := n_name) ORDER BY n_nationkey)) AS VARCHAR) AS document
    FROM nation GROUP BY n_regionkey"""
)
def json_array_index(lake: Lake) -> DataFrame:
    """One JSON array document per region, written below ``n_regionkey=value``."""
    path = lake.work_dir("index")
    nations = lake.table("nation").select("n_regionkey", "n_nationkey", "n_name")
    documents = files.json_array_documents(nations, ["n_regionkey"], ["n_nationkey"])
    files.write_index_documents(documents, path, ["n_regionkey"])
    return lake.spark.read.text(path).select("n_regionkey", "part", F.col("value").alias("document"))


@query("SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def materialize_roundtrip(lake: Lake) -> DataFrame:
    totals = lake.table("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    return files.materialize(totals, lake.work_dir("materialized"))


@query("SELECT key, value FROM region_table")
def result_table_upsert(lake: Lake) -> DataFrame:
    """The changes of each week as one batch of a result table."""
    path = lake.work_dir("table")
    events = lake.events.select(F.col("event_id").alias("offset"), F.weekofyear("ts").alias("week"))
    changes = lake.region_changes.join(events, "offset")
    first, last = changes.agg(F.min("week"), F.max("week")).first()
    for batch, week in enumerate(range(first, last + 1)):
        changelog.append_changes(changes.filter(F.col("week") == week), path, batch, "key", "value", "offset")
    return changelog.read_current(lake.spark, path, "key", "value", "offset")


def _batches(lake: Lake) -> tuple[str, str]:
    """Metric history as two batches (January 1-10 and 11-20) and a staging folder from the 16th on."""
    root = lake.work_dir("history")
    history = lake.metric_history
    day = F.dayofmonth("Timestamp")
    for start, end in ((1, 10), (11, 20)):
        rows = history.filter(day.between(start, end))
        last_second = F.unix_timestamp(F.max("Timestamp"))
        name = rows.agg(encode_reversed_key(last_second)).first()[0]
        rows.write.parquet(f"{root}/data/{name}")
    staged = history.filter(day >= 16)
    staged.write.parquet(f"{root}/to_process/a")
    staged.filter(F.col("Data") > 100).write.parquet(f"{root}/to_process/b")
    return f"{root}/data", f"{root}/to_process"


@query('SELECT min("RowKey") AS "RowKey" FROM metric_history WHERE day("Timestamp") >= 11')
def high_water_mark(lake: Lake) -> DataFrame:
    """Smallest row key over the newest batch and the staged rows."""
    base, staging = _batches(lake)
    path = lake.work_dir("mark")
    history_plan.save_high_water_mark(lake.spark, base, staging, path)
    return files.read_high_water_mark(lake.spark, path, "RowKey")


@query(
    """SELECT "PartitionKey", "RowKey", "Data", day("Timestamp") <= 20 AS old FROM (
        SELECT DISTINCT "PartitionKey", "RowKey", "Data", "Type", "Timestamp" FROM metric_history
        WHERE day("Timestamp") > 20)"""
)
def incremental_process(lake: Lake) -> DataFrame:
    """Staged rows minus the newest batch, appended as a batch of their own; a second run adds nothing.

    An earlier run ended right after its commit: its batch is pending and its files are in no ledger.
    """
    base, staging = _batches(lake)
    listed = lake.work_dir("ledger")
    crashed = history_plan.prepare(lake.spark, staging, base, listed)
    history_plan.commit_log(lake.spark, listed).commit(1, crashed)
    name = history_plan.process_staging(lake.spark, staging, base, listed)
    again = history_plan.process_staging(lake.spark, staging, base, listed)
    assert again is None
    rows = lake.spark.read.parquet(f"{base}/{name}")
    return rows.select("PartitionKey", "RowKey", "Data", (F.dayofmonth("Timestamp") <= 20).alias("old"))


@query("SELECT event_id, event_type FROM ev WHERE event_type IN ('view', 'error')")
def staging_unprocessed(lake: Lake) -> DataFrame:
    """Rows of staged files that no earlier run recorded."""
    root = lake.work_dir("staging")
    events = lake.events.select("event_id", "event_type")
    late = F.col("event_type").isin("view", "error")
    events.filter(~late).write.parquet(f"{root}/files")
    first_run = ledger.staged_files(read_parquet_tree(lake.spark, f"{root}/files"))
    ledger.record_processed(first_run, f"{root}/ledger")
    events.filter(late).write.mode("append").parquet(f"{root}/files")
    staged = ledger.staged_files(read_parquet_tree(lake.spark, f"{root}/files"))
    return ledger.unprocessed(staged, ledger.read_ledger(lake.spark, f"{root}/ledger")).select("event_id", "event_type")
