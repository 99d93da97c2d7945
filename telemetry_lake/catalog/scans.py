"""Sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import current_table
from ..plans import compaction
from ..sinks.files import write_folders
from ..sources import files
from ..streaming.io import file_records, to_files
from .registry import query
from .views import Lake


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet(lake: Lake) -> DataFrame:
    return files.read_parquet(lake.spark, lake.path("nation")).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT event_id, user_id, event_type, value FROM ev")
def scan_multi_path(lake: Lake) -> DataFrame:
    """Events split into a base dump and an increment folder below it."""
    root = lake.work_dir("multi") + "/data"
    events = lake.events.select("event_id", "user_id", "event_type", "value")
    increment = F.col("event_type").isin("signup", "error")
    events.filter(~increment).write.parquet(root)
    events.filter(increment).write.parquet(f"{root}/increment")
    return files.read_parquet_tree(lake.spark, root)


def _event_lines(lake: Lake) -> DataFrame:
    """Events as JSON text; error events are cut off."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "k"))
    whole = F.col("event_type") != "error"
    return lake.events.select(F.when(whole, line).otherwise(F.substring(line, 1, 12)).alias("value"))


@query(
    """SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
        CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
        CASE WHEN event_type <> 'error' THEN value END AS value, event_type = 'error' AS corrupt
    FROM ev"""
)
def scan_json_permissive(lake: Lake) -> DataFrame:
    """JSON lines under an explicit schema; unreadable lines become nulls and are marked."""
    path = lake.work_dir("json")
    _event_lines(lake).write.text(path)
    schema = "event_id bigint, event_type string, value double, _corrupt_record string"
    rows = files.read_json(lake.spark, path, schema)
    return rows.select("event_id", "event_type", "value", F.col("_corrupt_record").isNotNull().alias("corrupt"))


@query("SELECT event_id, user_id, event_type, value, CAST(k AS BIGINT) AS k FROM ev")
def scan_json_inferred(lake: Lake) -> DataFrame:
    path = lake.work_dir("json")
    lake.events.select("event_id", "user_id", "event_type", "value", "k").write.json(path)
    return files.read_json(lake.spark, path)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def scan_csv_header(lake: Lake) -> DataFrame:
    path = lake.work_dir("csv")
    lake.table("customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).csv(path)
    return files.read_csv_header(lake.spark, path)


@query(
    r"""SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name,
        CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment
    FROM customer"""
)
def scan_text_nulls(lake: Lake) -> DataFrame:
    r"""Headerless text where ``\N`` and empty fields are null."""
    path = lake.work_dir("text")
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name")).otherwise(r"\N")
    segment = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).otherwise("")
    lake.table("customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), name, segment)).write.text(path)
    return files.read_text_nulls(lake.spark, path, "c_custkey bigint, c_name string, segment string")


def write_coverage(lake: Lake, path: str) -> None:
    """The beam polygons as GeoJSON, one feature collection per beam."""
    pairs = F.transform("polygon", lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), pairs.alias("coordinates")).alias("geometry"),
        F.create_map(
            F.lit("Beam Info"), F.col("beam"),
            F.lit("FWD_CN (dB)"), (F.col("n_nationkey") / 2).cast("string"),
            F.lit("Efficiency"), F.col("n_nationkey").cast("string"),
        ).alias("properties"),
    )
    collections = lake.beam_polygons.groupBy("beam").agg(F.collect_list(feature).alias("features"))
    document = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"), {"pretty": "true"})
    collections.select("beam", document.alias("value")).write.partitionBy("beam").text(path)


COVERAGE = {"fwd_cn": "FWD_CN (dB)", "efficiency": "Efficiency", "CoverageBeamName": "Beam Info", "modem": "Modem"}


@query(
    """SELECT beam AS "CoverageBeamName", CAST(n_nationkey AS VARCHAR) AS efficiency,
        CAST(n_nationkey / 2.0 AS DOUBLE) AS fwd_cn, CAST(NULL AS VARCHAR) AS modem, CAST(6 AS INTEGER) AS corners,
        min(x1) AS min_x, max(y1) AS max_y
    FROM polygon_edges GROUP BY beam, n_nationkey"""
)
def scan_geojson(lake: Lake) -> DataFrame:
    path = lake.work_dir("geojson")
    write_coverage(lake, path)
    features = files.read_geojson(lake.spark, path, COVERAGE)
    ring = F.col("polygon")[0]
    return features.select(
        "CoverageBeamName",
        "efficiency",
        F.col("fwd_cn").cast("double").alias("fwd_cn"),
        "modem",
        F.size(ring).alias("corners"),
        F.array_min(F.transform(ring, lambda p: p["x"])).alias("min_x"),
        F.array_max(F.transform(ring, lambda p: p["y"])).alias("max_y"),
    )


@query('SELECT "ASMSerial", "timestamp-S", altitude FROM device_metrics')
def path_serial_column(lake: Lake) -> DataFrame:
    """Device metrics below ``<root>/<serial>/``, the serial taken from the path."""
    root = lake.work_dir("devices")
    record = F.to_json(F.struct("timestamp-S", "altitude")).alias("record")
    write_folders(lake.device_metrics.select(F.col("ASMSerial").alias("serial"), record), root, "serial", "record")
    rows = files.read_json(lake.spark, root, "`timestamp-S` bigint, altitude double")
    return files.with_path_serial(rows, root)


@query("SELECT event_id, user_id, event_type, value FROM ev")
def stream_source(lake: Lake) -> DataFrame:
    """Events read as a file stream and written through."""
    out = lake.work_dir("stream")
    events = file_records(lake.spark, lake.path("events") + "*", lake.table("events").schema)
    to_files(events.select("event_id", "user_id", "event_type", "value"), f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return lake.spark.read.parquet(f"{out}/data")


@query("SELECT key, value FROM region_table")
def table_latest_per_key(lake: Lake) -> DataFrame:
    return current_table(lake.region_changes, "key", "value", "offset")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_nationkey, c_acctbal FROM customer"""
)
def snapshot_ingest(lake: Lake) -> DataFrame:
    """A source table copied into the lake with its identifier as text."""
    columns = {"c_custkey": "string", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double"}
    return files.snapshot_ingest(lake.table("customer"), columns, lake.work_dir("snapshot"))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS "Id", CAST(o_custkey AS VARCHAR) AS "AccountId", o_orderstatus AS "Status",
        o_totalprice AS "Total" FROM orders"""
)
def snapshot_passed_through(lake: Lake) -> DataFrame:
    """A source table without a declared schema: every column, identifiers as text."""
    renamed = {"o_orderkey": "Id", "o_custkey": "AccountId", "o_orderstatus": "Status", "o_totalprice": "Total"}
    source = lake.table("orders").select(*[F.col(old).alias(new) for old, new in renamed.items()])
    return files.snapshot_ingest(source, files.passed_through(source), lake.work_dir("snapshot"))


@query()
def source_last_modified(lake: Lake) -> DataFrame:
    return files.last_modified(lake.table("customer"))


def write_self_tests(lake: Lake, root: str) -> None:
    """One pretty-printed self-test document per supplier; those in debt are cut off."""
    suite = F.struct(
        F.col("failures"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("name"),
        F.col("first").alias("start-time"),
        F.col("last").alias("stop-time"),
        F.col("tests"),
        F.col("time"),
        F.array(F.struct(F.lit("detail").alias("name"))).alias("testsuite"),
    )
    suites = (
        lake.table("lineitem")
        .groupBy("l_suppkey", "l_returnflag", "l_linestatus")
        .agg(
            F.count_if(F.col("l_discount") > 0.09).alias("failures"),
            F.min("l_shipdate").cast("date").cast("string").alias("first"),
            F.max("l_shipdate").cast("date").cast("string").alias("last"),
            F.count(F.lit(1)).alias("tests"),
            F.max("l_quantity").alias("time"),
        )
        .groupBy("l_suppkey")
        .agg(F.sort_array(F.collect_list(suite)).alias("testsuites"))
    )
    supplier = lake.table("supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    document = F.to_json(
        F.struct(
            F.concat(F.lit("ANT"), F.col("l_suppkey").cast("string")).alias("antenna-serial-number"),
            F.col("s_name").alias("customer"),
            (F.col("s_nationkey") % 2).cast("bigint").alias("status"),
            "testsuites",
        ),
        {"pretty": "true"},
    )
    documents = suites.join(supplier, "l_suppkey").select(
        F.concat(F.lit("AAE"), F.col("l_suppkey").cast("string")).alias("serial"), document.alias("d"), "s_acctbal"
    )
    cut = F.when(F.col("s_acctbal") < 0, F.substring("d", 1, 40)).otherwise(F.col("d"))
    write_folders(documents.select("serial", cut.alias("value")), root, "serial", "value")


@query(
    """SELECT 'AAE' || l_suppkey AS "ASMSerial", 'ANT' || l_suppkey AS antenna, s_name AS customer,
        CAST(s_nationkey % 2 AS BIGINT) AS status, l_returnflag || '-' || l_linestatus AS name,
        count(*) FILTER (WHERE l_discount > 0.09) AS failures, count(*) AS tests,
        CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS start_time, max(l_quantity) AS time
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0
    GROUP BY l_suppkey, s_name, s_nationkey, l_returnflag, l_linestatus"""
)
def scan_json_dropmalformed(lake: Lake) -> DataFrame:
    """Multi-line documents under a pruned schema; unreadable ones are dropped."""
    root = lake.work_dir("selftest")
    write_self_tests(lake, root)
    return flat_suites(compaction.self_test_table(lake.spark, root))


def flat_suites(tests: DataFrame) -> DataFrame:
    return tests.select(
        "ASMSerial", F.col("antenna-serial-number").alias("antenna"), "customer", "status", F.explode("testsuites").alias("s")
    ).select(
        "ASMSerial", "antenna", "customer", "status", "s.name", "s.failures", "s.tests",
        F.col("s.start-time").alias("start_time"), "s.time",
    )
