"""Jobs end to end on files derived from the smallest tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from telemetry_lake import jobs
from telemetry_lake.catalog.scans import write_coverage, write_self_tests
from telemetry_lake.catalog.views import Lake
from telemetry_lake.schemas import SNAPSHOTS, snapshot_columns
from telemetry_lake.sources import files as sources


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, "/root/testdata/sf0.001")


@pytest.fixture
def stored(tmp_path):
    def store(name, df):
        path = str(tmp_path / name)
        df.write.parquet(path)
        return path

    return store


def test_reports(spark, lake, stored, tmp_path):
    out = str(tmp_path / "noc")
    tickets, tags, accounts = stored("tickets", lake.tickets), stored("tags", lake.tags), stored("accounts", lake.accounts)
    jobs.ticket_reports(spark, tickets, tags, out)
    jobs.account_reports(spark, tickets, tags, accounts, ".*7$", out)
    assert spark.read.json(f"{out}/breakdown-status-priority").count() == 3
    assert spark.read.json(f"{out}/tickets/last-20-created").count() == 20
    assert spark.read.json(f"{out}/ticket-stats").first()["Open"]["All"] > 0
    assert spark.read.json(f"{out}/wip-tickets").filter("Status = 'closed'").count() == 0
    listed = spark.read.json(f"{out}/account-list").select("AccountId").distinct().count()
    assert spark.read.json(f"{out}/by-account").select("AccountId").distinct().count() == listed
    assert spark.read.json(f"{out}/resolution-time-by-account").count() == listed
    jobs.index_documents(spark, f"{out}/by-account", "AccountId", "Number", f"{out}/index")
    documents = spark.read.text(f"{out}/index")
    assert documents.count() == listed
    assert isinstance(json.loads(documents.first()["value"]), list)


def test_rollup_trees(spark, lake, stored, tmp_path):
    out = str(tmp_path / "rollups")
    jobs.metric_rollups(spark, stored("metrics", lake.device_metrics), out)
    years, months = spark.read.json(f"{out}/yearly"), spark.read.json(f"{out}/monthly")
    assert years.agg(F.sum("records")).first() == months.agg(F.sum("records")).first()
    assert "duration" in years.columns and "duration" not in months.columns


def test_history_and_usage(spark, lake, stored, tmp_path):
    history, terminals, metrics = stored("history", lake.metric_history), stored("terminals", lake.terminals), stored("dictionary", lake.metrics)
    jobs.history_load(spark, history, terminals, metrics, str(tmp_path / "tidy"))
    assert spark.read.parquet(str(tmp_path / "tidy")).count() > 0
    lake.terminal_documents.write.json(str(tmp_path / "properties"))
    jobs.usage(spark, history, terminals, metrics, str(tmp_path / "properties"), stored("remotes", lake.remotes), str(tmp_path / "usage"))
    report = spark.read.json(str(tmp_path / "usage"))
    assert {"RemoteId", "RemoteSerial", "SI", "breakdown", "year", "month"} <= set(report.columns) and report.count() > 0

    ledger, base = str(tmp_path / "ledger"), str(tmp_path / "base")
    lake.metric_history.filter("Data < 0").write.parquet(f"{base}/9")
    jobs.history_process(spark, history, base, ledger)
    jobs.history_high_water_mark(spark, base, history, str(tmp_path / "mark"))
    smallest = lake.metric_history.agg(F.min("RowKey")).first()[0]
    assert spark.read.text(str(tmp_path / "mark")).first()[0] == smallest


def test_devices(spark, lake, stored, tmp_path):
    jobs.device_checkins(spark, stored("checkins", lake.checkins), str(tmp_path / "devices"))
    latest = spark.read.parquet(str(tmp_path / "devices/latest"))
    cleaned = spark.read.parquet(str(tmp_path / "devices/cleaned"))
    assert latest.count() == cleaned.select("ASMSerial").distinct().count()
    jobs.status_durations(spark, stored("activity", lake.activity), str(tmp_path / "durations"))
    assert spark.read.parquet(str(tmp_path / "durations")).count() > 0
    write_self_tests(lake, str(tmp_path / "raw"))
    jobs.compact_self_tests(spark, str(tmp_path / "raw"), str(tmp_path / "tests"))
    assert spark.read.parquet(str(tmp_path / "tests")).count() > 0


def test_signal(spark, lake, stored, tmp_path):
    clicks = lake.events.filter("event_type = 'click'").select(
        F.unix_timestamp("ts").alias("timestamp-S"), F.concat(F.lit("AAE"), "user_id").alias("ASMSerial"),
        F.col("value").alias("longitude"), F.col("k").cast("double").alias("latitude"), F.col("value").alias("pl-esno"),
        F.lit(1.0).alias("rx-theta"), F.lit(7).cast("bigint").alias("antenna-frequency-rx"),
    )
    devices = lake.table("customer").select(
        F.concat(F.lit("AAE"), "c_custkey").alias("AsmSerial"), (F.col("c_custkey") + 1000000).alias("ModemSerial")
    )
    events = lake.events.select(
        F.unix_timestamp("ts").alias("timestamp"), (F.col("user_id") + 1000000).alias("ModemSerial"),
        F.when(F.col("event_type") == "signup", 1698).otherwise(1098).alias("MetricInt"),
        F.when(F.col("event_type") == "signup", (F.col("k") % 25).cast("double")).otherwise(F.col("value")).alias("Data"),
    )
    lake.table("nation").select(
        F.col("n_nationkey").alias("BeamID"), F.col("n_name").alias("PulseBeamName"), F.concat(F.lit("B"), "n_regionkey").alias("FWD")
    ).write.option("header", True).csv(str(tmp_path / "beams"))
    write_coverage(lake, str(tmp_path / "coverage"))
    jobs.signal_quality(
        spark, stored("metrics", clicks), stored("devices", devices), stored("history", events), str(tmp_path / "beams"),
        str(tmp_path / "coverage"), "20", str(tmp_path / "out"),
    )
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() > 0 and "SNR (Pulse)" in rows.columns


def test_command_line(capsys):
    with pytest.raises(SystemExit, match="missing a required argument"):
        jobs.main(["usage", "history=x"])
    with pytest.raises(SystemExit):
        jobs.main([])
    assert "ticket_reports" in capsys.readouterr().out


def test_snapshot_schemas(spark):
    assert {name: len(snapshot_columns(name)) for name in SNAPSHOTS} == {"tickets": 18, "tags": 7, "subscriptions": 19}


def test_snapshot_of_an_undeclared_table(spark, tmp_path):
    rows = [(1, 2, "x", None, 1.5, 7), (None, None, None, True, None, None)]
    source = spark.createDataFrame(rows, "`Id` long, `RemoteID` int, `Name` string, `Paid` boolean, `a.b``c` double, `Grid` int")
    columns = sources.passed_through(source)
    assert columns == {"Id": "string", "RemoteID": "string", "Name": "string", "Paid": "boolean", "a.b`c": "double", "Grid": "int"}
    copy = sources.snapshot_ingest(source, columns, str(tmp_path / "copy"))
    assert dict(copy.dtypes) == columns
    assert sorted(map(tuple, copy.collect()), key=str) == sorted([("1", "2", "x", None, 1.5, 7), (None, None, None, True, None, None)], key=str)
    empty = sources.snapshot_ingest(source.limit(0), columns, str(tmp_path / "empty"))
    assert empty.count() == 0 and dict(empty.dtypes) == columns
