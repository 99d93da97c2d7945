"""Incremental batches: runs that end early, collide or overlap add each row once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telemetry_lake.plans import metric_history
from telemetry_lake.sinks.commits import CommitLog, Files
from telemetry_lake.sinks.files import read_high_water_mark

HISTORY = "PartitionKey string, RowKey string, Data double"


@pytest.fixture
def lake(spark, tmp_path):
    base, staging, ledger = (str(tmp_path / n) for n in ("data", "to_process", "ledger"))
    spark.createDataFrame([("a", "300", 1.0)], HISTORY).write.parquet(f"{base}/300")
    return base, staging, ledger


def stage(spark, staging, *keys):
    for k in keys:
        spark.createDataFrame([("p", k, float(len(k)))], HISTORY).coalesce(1).write.mode("append").parquet(f"{staging}/{k}")


def stored(spark, base) -> list[str]:
    """Keys in all batches as any reader of the lake sees them."""
    names = metric_history.batch_names(spark, base)
    assert spark.read.option("recursiveFileLookup", "true").parquet(base).count() == spark.read.parquet(*[f"{base}/{n}" for n in names]).count()
    return sorted(r["RowKey"] for n in names for r in spark.read.parquet(f"{base}/{n}").collect())


class Crash(Exception):
    pass


def ended(*_):
    raise Crash


#: Where a run may end: before its commit, after it, after the batch appeared, after the ledger was written.
POINTS = {"commit": (CommitLog, "commit"), "publish": (Files, "rename"), "ledger": (metric_history, "record_processed"), "finish": (CommitLog, "finish"), "clean": (Files, "remove")}


@pytest.mark.parametrize("point", list(POINTS))
def test_crash_then_a_new_file(spark, lake, monkeypatch, point):
    base, staging, ledger = lake
    stage(spark, staging, "400", "410")
    owner, name = POINTS[point]
    usual, calls = getattr(owner, name), []

    def fails(*args):
        calls.append(args)
        # The first rename is that of the commit itself.
        if len(calls) > (point == "publish"):
            raise Crash
        return usual(*args)

    with monkeypatch.context() as m:
        m.setattr(owner, name, fails)
        with pytest.raises(Crash):
            metric_history.process_staging(spark, staging, base, ledger)
    stage(spark, staging, "420")
    metric_history.process_staging(spark, staging, base, ledger)
    assert stored(spark, base) == ["300", "400", "410", "420"]
    assert metric_history.process_staging(spark, staging, base, ledger) is None
    assert stored(spark, base) == ["300", "400", "410", "420"]
    metric_history.sweep(spark, base, ledger)
    assert Files(spark, base).names(metric_history.PENDING) == []


def test_partial_write_is_no_batch(spark, lake, monkeypatch):
    base, staging, ledger = lake
    stage(spark, staging, "400")
    entry = metric_history.prepare(spark, staging, base, ledger)
    half = f"{base}/{entry['pending']}/rows"
    spark.createDataFrame([("half", "100", 0.0)], HISTORY).write.mode("append").parquet(half)
    assert metric_history.newest_batch(spark, base) == "300"
    assert metric_history.process_staging(spark, staging, base, ledger) == "400"
    assert stored(spark, base) == ["300", "400"]
    assert metric_history.sweep(spark, base, ledger) == [entry["pending"]]


def test_two_runs_at_once(spark, lake, monkeypatch):
    """Another run commits the same files while this one prepares its batch."""
    base, staging, ledger = lake
    stage(spark, staging, "400", "410")
    usual, others = metric_history.prepare, []

    def prepare(*args):
        entry = usual(*args)
        if not others:
            others.append(True)
            others.append(metric_history.process_staging(spark, staging, base, ledger))
        return entry

    monkeypatch.setattr(metric_history, "prepare", prepare)
    assert metric_history.process_staging(spark, staging, base, ledger) is None
    assert others[1] == "400" and stored(spark, base) == ["300", "400", "410"]


def test_names_that_are_taken_and_rows_without_key(spark, lake):
    base, staging, ledger = lake
    stage(spark, staging, "300")
    name = metric_history.process_staging(spark, staging, base, ledger)
    assert name.startswith("300-")
    spark.createDataFrame([("p", None, 1.0)], HISTORY).write.parquet(f"{staging}/none")
    assert metric_history.process_staging(spark, staging, base, ledger) == metric_history.NO_KEY
    assert spark.read.parquet(f"{base}/{metric_history.NO_KEY}").count() == 1
    # Known rows in a new file: no batch, but the file is not looked at again.
    spark.createDataFrame([("a", "300", 1.0)], HISTORY).write.parquet(f"{staging}/again")
    assert metric_history.process_staging(spark, staging, base, ledger, "all") is None
    assert metric_history.prepare(spark, staging, base, ledger) is None


def test_mark_needs_no_lake_and_no_rows_of_a_batch(spark, tmp_path):
    base, staging, ledger, mark = (str(tmp_path / n) for n in ("data", "to_process", "ledger", "mark"))
    metric_history.save_high_water_mark(spark, base, staging, mark)
    assert read_high_water_mark(spark, mark, "RowKey").count() == 0
    stage(spark, staging, "700", "650")
    metric_history.save_high_water_mark(spark, base, staging, mark)
    assert read_high_water_mark(spark, mark, "RowKey").first()["RowKey"] == "650"
    assert metric_history.process_staging(spark, staging, base, ledger) == "650"
    metric_history.save_high_water_mark(spark, base, str(tmp_path / "nothing"), mark)
    assert read_high_water_mark(spark, mark, "RowKey").first()["RowKey"] == "650"
    # The batch's own note is enough: its data may be unreadable.
    for file in Files(spark, base).names("650", folders=False):
        if file.endswith(".parquet"):
            Files(spark, base).write(f"650/{file}", "x")
    metric_history.save_high_water_mark(spark, base, str(tmp_path / "nothing"), mark)
    assert read_high_water_mark(spark, mark, "RowKey").first()["RowKey"] == "650"


def test_commits_are_exclusive(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.last() == 0 and log.commits() == [] and log.open() == []
    assert log.commit(1, {"a": 1}) and not log.commit(1, {"a": 2}) and log.commit(2, {"a": "é"})
    log.finish(1)
    assert [(c.number, c.entry, c.done) for c in log.commits()] == [(1, {"a": 1}, True), (2, {"a": "é"}, False)]
    assert [c.number for c in log.commits(since=1)] == [2] == [c.number for c in log.open()]
    assert all(n.endswith((".json", ".done")) for n in log.files.names())
