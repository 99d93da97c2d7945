"""Streams against tables that change while they run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telemetry_lake.sinks.changelog import read_current
from telemetry_lake.streaming import io, tables

CHANGES = "key string, value string, offset long"


def add(spark, path, rows, schema=CHANGES):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("how, want", [("inner", {"a": "l2/r2"}), ("left", {"a": "l2/r2", "b": "l3/null"}), ("full", {"a": "l2/r2", "b": "l3/null", "c": "null/r4"})])
def test_table_join_with_offsets_of_their_own(spark, tmp_path, how, want):
    """The left offsets are far above the right ones: later changes on the right still count."""
    left, right, out = (str(tmp_path / n) for n in ("left", "right", "out"))
    rounds = [
        ([("a", "l1", 1000), ("b", "l1", 1001), ("d", "l1", 1002)], [("a", "r1", 1), ("c", "r1", 2), ("d", "r1", 3)]),
        ([], [("a", "r2", 4), ("a", "old", 0), ("d", None, 5)]),
        ([("a", "l2", 1003), ("b", "l3", 1004), ("d", None, 1005)], []),
        ([], [("c", "r3", 6), ("c", "r4", 7)]),
    ]
    io.use_rocksdb(spark)
    for l_rows, r_rows in rounds:
        add(spark, left, l_rows)
        add(spark, right, r_rows)
        joined = tables.join_table_streams(io.file_records(spark, left, CHANGES), io.file_records(spark, right, CHANGES), how)
        with io.state_partitions(spark, 2):
            io.to_table(joined, f"{out}/table", f"{out}/checkpoint", "key", "value", "offset", mode="update").awaitTermination()
    got = {r["key"]: r["value"] for r in read_current(spark, f"{out}/table", "key", "value", "offset").collect()}
    assert got == want


def test_no_python_in_the_state(spark, tmp_path):
    for side in ("l", "r"):
        add(spark, str(tmp_path / side), [("a", "x", 1)])
    joined = tables.join_table_streams(*(io.file_records(spark, str(tmp_path / s), CHANGES) for s in ("l", "r")))
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Pandas" not in plan and "Python" not in plan


@pytest.mark.parametrize("most_bytes, sent", [(io.BROADCAST_BYTES, True), (0, False)])
def test_lookup_changed_between_micro_batches(spark, tmp_path, most_bytes, sent):
    table, records, out = (str(tmp_path / n) for n in ("table", "records", "out"))
    seen = []

    def look_up(batch):
        names = io.live_lookup(batch.sparkSession, table, most_bytes)
        joined = batch.join(names, "key", "left").select("key", "n", "name")
        seen.append("broadcast" in joined._jdf.queryExecution().logical().toString().lower())
        return joined

    for n, name in enumerate(["first", "second", "third"]):
        spark.createDataFrame([("a", name)], "key string, name string").write.mode("overwrite").parquet(table)
        add(spark, records, [("a", n)], "key string, n long")
        stream = io.file_records(spark, records, "key string, n long")
        io.lookup_to_files(stream, look_up, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    got = {r["n"]: r["name"] for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == {0: "first", 1: "second", 2: "third"} and set(seen) == {sent}
