"""Rows after their time."""

from __future__ import annotations

import datetime as dt

import pytest

from telemetry_lake.streaming import io, late

ROWS = "id long, ts timestamp"
DAY = dt.datetime(2024, 1, 1)


def deliver(spark, path, out, rows, delay=dt.timedelta(hours=1), write=True):
    stamped = [(n, None if h is None else DAY + dt.timedelta(hours=h)) for n, h in rows]
    if write:
        spark.createDataFrame(stamped, ROWS).coalesce(1).write.mode("append").parquet(path)
    stream = io.file_records(spark, path, ROWS)
    late.split_late(stream, "ts", delay, f"{out}/rows", f"{out}/checkpoint").awaitTermination()


def split(spark, out):
    rows = late.read_split(spark, f"{out}/rows", spark.createDataFrame([], ROWS).schema)
    return {r["id"]: (r["batch"], r["late"]) for r in rows.collect()}


def test_late_by_the_micro_batches_before(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, path, out, [(1, 10), (2, 2), (3, None)])
    deliver(spark, path, out, [(4, 9), (5, 8.999), (6, 20), (7, 0)])
    deliver(spark, path, out, [(8, 18.9), (9, 19), (10, None), (11, 5)])
    # The first knows no time before it; exactly the delay is in time; a lower micro-batch lowers nothing.
    assert split(spark, out) == {
        1: (0, False), 2: (0, False), 3: (0, False), 4: (1, False), 5: (1, True), 6: (1, False), 7: (1, True),
        8: (2, True), 9: (2, False), 10: (2, False), 11: (2, True),
    }
    rows = late.read_split(spark, f"{out}/rows", spark.createDataFrame([], ROWS).schema)
    assert {tuple(r) for r in late.lateness(rows, "batch").collect()} == {(0, 3, 0), (1, 2, 2), (2, 2, 2)}


def test_micro_batches_without_times(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, path, out, [(1, None)])
    deliver(spark, path, out, [(2, 10)])
    deliver(spark, path, out, [(3, None)])
    deliver(spark, path, out, [(4, 1)])
    assert split(spark, out) == {1: (0, False), 2: (1, False), 3: (2, False), 4: (3, True)}


def test_a_replayed_micro_batch_overwrites_itself(spark, tmp_path, monkeypatch):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, path, out, [(1, 10)])
    with monkeypatch.context() as m:
        # The run ends after the rows were written, before their highest time was.
        m.setattr(late.Files, "write", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(Exception, match="gone"):
            deliver(spark, path, out, [(2, 30), (3, 1)])
    deliver(spark, path, out, [], write=False)
    deliver(spark, path, out, [(4, 28)])
    assert split(spark, out) == {1: (0, False), 2: (1, False), 3: (1, True), 4: (2, True)}
