"""Folded change logs: as many runs as there are levels allow, and the same table."""

from __future__ import annotations

import random

import pytest

from telemetry_lake.sinks import changelog
from telemetry_lake.sinks.commits import CommitLog, Files

CHANGES = "key string, value string, offset long"


def current(spark, path):
    return {r["key"]: r["value"] for r in changelog.read_current(spark, path, "key", "value", "offset").collect()}


def test_runs_stay_few_and_the_table_the_same(spark, tmp_path):
    path, chance, want, most = str(tmp_path / "log"), random.Random(1), {}, 0
    for batch in range(30):
        rows = [(f"k{chance.randrange(12)}", chance.choice([None, f"v{batch}", f"w{batch}"]), 10 * batch + i) for i in range(5)]
        changelog.append_changes(spark.createDataFrame(rows, CHANGES).coalesce(1), path, batch, "key", "value", "offset")
        changelog.fold_levels(spark, path, "key", "offset", fold=3)
        for k, v, _ in rows:
            want[k] = v
        most = max(most, len(changelog.live_runs(spark, path)))
    # Up to three batches (one of them the newest), and two runs on each further level.
    assert most <= 10 and current(spark, path) == {k: v for k, v in want.items() if v is not None}
    # What was replaced is gone, but for the last commit's.
    lake = Files(spark, path)
    live = {r.rsplit(path + "/", 1)[1] for r in changelog.live_runs(spark, path)}
    log = CommitLog(spark, f"{path}/{changelog.FOLDS}")
    there = {n for n in lake.names(folders=True) if n.startswith("batch=")} | {f"{changelog.FOLDS}/{n}" for n in lake.names(changelog.FOLDS, folders=True)}
    assert live <= there and there - live <= set(log.read(log.last())["replaced"])


def test_newest_batch_may_be_written_again(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch in range(4):
        changelog.append_changes(spark.createDataFrame([("a", f"v{batch}", batch)], CHANGES), path, batch, "key", "value", "offset")
        changelog.fold_levels(spark, path, "key", "offset", fold=3)
    assert len(changelog.live_runs(spark, path)) == 2
    changelog.append_changes(spark.createDataFrame([("a", "again", 3)], CHANGES), path, 3, "key", "value", "offset")
    assert current(spark, path) == {"a": "again"}


def test_a_fold_that_was_not_committed_does_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for batch in range(4):
        changelog.append_changes(spark.createDataFrame([(f"k{batch}", "v", batch)], CHANGES), path, batch, "key", "value", "offset")
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *_: False)
        changelog.fold_levels(spark, path, "key", "offset", fold=3)
    assert changelog.live_runs(spark, path) == [path]
    assert current(spark, path) == {f"k{b}": "v" for b in range(4)}


def test_lookup_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    path, plain, chance = str(tmp_path / "log"), str(tmp_path / "plain"), random.Random(2)
    changelog.create_log(spark, path, CHANGES, buckets=16)
    changelog.create_log(spark, path, CHANGES, buckets=16)
    for batch in range(9):
        rows = [(f"k{chance.randrange(200)}", chance.choice([None, f"v{batch}"]), 100 * batch + i) for i in range(60)]
        for log in (path, plain):
            changelog.append_changes(spark.createDataFrame(rows, CHANGES), log, batch, "key", "value", "offset")
            changelog.fold_levels(spark, log, "key", "offset", fold=3)
    want = current(spark, plain)
    assert current(spark, path) == want
    wanted = spark.createDataFrame([("k3",), ("k7",), ("k3",), ("k5000",), (None,)], "key string")
    found = changelog.current_of(wanted, path, "key", "value", "offset").collect()
    assert {r["key"]: r["value"] for r in found} == {k: v for k, v in want.items() if k in ("k3", "k7")}
    assert set(changelog.changes_of(wanted, path, "key").columns) == {"key", "value", "offset"}
    # Nothing else is opened: files of other buckets may hold anything.
    layout = changelog._layout(spark, path)
    met = {r[0] for r in wanted.select(changelog._bucket("key", layout)).collect()}
    others = [f for f in (tmp_path / "log").rglob("bucket=*/*") if int(f.parent.name[7:]) not in met]
    assert len(met) <= 4 and others
    for file in others:
        file.write_bytes(b"no parquet")
    found = changelog.current_of(wanted, path, "key", "value", "offset").collect()
    assert {r["key"]: r["value"] for r in found} == {k: v for k, v in want.items() if k in ("k3", "k7")}


def test_bucketed_log_without_changes(spark, tmp_path):
    path = str(tmp_path / "log")
    changelog.create_log(spark, path, CHANGES)
    changelog.append_changes(spark.createDataFrame([], CHANGES), path, 0, "key", "value", "offset")
    wanted = spark.createDataFrame([("a",)], "key string")
    assert changelog.current_of(wanted, path, "key", "value", "offset").count() == 0
    changelog.append_changes(spark.createDataFrame([("a", "v", 1), (None, "n", 2)], CHANGES), path, 1, "key", "value", "offset")
    assert [tuple(r) for r in changelog.current_of(wanted, path, "key", "value", "offset").collect()] == [("a", "v")]
    nobody = spark.createDataFrame([], "key string")
    assert changelog.current_of(nobody, path, "key", "value", "offset").count() == 0
    assert {r["key"] for r in changelog.read_current(spark, path, "key", "value", "offset").collect()} == {"a", None}
    with pytest.raises(ValueError, match="number of buckets"):
        changelog.create_log(spark, path, CHANGES, buckets=2)


def test_bucketed_log_folded_into_a_new_one(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    changelog.create_log(spark, old, CHANGES, buckets=4)
    for batch in range(3):
        changelog.append_changes(spark.createDataFrame([("a", f"v{batch}", batch), (f"b{batch}", "x", batch)], CHANGES), old, batch, "key", "value", "offset")
    changelog.fold_changes(spark, old, new, "key", "offset")
    assert current(spark, new) == current(spark, old) == {"a": "v2", "b0": "x", "b1": "x", "b2": "x"}
    assert set(changelog.read_changes(spark, old).columns) == {"key", "value", "offset", "batch"}
