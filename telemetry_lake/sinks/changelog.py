"""Result tables kept as a log of changes.

Every batch appends only its own latest value per key, under its batch number, so the cost
follows the changes and a replayed batch overwrites itself. Reading takes the latest
change per key; null values delete.

A log that grows is folded in levels: :data:`FOLD` neighbouring runs of a level become one run of the next,
which keeps the latest change per key. Each change is rewritten once per level, and a reader opens at
most :data:`FOLD` runs of each. A commit switches readers over to the new run; the runs it replaces
are removed with the commit after, so that a reader that began before it ends in peace.

A log made by :func:`create_log` is cut into buckets of keys, a folder each in every run, sorted by key. Who
looks up some keys (:func:`current_of`) opens the folders of their buckets only.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.joins import current_table, latest_per_key, with_key_in
from .commits import CommitLog, Files

#: Runs of a level that become one.
FOLD = 8
FOLDS = "_folds"


LAYOUT = "_layout.json"
#: Buckets of a log unless its maker says otherwise.
BUCKETS = 64


def create_log(spark: SparkSession, path: str, schema: T.StructType | str, buckets: int = BUCKETS) -> None:
    """Make a log of changes ``schema`` in ``buckets``, which stay for its life; nothing happens if it exists.

    Many buckets make a lookup of few keys cheap and a batch of many keys many files.
    """
    lake = Files(spark, path)
    columns = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if not lake.exists(LAYOUT):
        lake.make()
        draft = f"_{uuid.uuid4().hex}"
        lake.write(draft, json.dumps({"buckets": buckets, "schema": columns.jsonValue()}))
        if not lake.rename(draft, LAYOUT):
            lake.remove(draft)
    if _layout(spark, path)["buckets"] != buckets:
        raise ValueError(f"the log at {path} has another number of buckets than {buckets}")


def _layout(spark: SparkSession, path: str) -> dict | None:
    lake = Files(spark, path)
    return json.loads(lake.read(LAYOUT)) if lake.exists(LAYOUT) else None


def _bucket(key: str, layout: dict) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(layout["buckets"])).cast("int").alias("bucket")


def _write_run(changes: DataFrame, path: str, key: str, layout: dict | None, mode: str = "errorifexists") -> None:
    if layout is None:
        changes.write.mode(mode).parquet(path)
        return
    placed = changes.select("*", _bucket(key, layout)).hint("rebalance", "bucket").sortWithinPartitions("bucket", key)
    placed.write.mode(mode).partitionBy("bucket").parquet(path)


def _read_runs(spark: SparkSession, runs: list[str], layout: dict | None) -> DataFrame:
    """Changes of the runs; those of a log in buckets with the column ``bucket``."""
    if layout is None:
        return spark.read.parquet(*runs).drop("batch")
    schema = T.StructType.fromJson(layout["schema"]).add("bucket", T.IntegerType())
    # Runs lie at different depths, which partition discovery does not allow within one scan.
    return reduce(DataFrame.union, [spark.read.schema(schema).parquet(run) for run in runs]).drop("batch")


def append_changes(changes: DataFrame, path: str, batch: int, key: str, value: str, offset: str) -> None:
    reduced = latest_per_key(changes.select(key, value, offset), key, offset)
    _write_run(reduced, f"{path}/batch={batch}", key, _layout(changes.sparkSession, path), "overwrite")


def read_current(spark: SparkSession, path: str, key: str, value: str, offset: str) -> DataFrame:
    return current_table(_read_runs(spark, live_runs(spark, path), _layout(spark, path)), key, value, offset)


def changes_of(wanted: DataFrame, path: str, key: str) -> DataFrame:
    """The logged changes of the keys that occur in ``wanted``, read from their buckets only.

    The driver learns which buckets these are, no more numbers than the log has buckets. ``wanted`` is
    read twice. A log without buckets is read whole.
    """
    spark = wanted.sparkSession
    layout = _layout(spark, path)
    log = _read_runs(spark, live_runs(spark, path), layout)
    if layout is not None:
        met = [r["bucket"] for r in wanted.select(_bucket(key, layout)).distinct().collect()]
        log = log.filter(F.col("bucket").isin(met)).drop("bucket")
    return with_key_in(log, wanted, key)


def current_of(wanted: DataFrame, path: str, key: str, value: str, offset: str) -> DataFrame:
    """:func:`read_current` for the keys that occur in ``wanted``; a null key finds nothing."""
    return current_table(changes_of(wanted, path, key), key, value, offset)


def _runs(spark: SparkSession, path: str) -> tuple[CommitLog, int, dict, list[dict]]:
    """The log of folds, its newest number and entry, and all runs in order: folded ones, then batches."""
    log = CommitLog(spark, f"{path.rstrip('/')}/{FOLDS}")
    last = log.last()
    entry = log.read(last) if last else {"upto": -1, "runs": [], "replaced": []}
    batches = sorted(int(n[6:]) for n in Files(spark, path).names(folders=True) if n.startswith("batch="))
    newer = [{"folder": f"batch={b}", "level": 0, "upto": b} for b in batches if b > entry["upto"]]
    return log, last, entry, [*entry["runs"], *newer]


def live_runs(spark: SparkSession, path: str) -> list[str]:
    """Paths that together hold the newest change of every key."""
    _, last, _, runs = _runs(spark, path)
    return [f"{path.rstrip('/')}/{r['folder']}" for r in runs] if last else [path]


def fold_levels(spark: SparkSession, path: str, key: str, offset: str, fold: int = FOLD) -> None:
    """Fold what has become foldable; to be called after each batch.

    The newest batch is left out, as a restarted stream may write it again. Two callers at once do not
    harm: only one of them commits.
    """
    lake, layout = Files(spark, path), _layout(spark, path)
    while True:
        log, last, entry, runs = _runs(spark, path)
        settled = runs if runs and runs[-1]["folder"].startswith(FOLDS) else runs[:-1]
        starts = [i for i in range(len(settled) - fold + 1) if len({r["level"] for r in settled[i : i + fold]}) == 1]
        if not starts:
            return
        old = settled[starts[0] : starts[0] + fold]
        into = f"{FOLDS}/{uuid.uuid4().hex}"
        changes = _read_runs(spark, [f"{lake.root}/{r['folder']}" for r in old], layout).drop("bucket")
        _write_run(latest_per_key(changes, key, offset), f"{lake.root}/{into}", key, layout)
        new = {"folder": into, "level": old[0]["level"] + 1, "upto": old[-1]["upto"]}
        kept = [*settled[: starts[0]], new, *settled[starts[0] + fold :]]
        if not log.commit(last + 1, {"upto": kept[-1]["upto"], "runs": kept, "replaced": [r["folder"] for r in old]}):
            lake.remove(into)
            return
        for folder in entry["replaced"]:
            lake.remove(folder)


def fold_changes(spark: SparkSession, path: str, into: str, key: str, offset: str) -> None:
    """Rewrite a log that has grown long as a single batch of a new log, deletions included."""
    log = spark.read.parquet(path).drop("batch", "bucket")
    _write_run(latest_per_key(log, key, offset), f"{into}/batch=0", key, _layout(spark, into), "overwrite")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The log itself, with the ``batch`` each change came in."""
    return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("bigint")).drop("bucket")
