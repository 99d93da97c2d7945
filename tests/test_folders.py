"""Trees of many small folders, written by tasks, against the ones ``partitionBy`` writes."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telemetry_lake.catalog.scans import path_serial_column
from telemetry_lake.catalog.views import Lake
from telemetry_lake.sinks.files import write_folders
from telemetry_lake.sources.files import LISTING_TASKS, read_json

ODD = ["AAE1", "dev 1", "a/b:c", "50%", "x=y", "q?*", "[]{}^'\\\"#", "tab\there", "é+ü", "", None]


def tree(root) -> dict[str, list[str]]:
    """The lines of each folder, in order."""
    found: dict[str, list[str]] = {}
    for file in Path(root).rglob("part-*"):
        found.setdefault(file.parent.name, []).extend(file.read_text().split("\n")[:-1])
    return {folder: sorted(lines) for folder, lines in found.items()}


def test_folders_are_those_of_partition_by(spark, tmp_path):
    names = spark.createDataFrame([(n, s) for n, s in enumerate(ODD)], "n int, serial string")
    rows = names.crossJoin(spark.range(300)).select(
        "serial", F.when(F.col("id") != 7, F.concat_ws("-", "n", "id", F.lit("ö\nnext"))).alias("line")
    )
    rows.write.partitionBy("serial").text(str(tmp_path / "spark"))
    # Small batches, so that a folder's lines come in several.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        write_folders(rows, str(tmp_path / "ours"), "serial", "line")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert tree(tmp_path / "ours") == tree(tmp_path / "spark")
    assert len(tree(tmp_path / "ours")) == len(ODD) - 1
    # One file per folder here, neither checksums nor unfinished files beside it.
    assert all(len(list(folder.iterdir())) == 1 for folder in (tmp_path / "ours").iterdir())
    with pytest.raises(FileExistsError):
        write_folders(rows, str(tmp_path / "ours"), "serial", "line")


def test_small_folders_stay_in_one_file(spark, tmp_path):
    """Though their partition would be split, as it holds more than the advisory size; a large folder is split."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("serial"),
        F.sha2(F.col("id").cast("string"), 256).alias("line"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256k")
    try:
        write_folders(rows, str(tmp_path / "tree"), "serial", "line")
    finally:
        spark.conf.unset(key)
    files = {folder.name: len(list(folder.iterdir())) for folder in (tmp_path / "tree").iterdir()}
    assert files.pop("serial=hot") > 1
    assert len(files) == 500 and sum(files.values()) < 520
    assert sum(map(len, tree(tmp_path / "tree").values())) == 60_000


def test_folders_without_rows_and_below_a_uri(spark, tmp_path):
    rows = spark.createDataFrame([("a", "{}")], "serial string, line string")
    write_folders(rows.filter("false"), f"file://{tmp_path}/none", "serial", "line")
    assert spark.read.schema("x int").json(f"file://{tmp_path}/none").collect() == []
    write_folders(rows, f"file://{tmp_path}/a b", "serial", "line")
    assert tree(tmp_path / "a b") == {"serial=a": ["{}"]}


def test_folders_on_another_file_system(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.folders.link./top", f"file://{tmp_path}")
    rows = spark.createDataFrame([("a", "{}"), (None, "x"), ("a", "y")], "serial string, line string")
    write_folders(rows, "viewfs://folders/top/tree", "serial", "line")
    assert tree(tmp_path / "tree") == {"serial=a": ["y", "{}"], "serial=__HIVE_DEFAULT_PARTITION__": ["x"]}


def test_device_files_have_no_checksum_files(spark, tmp_path):
    """Hadoop's local file system starts three processes per device, one of them for the checksum file."""
    day = F.lit("1995-01-02").cast("timestamp_ntz")
    spark.range(40).select(
        F.when(F.col("id") != 3, F.col("id") % 9).alias("l_suppkey"), day.alias("l_shipdate"),
        *[F.col("id").cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = path_serial_column(Lake(spark, str(tmp_path)))
    assert rows.count() == 40 and rows.select("ASMSerial").distinct().count() == 10
    assert rows.filter("ASMSerial = '__HIVE_DEFAULT_PARTITION__'").select("altitude").first()["altitude"] == 3
    files = [Path(f.removeprefix("file://")) for f in rows.inputFiles()]
    assert files and not [f for file in files for f in file.parent.glob(".*")]


def test_a_tree_is_listed_in_few_tasks(spark, tmp_path):
    """Not in one task per folder; the session's setting stays."""
    most = 2 * LISTING_TASKS * spark.sparkContext.defaultParallelism
    for n in range(most):
        (tmp_path / f"d{n}").mkdir()
        (tmp_path / f"d{n}" / "a.json").write_text('{"x": 1}\n')
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        rows = read_json(spark, str(tmp_path), "x int")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert [s.numTasks for s in stages] == [most // 2]
    assert rows.count() == most and spark.conf.get(key) == before
