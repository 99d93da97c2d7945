"""Raw JSON trees to parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.reshape import rename_columns, try_cast_columns
from ..schemas import CHAMBER, QUOTED_METRICS, SELF_TEST, device_metrics
from ..sinks.files import compact_parquet
from ..sources.files import read_json, with_path_serial


def device_metrics_table(spark: SparkSession, root: str) -> DataFrame:
    """Metrics of all devices below ``root/<serial>/``: serial added, columns renamed, quoted numbers cast."""
    raw = with_path_serial(read_json(spark, root, device_metrics()), root)
    return try_cast_columns(rename_columns(raw, QUOTED_METRICS), list(QUOTED_METRICS.values()))


def load_device_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The compacted table under its original column names."""
    return rename_columns(spark.read.parquet(path), {new: old for old, new in QUOTED_METRICS.items()})


def self_test_table(spark: SparkSession, root: str, schema: str = SELF_TEST) -> DataFrame:
    """Self-test documents of all devices, one per file; unreadable ones are dropped."""
    return with_path_serial(read_json(spark, root, schema, "DROPMALFORMED", multiline=True), root)


def chamber_table(spark: SparkSession, root: str, more: str = "") -> DataFrame:
    """Chamber measurements under the declared schema, so that differing files still line up.

    ``more`` declares further fields, such as a site's own version stamps (``"lib_version string"``).
    """
    return read_json(spark, root, f"{CHAMBER}, {more}" if more else CHAMBER)


def compact(table: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write a table compactly and read it back; ``files`` fixes the number of files."""
    compact_parquet(table, path, files)
    return table.sparkSession.read.parquet(path)
