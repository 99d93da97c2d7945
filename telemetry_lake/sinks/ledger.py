"""Consume every staged file once.

Instead of deleting staged files after a write, which a crash in between would undo,
their names go into a ledger; a run takes only files the ledger does not list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SOURCE_FILE = "source_file"


def staged_files(staging: DataFrame) -> DataFrame:
    """A scan of the staging folder with the file of each row."""
    return staging.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def unprocessed(staged: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of files that are not in the ledger."""
    return staged.join(ledger.select(SOURCE_FILE), SOURCE_FILE, "left_anti")


def record_processed(rows: DataFrame, ledger_path: str) -> None:
    """Append the files of ``rows`` to the ledger; call it after the rows were written."""
    rows.select(SOURCE_FILE).distinct().write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger, which starts out empty."""
    spark.createDataFrame([], f"{SOURCE_FILE} string").write.mode("ignore").parquet(ledger_path)
    return spark.read.schema(f"{SOURCE_FILE} string").parquet(ledger_path)
