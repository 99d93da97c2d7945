"""Intermediate tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import work_dir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's modules to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")  # only the driver reads it
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table once below ``spark.checkpoint.dir`` and go on from its files.

    Cuts lineage, and survives the loss of executors: readers find the files in the shared
    folder, and a failed task writes only its own part again.
    """
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
