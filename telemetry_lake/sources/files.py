"""File scans. A whole tree is always one scan, however many devices lie in it."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import long_form
from ..schemas import GEOJSON

#: Most tasks that list the folders of a tree, per core; Spark's own bound is 10,000, one per folder up to then.
LISTING_TASKS = 8
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_parquet_tree(spark: SparkSession, root: str) -> DataFrame:
    """A base dump together with the increments below it; every file is read once."""
    return spark.read.option("recursiveFileLookup", True).parquet(root)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, mode: str = "PERMISSIVE",
    multiline: bool = False,
) -> DataFrame:
    """JSON below ``path``: lines, or one document per file with ``multiline``.

    Give a schema wherever the layout is known: it saves the inference pass and leaves out what
    is not declared. ``mode`` decides on bad records (``PERMISSIVE`` nulls, ``DROPMALFORMED``).
    """
    reader = spark.read.option("mode", mode).option("multiLine", multiline).option("recursiveFileLookup", True)
    most = spark.conf.get(_LISTING)
    # The tree is listed here, once. Listing a folder takes less time than starting a task.
    spark.conf.set(_LISTING, str(min(int(most), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        return (reader.schema(schema) if schema is not None else reader).json(path)
    finally:
        spark.conf.set(_LISTING, most)


def read_csv_header(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated text with a header line; all columns are text."""
    return spark.read.option("header", True).csv(path)


def read_text_nulls(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    r"""Headerless delimited text where ``\N`` and empty fields are null."""
    raw = spark.read.schema(schema).option("nullValue", r"\N").option("emptyValue", "").csv(path)
    blank = [
        F.when(F.col(f.name) != "", F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in raw.schema
    ]
    return raw.select(*blank)


def read_geojson(spark: SparkSession, path: str, properties: Mapping[str, str]) -> DataFrame:
    """One row per feature: ``polygon`` (rings of ``struct<x,y>``) and the picked ``properties``.

    ``properties`` maps output columns to property names. Geometries other than polygons have a
    null polygon. Each file is one document; a large coverage is stored as many files.
    """
    features = (
        spark.read.schema(GEOJSON).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    )
    rings = F.transform(
        F.col("f.geometry.coordinates"),
        lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))),
    )
    return features.select(
        F.when(F.col("f.geometry.type") == "Polygon", rings).alias("polygon"),
        *[F.try_element_at("f.properties", F.lit(name)).alias(column) for column, name in properties.items()],
    )


def serial_from_path(root: str) -> Column:
    """First folder below ``root`` of the file a row came from (``name=value`` folders give the value).

    ``root`` may hold ``*`` and ``?``. Paths are read decoded. A row that is not below a folder of
    ``root`` fails the query.
    """
    scheme = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/*", root)
    below = root[scheme.end() :] if scheme else root
    wild = {"*": "[^/]*", "?": "[^/]"}
    pattern = "".join(wild.get(c) or re.escape(c) for c in below.strip("/"))
    start = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*" if scheme or root.startswith("/") else "^(?:.*/)?"
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    serial = F.regexp_extract(path, rf"{start}{pattern}/(?:[^/=]+=)?([^/]+)/", 1)
    return F.when(serial != "", serial).otherwise(F.raise_error(F.concat(F.lit("no serial in "), path)))


def with_path_serial(df: DataFrame, root: str, column: str = "ASMSerial") -> DataFrame:
    """Add the device serial, which only the path of the file holds, to a scan of ``root``."""
    return df.select("*", serial_from_path(root).alias(column))


def snapshot_ingest(source: DataFrame, columns: Mapping[str, str], destination: str) -> DataFrame:
    """Copy a source table into the lake: cast ``columns`` (name to type), overwrite, read back.

    ``source`` is any reader's DataFrame (``jdbc``, files, ...). Identifier types become text.
    """
    quoted = {name: "`" + name.replace("`", "``") + "`" for name in columns}
    typed = source.select(*[F.col(quoted[name]).cast(data_type).alias(name) for name, data_type in columns.items()])
    typed.write.mode("overwrite").parquet(destination)
    return source.sparkSession.read.parquet(destination)


def passed_through(source: DataFrame, identifier: str = r"(^|[a-z0-9_])I[dD]$") -> dict[str, str]:
    """Columns for :func:`snapshot_ingest` of a table without a declared schema: all of them as they are, but
    those whose name matches ``identifier`` as text."""
    return {name: "string" if re.search(identifier, name) else kind for name, kind in source.dtypes}


def last_modified(
    scan: DataFrame, zone: str = "America/Los_Angeles", standard: str = "PST", daylight: str = "PDT"
) -> DataFrame:
    """When the newest file of a scan changed, in long form for ``zone``; one row."""
    newest = scan.select(F.col("_metadata.file_modification_time").alias("ts")).agg(F.max("ts").alias("ts"))
    return newest.select(long_form(F.col("ts"), zone, standard, daylight).alias("last_modified"))
