"""Files written for readers, reports and the next run."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import work_dir
from .commits import Files

#: Items of a line of a JSON array, and equal rows handled as one.
LINE_ITEMS, BLOCK = 10_000, 1_000
#: The folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Fewest partitions that rows are dealt to by folder. Adaptive execution merges small ones, but splits those above its
#: advisory size, and then all of their folders get a file from each part.
FOLDER_PARTITIONS = 2_000
#: What Spark writes as ``%XX`` in the name of a folder.
ESCAPED = r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""


def compact_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Rewrite as few well-sized files.

    ``files`` fixes the number; without it adaptive execution sizes them by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, which also fits tables that grow.
    """
    even = df.repartition(files) if files else df.hint("rebalance")
    even.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a report as JSON lines.

    ``single_file`` is for results whose size a limit or a fixed set of groups bounds; a report
    that grows with the data keeps its (sorted) partitions.
    """
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", order: Sequence[str] = (), compression: str = "none"
) -> None:
    """JSON in ``by=value`` folders. Rows of a folder meet first, so it gets few files; a folder
    with very many rows is split by adaptive execution instead of filling one task. Each file is
    sorted by ``order``."""
    met = df.hint("rebalance", *by)
    sorted_ = met.sortWithinPartitions(*by, *order) if order else met
    sorted_.write.mode(mode).partitionBy(*by).json(path, compression=compression)


def write_folders(rows: DataFrame, path: str, column: str, line: str) -> None:
    """Text below a new folder ``path``: each ``line`` in the folder ``column=value`` of its row, as ``partitionBy`` names it.

    For trees of very many small folders. Without its native library Hadoop starts a process to set the mode of each
    folder, file and checksum file on a local disk, which takes far longer than the rows; so on local paths the tasks write
    the files themselves. A file is hidden until it is whole and named after its partition, so a repeated task replaces its
    own files only. On other file systems Spark writes.
    """
    top = Files(rows.sparkSession, path)
    partitions = max(FOLDER_PARTITIONS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = rows.select(column, line).hint("rebalance", partitions, column)
    if top.fs.getUri().getScheme() != "file":
        met.write.partitionBy(column).text(path)
        return
    if top.exists():
        raise FileExistsError(path)
    top.make()
    value = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(NO_VALUE))
    named = met.select(value.alias("value"), F.concat(F.coalesce(line, F.lit("")), F.lit("\n")).alias("line"))
    write = _folder_files(f"{top.path('').toUri().getPath()}/{column}=")
    named.sortWithinPartitions("value").mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()


def _folder_files(start: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write rows ``(value, line)``, sorted by value, to a file per value; returns the number of files."""
    special = ESCAPED

    def pieces(batches):
        for batch in batches:
            values, lines, begin = pc.run_end_encode(batch.column(0)), batch.column(1).cast(pa.binary()), 0
            for value, end in zip(values.values.to_pylist(), values.run_ends.to_pylist()):
                yield value, lines.slice(begin, end - begin)
                begin = end

    def write(batches):
        task, files = TaskContext.get(), 0
        name = f"part-{task.partitionId():05d}.txt"
        for value, parts in itertools.groupby(pieces(batches), lambda piece: piece[0]):
            folder = start + re.sub(special, lambda c: f"%{ord(c[0]):02X}", value)
            os.makedirs(folder, exist_ok=True)
            hidden = f"{folder}/.{name}.{task.taskAttemptId()}"
            with open(hidden, "wb") as out:
                for _, lines in parts:
                    out.writelines(lines.to_pylist())
            os.replace(hidden, f"{folder}/{name}")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return write


def write_nested_periods(
    yearly: DataFrame, monthly: DataFrame, root: str, keys: Sequence[str], compression: str = "none"
) -> tuple[str, str]:
    """Yearly and monthly breakdowns in sibling trees (one tree of mixed depth would defeat
    partition discovery). Returns both paths; the monthly one drops ``duration``. The lists repeat
    their field names in each item: ``compression="gzip"`` makes the trees many times smaller."""
    yearly_path, monthly_path = f"{root}/yearly", f"{root}/monthly"
    write_partitioned(yearly, yearly_path, [*keys, "year"], compression=compression)
    write_partitioned(monthly.drop("duration"), monthly_path, [*keys, "year", "month"], compression=compression)
    return yearly_path, monthly_path


def json_array_documents(df: DataFrame, by: Sequence[str], order: Sequence[str], max_items: int | None = None) -> DataFrame:
    """One JSON array per group: ``by``, ``part``, ``line``, ``document``, items ordered by ``order``.

    A group is one array, part 0, whatever its size. It is returned in lines of up to
    :data:`LINE_ITEMS` items, to be read one after the other: the first starts with the opening
    bracket, the last ends with the closing one, and most groups have one line. So no task holds
    more of a group than a range partition or a line of it. With ``max_items`` the caller asks for
    several arrays of up to so many items, parts 0, 1 and so on. An empty text in ``by`` counts as
    null, as both have the same folder. Writes the sorted items below ``spark.checkpoint.dir``.
    """
    spark, texts = df.sparkSession, {c for c, kind in df.dtypes if c in by and kind == "string"}
    keys, orders = [f"__k{n}" for n in range(len(by))], [f"__o{n}" for n in range(len(order))]
    item = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in by]))
    rows = df.select(
        *[(F.nullif(F.col(c), F.lit("")) if c in texts else F.col(c)).alias(k) for c, k in zip(by, keys)],
        *[F.col(c).alias(o) for c, o in zip(order, orders)],
        item.alias("__item"),
    )
    # Equal rows are counted and dealt as numbered blocks, so that they spread like others.
    counted = rows.groupBy(*keys, *orders, "__item").agg(F.count(F.lit(1)).alias("__n"))
    blocks = counted.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(BLOCK).cast("bigint"))))
    in_order = [*keys, *orders, "__item", "__block"]
    dealt = blocks.repartitionByRange(*in_order).sortWithinPartitions(*in_order).withColumn("__piece", F.spark_partition_id())
    pieces = materialize(dealt, work_dir(spark, "index-items"))
    # An item's place is its place in the piece, after the group's items in earlier pieces.
    size = F.least(F.lit(BLOCK), F.col("__n") - F.col("__block"))
    earlier = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy(*keys, "__piece").agg(F.sum(size).alias("__size"))
    starts = starts.withColumns({"__start": F.coalesce(F.sum("__size").over(earlier), F.lit(0))})
    starts = starts.withColumn("__total", F.sum("__size").over(Window.partitionBy(*keys)))
    starts = starts.select(*[F.col(c).alias(f"__s{c}") for c in [*keys, "__piece"]], "__start", "__total")
    met = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__s{c}")) for c in [*keys, "__piece"]])
    before = Window.partitionBy(*keys, "__piece").orderBy(*orders, "__item", "__block").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("__before", F.coalesce(F.sum(size).over(before), F.lit(0))).join(starts, met)
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1))
    items = placed.withColumn("__copy", copy).withColumn("__at", F.col("__start") + F.col("__before") + F.col("__copy"))
    part = F.floor(F.col("__at") / max_items) if max_items else F.lit(0)
    within = F.col("__at") % max_items if max_items else F.col("__at")
    items = items.withColumns({"part": part.cast("int"), "line": F.floor(within / LINE_ITEMS), "__within": within})
    closes = F.col("__at") + 1 == F.col("__total")
    if max_items:
        closes = closes | (F.col("__within") + 1 == max_items)
    text = F.concat(F.when(F.col("__within") == 0, "[").otherwise(""), F.col("__item"), F.when(closes, "]").otherwise(","))
    lines = items.groupBy(*keys, "part", "line").agg(F.sort_array(F.collect_list(F.struct("__at", text.alias("t")))).alias("__lines"))
    return lines.select(
        *[F.col(k).alias(c) for c, k in zip(by, keys)], "part", "line", F.array_join(F.col("__lines")["t"], "").alias("document")
    )


def write_index_documents(documents: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write :func:`json_array_documents` as text below ``by=value/part=n`` folders.

    The files of a folder, in the order of their names, are one JSON array.
    """
    # Without nulls in text columns Spark adds no sort of its own, which would mix the lines.
    named = {c: F.coalesce(F.col(c), F.lit(NO_VALUE)) for c, kind in documents.dtypes if c in by and kind == "string"}
    placed = documents.withColumns(named).repartitionByRange(*by, "part", "line").sortWithinPartitions(*by, "part", "line")
    placed.select(*by, "part", "document").write.mode("overwrite").partitionBy(*by, "part").text(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result once and go on from the files, for several consumers.

    Cuts lineage without depending on executors staying alive.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_high_water_mark(df: DataFrame, key: str, path: str) -> None:
    """Persist the smallest key, i.e. the newest reversed time, as a one-line text; without rows it is empty."""
    df.agg(F.min(key).alias("value")).filter("value IS NOT NULL").write.mode("overwrite").text(path)


def read_high_water_mark(spark: SparkSession, path: str, key: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", key)
