"""Stream sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import long_from_bytes
from ..session import ROCKSDB_PROVIDER
from ..sinks.changelog import append_changes, fold_levels
from ..sinks.commits import Files


#: Files of a lookup table, compressed, that are still sent to all tasks.
BROADCAST_BYTES = 8 << 20


def use_rocksdb(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, off the heap; keyed state here has no retention.

    Commits upload the changes of a micro-batch instead of whole snapshots.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start stateful queries inside with a number of state partitions, by default one per core.

    The number is fixed for the life of a checkpoint, and every partition opens its state stores
    in every micro-batch, so the default of batch shuffles fits neither small nor large clusters.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def file_records(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 1000, fmt: str = "parquet"
) -> DataFrame:
    """New files of a folder or glob as a stream, at most ``files_per_batch`` at a time."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def topic_records(
    spark: SparkSession, servers: str, topic: str, value_type: str = "string", records_per_batch: int = 10_000_000
) -> DataFrame:
    """Records of a topic as ``key, value, ts, offset``. Needs Spark's Kafka package on the class path.

    ``value_type`` ``bigint`` reads the eight-byte numbers that stream clients write.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", records_per_batch)
        .load()
    )
    if value_type == "bigint":
        value = long_from_bytes(F.col("value"))
    else:
        value = F.col("value").cast("string").cast(value_type)
    return raw.select(
        F.col("key").cast("string").alias("key"), value.alias("value"), F.col("timestamp").alias("ts"), "offset"
    )


def to_topic(records: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Send ``key, value`` to a topic; ``mode`` ``update`` sends each change of an aggregate.

    Needs Spark's Kafka package on the class path.
    """
    return (
        records.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .writeStream.format("kafka")
        .outputMode(mode)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def to_files(records: DataFrame, path: str, checkpoint: str, once: bool = True, by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append to parquet; ``once`` works off what is there and stops."""
    writer = records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    return (writer.trigger(availableNow=True) if once else writer).start()


def to_table(
    changes: DataFrame, path: str, checkpoint: str, key: str, value: str, offset: str,
    mode: str = "append", once: bool = True,
) -> StreamingQuery:
    """Keep the latest value per key of a stream in the change log at ``path``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, path, batch_id, key, value, offset)
        fold_levels(batch.sparkSession, path, key, offset)

    return each_batch(changes, store, checkpoint, mode, once)


def to_count_table(counts: DataFrame, path: str, checkpoint: str, key: str, once: bool = True) -> StreamingQuery:
    """Keep a running count per key: each micro-batch logs the counts it changed.

    Within a micro-batch every key occurs once; the batch number is the offset.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.select(key, "count", F.lit(batch_id).cast("bigint").alias("version"))
        numbered.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        fold_levels(batch.sparkSession, path, key, "version")

    return each_batch(counts, store, checkpoint, "update", once)


def lookup_to_files(
    stream: DataFrame, look_up: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Join every micro-batch with a table as it is by then, and write the result under its batch number.

    ``look_up`` gets the micro-batch and reads the table itself, so updates made while the stream
    runs are seen by the batches after them. A replayed batch overwrites itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        look_up(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return each_batch(stream, store, checkpoint, "append", once)


def live_lookup(spark: SparkSession, path: str, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table at ``path`` as it is now, for the lookups of one micro-batch.

    Its files are listed afresh. Up to ``most_bytes`` of them the table is sent to all tasks, as a
    replicated table is; a larger one meets the micro-batch in a shuffle.
    """
    table = spark.read.parquet(path)
    return F.broadcast(table) if Files(spark, path).size() <= most_bytes else table


def each_batch(
    df: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, mode: str, once: bool
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``store``, which must bear to be called again for one."""
    writer = df.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
