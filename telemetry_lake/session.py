"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Settings the library relies on. Memory, cores and partition counts stay with
#: the cluster that submits the job.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key may hold a third of all rows: split it even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "telemetry_lake", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session with :data:`DEFAULTS`; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, shuffled_share: float = 0.1, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job over ``input_bytes``, to pass to :func:`get_session`.

    ``shuffled_share`` is the part of the input that reaches a shuffle after column pruning and
    map-side aggregation. Shuffles start with one partition per ``partition_bytes`` of it (100 TB:
    some 37,000); adaptive execution merges what turns out smaller. Scans read twice as much per
    task, which keeps the number of map outputs down.
    """
    shuffled = int(input_bytes * shuffled_share)
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffled // partition_bytes))),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's temporary folder: on a
    cluster the executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="telemetry_lake-")
    return f"{base.rstrip('/')}/telemetry_lake/{label}-{uuid.uuid4().hex}"
