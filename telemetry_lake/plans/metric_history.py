"""Key-value metric history: decoding, loading and incremental batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import key_part
from ..functions.times import decode_reversed_key
from ..operators.joins import join_dimension
from ..sinks.commits import CommitLog, Files
from ..sinks.files import write_high_water_mark
from ..sinks.ledger import read_ledger, record_processed, staged_files, unprocessed, SOURCE_FILE
from ..sources.files import read_parquet_tree


def decode(history: DataFrame) -> DataFrame:
    """Split ``PartitionKey`` (``terminal.metric[.property]``) and turn ``RowKey`` into epoch seconds."""
    key = F.col("PartitionKey")
    return history.select(
        key_part(key, 0).alias("TerminalId"),
        key_part(key, 1).alias("MetricId"),
        key_part(key, 2).alias("TerminalPropertyId"),
        decode_reversed_key(F.col("RowKey")).alias("timestamp"),
        "Data",
        "Type",
    )


def load(history: DataFrame, terminals: DataFrame, metrics: DataFrame) -> DataFrame:
    """Tidy table: decoded records with terminal and metric attributes."""
    terminal_names = {"Name": "TerminalName", "SN": "ModemSerial"}
    metric_names = {"Name": "MetricName", "IntId": "MetricInt", "Type": "MetricType"}
    terminal = {c: terminal_names.get(c, c) for c in terminals.columns if c not in ("id", "Status", "Type")}
    metric = {c: metric_names.get(c, c) for c in metrics.columns if c != "id"}
    records = decode(history).drop("TerminalPropertyId", "Type")
    with_terminal = join_dimension(records, terminals, "TerminalId", "id", terminal).drop("TerminalId")
    return join_dimension(with_terminal, metrics, "MetricId", "id", metric).drop("MetricId")


def new_rows(staged: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct staged rows that ``known`` does not hold.

    Copies collapse before the shuffle; the comparison treats nulls as equal.
    """
    return staged.distinct().subtract(known.select(*staged.columns))


def batch_names(spark: SparkSession, base: str) -> list[str]:
    """Names of the batch folders below ``base``, from a listing; none if it does not exist yet.

    A batch that is not complete lies in a folder that this, and Spark's readers, pass over.
    """
    return [n for n in Files(spark, base).names(folders=True) if not n.startswith(("_", "."))]


def newest_batch(spark: SparkSession, base: str) -> str | None:
    """Name of the newest batch folder below ``base`` (reversed keys: the smallest name)."""
    return min(batch_names(spark, base), default=None)


#: Where batches lie until they are committed, and the smallest key of a batch, in its folder.
PENDING, LOW = "_pending", "_low"
#: Name of a batch of which no row has a key.
NO_KEY = "no-key"


def commit_log(spark: SparkSession, ledger: str) -> CommitLog:
    """The commits of an ingestion, beside its ledger."""
    return CommitLog(spark, f"{ledger.rstrip('/')}-commits")


def prepare(spark: SparkSession, staging: str, base: str, ledger: str, against: str = "latest") -> dict | None:
    """Write the new rows of ``staging``, and the files they come from, as a pending batch.

    Returns what is to be committed, or None when the ledger lists all staged files. Without new
    rows there is no batch, but the files are still to be recorded.
    """
    staged = staged_files(read_parquet_tree(spark, staging))
    fresh = unprocessed(staged, read_ledger(spark, ledger))
    lake, own = Files(spark, base), f"{PENDING}/{uuid.uuid4().hex}"
    fresh.select(SOURCE_FILE).distinct().write.parquet(f"{base}/{own}/files")
    if read_ledger(spark, f"{base}/{own}/files").isEmpty():
        lake.remove(own)
        return None
    names = batch_names(spark, base)
    compared = names if against == "all" else [min(names)] if names else []
    rows = fresh.drop(SOURCE_FILE)
    if compared:
        rows = new_rows(rows, spark.read.parquet(*[f"{base}/{n}" for n in compared]))
    else:
        rows = rows.distinct()
    rows.write.parquet(f"{base}/{own}/rows")
    low, n = spark.read.schema(rows.schema).parquet(f"{base}/{own}/rows").agg(F.min("RowKey"), F.count(F.lit(1))).first()
    name = None if not n else NO_KEY if low is None else low
    if low is not None:
        lake.write(f"{own}/rows/{LOW}", low)
    return {"pending": own, "batch": f"{name}-{own[-32:]}" if name in names else name}


def complete(spark: SparkSession, base: str, ledger: str) -> tuple[str | None, int]:
    """Carry out what was committed: batches appear under their names, their files enter the ledger.

    Each step may be repeated, so a run that ended in between is completed by the next. Returns the
    last batch that this call made complete, if any, and the number of the newest commit it saw.
    """
    log, lake = commit_log(spark, ledger), Files(spark, base)
    last, name = log.last(), None
    for number, entry, _ in log.open():
        if number > last:
            break
        rows = f"{entry['pending']}/rows"
        if entry["batch"] and lake.exists(rows) and not lake.rename(rows, entry["batch"]):
            raise FileExistsError(f"{base}/{entry['batch']} is there, but is not the batch of commit {number}")
        if lake.exists(f"{entry['pending']}/files"):
            record_processed(read_ledger(spark, f"{base}/{entry['pending']}/files"), ledger)
        log.finish(number)
        lake.remove(entry["pending"])
        name = entry["batch"] or name
    return name, last


def process_staging(
    spark: SparkSession, staging: str, base: str, ledger: str, against: str = "latest"
) -> str | None:
    """Append the new rows of ``staging`` to ``base`` as one batch named by its smallest row key.

    ``against`` compares with the ``latest`` batch or with ``all`` of them; a base that does not exist
    yet has none. Files that the ledger lists are left out. If a batch of that name is there already,
    the run's own id is added to the name.

    Rows and the list of their files are written aside first. One commit then ties them together, and
    from it the batch's appearance and the ledger follow. A run that ends before its commit leaves
    nothing that counts; one that ends after it is completed by the next run, before that run looks for
    new files. Of two runs at once one commits and the other starts over. Returns the name of the
    batch that this call made complete, its own or an earlier run's, or None when nothing was new.
    """
    if against not in ("latest", "all"):
        raise ValueError(f"against must be 'latest' or 'all', not {against!r}")
    completed = None
    while True:
        name, last = complete(spark, base, ledger)
        completed = name or completed
        entry = prepare(spark, staging, base, ledger, against)
        if entry is None:
            return completed
        if commit_log(spark, ledger).commit(last + 1, entry):
            return complete(spark, base, ledger)[0] or completed
        Files(spark, base).remove(entry["pending"])


def sweep(spark: SparkSession, base: str, ledger: str) -> list[str]:
    """Remove what runs left that ended before their commit; for times when no run is going."""
    lake = Files(spark, base)
    wanted = {c.entry["pending"] for c in commit_log(spark, ledger).open()}
    debris = [f"{PENDING}/{n}" for n in lake.names(PENDING) if f"{PENDING}/{n}" not in wanted]
    for folder in debris:
        lake.remove(folder)
    return debris


def save_high_water_mark(spark: SparkSession, base: str, staging: str, path: str) -> None:
    """Persist the smallest row key over the newest batch and the staged rows.

    A batch notes its smallest key, so none of its rows is read; of a batch that was not written by
    :func:`process_staging` the key column is. A lake or a staging folder that does not exist yet has
    no rows; without any row the mark is empty.
    """
    keys = spark.createDataFrame([], "RowKey string")
    newest, lake = newest_batch(spark, base), Files(spark, base)
    if newest is not None and lake.exists(f"{newest}/{LOW}"):
        keys = spark.createDataFrame([(lake.read(f"{newest}/{LOW}"),)], "RowKey string")
    elif newest is not None:
        keys = spark.read.parquet(f"{base}/{newest}").select("RowKey")
    if Files(spark, staging).names():
        keys = keys.unionByName(read_parquet_tree(spark, staging).select("RowKey"))
    write_high_water_mark(keys, "RowKey", path)
