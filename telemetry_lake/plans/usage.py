"""Traffic per remote and month, with the days of each month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import si_prefix
from ..functions.text import key_part
from ..operators.joins import join_dimension
from ..operators.rollups import nest, roll_up
from ..schemas import DOWNLOAD_METRIC, MANAGEMENT_TRAFFIC, UPLOAD_METRIC
from .metric_history import decode


def terminal_properties(terminals: DataFrame) -> DataFrame:
    """One row per entry of the ``Properties`` array."""
    return terminals.select("id", "SN", "Name", F.explode("Properties").alias("p")).select(
        F.col("id").alias("TP-TerminalId"),
        F.col("SN").alias("TP-SN"),
        F.col("Name").alias("TP-Name"),
        F.col("p.Id").alias("TerminalPropertyId"),
        F.col("p.Key").alias("TP-Key"),
        F.col("p.Value").alias("TP-Value"),
        F.col("p.Description").alias("TP-Description"),
    )


def traffic(history: DataFrame, terminals: DataFrame, metrics: DataFrame, properties: DataFrame) -> DataFrame:
    """Up- and download records with modem serial and service, management traffic left out."""
    transfer = metrics.filter(F.col("IntId").isin(UPLOAD_METRIC, DOWNLOAD_METRIC))
    records = join_dimension(decode(history), transfer, "MetricId", "id", {"IntId": "MetricIntId"})
    records = join_dimension(records, terminals, "TerminalId", "id", {"SN": "ModemSerial"})
    records = join_dimension(
        records, properties, "TerminalPropertyId", "TerminalPropertyId", {"TP-Description": "description"}
    )
    return records.select(
        F.timestamp_seconds("timestamp").alias("timestamp"),
        "ModemSerial",
        "MetricIntId",
        "Data",
        key_part(F.col("description"), 1, ":").alias("SSPP"),
    ).filter(~F.col("SSPP").contains(MANAGEMENT_TRAFFIC))


def usage(records: DataFrame, period: str) -> DataFrame:
    """First and last time, records and sum per modem and ``month``, ``day`` (from midnight UTC) or ``date`` (local)."""
    return roll_up(records, ["ModemSerial"], "timestamp", period, [F.sum("Data").alias("used")])


def remotes(table: DataFrame) -> DataFrame:
    return table.filter(F.col("ModemSerial").isNotNull()).select(
        F.col("Id").alias("RemoteId"), F.col("Name").alias("RemoteName"), "ModemSerial"
    )


def usage_by_remote(records: DataFrame, remote_table: DataFrame) -> DataFrame:
    """Monthly usage per remote with its daily breakdown; ``RemoteSerial`` is the modem serial."""
    size = si_prefix(F.col("used")).alias("SI")
    day = ["start", "end", "records", "used", size]
    months = nest(usage(records, "date"), ["ModemSerial"], ["year", "month"], day, [F.sum("used").alias("used")])
    return months.join(remotes(remote_table), "ModemSerial").select(
        "RemoteId", "RemoteName", F.col("ModemSerial").alias("RemoteSerial"), "year", "month", "start", "end",
        "records", "used", size, "breakdown",
    )
