"""Device check-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import latest_with_ties
from ..schemas import ACTIVE_PARTITION

#: Serial prefixes of devices and test rigs.
DEVICE_PREFIXES = ("AAE", "TEST")


def known_devices(raw: DataFrame) -> DataFrame:
    serial = F.col("PartitionKey")
    return raw.filter(serial.startswith(DEVICE_PREFIXES[0]) | serial.startswith(DEVICE_PREFIXES[1]))


def cleaned(raw: DataFrame) -> DataFrame:
    """Check-ins of known devices with their partition document unpacked and the free space."""
    partition = F.from_json("ActivePartition", ACTIVE_PARTITION)
    return (
        known_devices(raw)
        .select(F.col("PartitionKey").alias("ASMSerial"), "Timestamp", partition.alias("ap"))
        .select(
            "ASMSerial", "Timestamp", "ap.Type", "ap.Device", "ap.Label", "ap.FsType", "ap.Size", "ap.Used",
            (F.col("ap.Size") - F.col("ap.Used")).alias("Free"), "ap.MountPath", "ap.SoftwareVersion",
        )
    )


def latest(raw: DataFrame) -> DataFrame:
    """The most recent check-in(s) of every device."""
    return cleaned(latest_with_ties(known_devices(raw), "PartitionKey", "Timestamp"))


def by_serial(raw: DataFrame, serial: str) -> DataFrame:
    """All check-ins of one device in time order."""
    return cleaned(raw.filter(F.col("PartitionKey") == serial)).orderBy("Timestamp")
