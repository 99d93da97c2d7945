"""How long tickets stay in each status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators.asof import asof_join
from ..operators.buckets import with_previous
from ..schemas import TICKET_STATUSES

IMPUTE_WITHIN = dt.timedelta(days=100)


def _created(activity: DataFrame) -> DataFrame:
    return activity.filter(F.col("Action") == "addticket").select(
        F.col("EntityName").alias("Ticket"), F.col("Timestamp").alias("time")
    )


def _updated(activity: DataFrame) -> DataFrame:
    return activity.filter((F.col("Action") == "updateticket") & (F.col("FieldName") == "status")).select(
        F.col("EntityName").alias("Ticket"), F.col("Timestamp").alias("time"), "OldValue", "NewValue"
    )


def activity_timeline(activity: DataFrame) -> DataFrame:
    """Creations and status updates, ``(Ticket, time, OldValue, NewValue)``.

    A creation does not say which status the ticket got; it is the old value of the
    first update within 100 days.
    """
    updates = _updated(activity)
    first_update = updates.select("Ticket", F.col("time").alias("__until"), F.col("OldValue").alias("__first"))
    created = asof_join(
        _created(activity), first_update, ["Ticket"], "time", "__until", IMPUTE_WITHIN, "forward", tiebreak=["__first"]
    ).select("Ticket", "time", F.lit(None).cast("string").alias("OldValue"), F.col("__first").alias("NewValue"))
    return created.unionByName(updates)


def status_spells(activity: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Seconds each ticket spent in the status that an update ended.

    Only times and old values matter here, so the imputed status is not computed.
    """
    created = _created(activity).withColumn("OldValue", F.lit(None).cast("string"))
    events = created.unionByName(_updated(activity).drop("NewValue"))
    timed = events.withColumn("second", F.unix_timestamp("time")).filter(F.col("second").isNotNull())
    stepped = with_previous(timed, ["Ticket"], "second", "before", ["time"])
    return stepped.select(
        "Ticket", F.col("OldValue").alias("Status"), (F.col("second") - F.col("before")).alias("seconds")
    ).dropna()


def status_durations(activity: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Seconds per ticket and status, one column per status, 0 where never entered."""
    spells = status_spells(activity, max_group_rows)
    return spells.groupBy("Ticket").pivot("Status", TICKET_STATUSES).sum("seconds").fillna(0)
