"""Telemetry and service-desk views derived from the test tables.

Each has a twin in :mod:`sql_views`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import encode_reversed_key
from ..session import work_dir


def _mapped(column: Column, values: dict[str, object]) -> Column:
    result = None
    for key, value in values.items():
        result = F.when(column == key, value) if result is None else result.when(column == key, value)
    return result


class Lake:
    """The tables of one scale and the views on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def work_dir(self, label: str) -> str:
        return work_dir(self.spark, label)

    # --- service desk -------------------------------------------------------

    @property
    def tickets(self) -> DataFrame:
        key = F.col("o_orderkey")
        created = F.col("o_orderdate").cast("timestamp")
        later = F.make_dt_interval(days=(key % 90).cast("int"), hours=(key % 24).cast("int"))
        return self.table("orders").select(
            key.alias("Id"),
            key.alias("Number"),
            _mapped(F.col("o_orderstatus"), {"O": "open", "F": "closed", "P": "pending"}).alias("Status"),
            _mapped(
                F.col("o_orderpriority"),
                {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "normal", "5-LOW": "low"},
            ).alias("Priority"),
            F.when(F.col("o_totalprice") < 60000, "rma").otherwise("support").alias("Type"),
            created.alias("CreatedOn"),
            (created + later).alias("ModifiedOn"),
            F.col("o_custkey").alias("AccountId"),
            F.concat(F.lit("T-"), key.cast("string")).alias("Subject"),
        )

    @property
    def tags(self) -> DataFrame:
        price = F.col("o_totalprice")
        return (
            self.table("orders")
            .filter(price.between(100000, 110000) | (price > 490000))
            .select(F.col("o_orderkey").alias("EntityId"), F.when(price > 490000, "vip").otherwise("ignore").alias("Name"))
        )

    @property
    def accounts(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name"), F.col("c_custkey").alias("Number")
        )

    # --- telemetry ----------------------------------------------------------

    @property
    def events(self) -> DataFrame:
        """Events with a proper instant and the number in ``props``."""
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    @property
    def device_metrics(self) -> DataFrame:
        supplier = F.col("l_suppkey")
        kind = F.when(supplier % 5 == 0, "TEST").otherwise("AAE")
        return self.table("lineitem").select(
            F.concat(kind, supplier.cast("string")).alias("ASMSerial"),
            F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("timestamp-S"),
            F.col("l_quantity").alias("altitude"),
            # Whole hundredths, so that sums and averages are exact on both sides.
            F.round(F.col("l_extendedprice") * 100).alias("direction"),
            F.round(F.col("l_discount") * 100).alias("latitude"),
            F.round(F.col("l_tax") * 100).alias("longitude"),
        )

    @property
    def metric_history(self) -> DataFrame:
        user = F.col("user_id")
        property_id = (user * 100 + F.col("k")).cast("string")
        return self.events.select(
            F.concat_ws(".", user.cast("string"), "event_type", property_id).alias("PartitionKey"),
            encode_reversed_key(F.unix_timestamp("ts")).alias("RowKey"),
            F.round(F.col("value") * 100).alias("Data"),
            F.lit("gauge").alias("Type"),
            F.col("ts").alias("Timestamp"),
            F.lit(None).cast("string").alias("State1"),
            F.lit(None).cast("string").alias("State2"),
        )

    @property
    def metrics(self) -> DataFrame:
        kind = F.col("event_type")
        numbers = {"click": 1054, "purchase": 1055, "view": 1098, "signup": 1698, "error": 1}
        return (
            self.table("events")
            .select(kind)
            .distinct()
            .select(
                kind.alias("id"),
                F.upper(kind).alias("Name"),
                _mapped(kind, numbers).alias("IntId"),
                F.lit("counter").alias("Type"),
                F.lit("active").alias("Status"),
                F.lit("sum").alias("AggregationType"),
                F.concat(F.lit("metric "), kind).alias("Description"),
            )
        )

    @property
    def terminals(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("id"),
            F.col("c_name").alias("Name"),
            (F.col("c_custkey") + 1000000).alias("SN"),
            F.lit("active").alias("Status"),
        )

    @property
    def terminal_documents(self) -> DataFrame:
        """Terminals with their ``Properties`` array (at most one entry per value of ``k``)."""
        user, k = F.col("user_id"), F.col("k")
        entry = F.struct(
            (user * 100 + k).cast("string").alias("Id"),
            F.concat(F.lit("k"), k.cast("string")).alias("Key"),
            k.cast("string").alias("Value"),
            F.when(k < 10, "x:NMS_SSPP").otherwise(F.concat(F.lit("x:SSPP"), k.cast("string"))).alias("Description"),
        )
        return (
            self.events.select(user, k)
            .distinct()
            .groupBy(user)
            .agg(F.sort_array(F.collect_list(entry)).alias("Properties"))
            .select(
                user.cast("string").alias("id"),
                (user + 1000000).alias("SN"),
                F.concat(F.lit("terminal-"), user.cast("string")).alias("Name"),
                "Properties",
            )
        )

    @property
    def remotes(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.lit("R"), key.cast("string")).alias("Id"),
            F.col("c_name").alias("Name"),
            F.when(F.col("c_mktsegment") != "FURNITURE", key + 1000000).alias("ModemSerial"),
        )

    @property
    def activity(self) -> DataFrame:
        kind = F.col("event_type")
        created = kind == "signup"
        return self.events.select(
            F.col("user_id").cast("string").alias("EntityName"),
            F.col("ts").alias("Timestamp"),
            F.when(created, "addticket").otherwise("updateticket").alias("Action"),
            F.when(~created, F.when(F.col("value") > 200, "priority").otherwise("status")).alias("FieldName"),
            _mapped(kind, {"click": "open", "view": "pending", "purchase": "resolved", "error": "closed"}).alias("OldValue"),
            _mapped(kind, {"click": "pending", "view": "resolved", "purchase": "closed", "error": "open"}).alias("NewValue"),
        )

    @property
    def checkins(self) -> DataFrame:
        """Check-ins whose document is cut off for error events."""
        user, k = F.col("user_id"), F.col("k")
        prefix = F.when(user % 3 == 0, "AAE").when(user % 3 == 1, "TEST").otherwise("LAB")
        document = F.to_json(
            F.struct(
                F.col("event_type").alias("Type"),
                F.concat(F.lit("/dev/sd"), k.cast("string")).alias("Device"),
                (k.cast("bigint") * 1000).alias("Size"),
                F.floor("value").alias("Used"),
                F.lit("/").alias("MountPath"),
                F.concat(F.lit("v"), k.cast("string")).alias("SoftwareVersion"),
            )
        )
        whole = F.col("event_type") != "error"
        return self.events.select(
            F.concat(prefix, user.cast("string")).alias("PartitionKey"),
            F.col("ts").alias("Timestamp"),
            F.when(whole, document).otherwise(F.substring(document, 1, 12)).alias("ActivePartition"),
        )

    # --- changelogs and record streams ---------------------------------------

    @cached_property
    def _keyed(self) -> DataFrame:
        return self.events.withColumn("key", F.col("user_id").cast("string")).withColumn("offset", F.col("event_id"))

    @property
    def region_changes(self) -> DataFrame:
        """Text table per user; views delete the entry."""
        kind = F.col("event_type")
        return self._keyed.filter(kind.isin("click", "signup", "view")).select(
            "key", "offset", F.when(kind != "view", F.concat_ws("-", kind, F.col("k").cast("string"))).alias("value")
        )

    @property
    def metric_changes(self) -> DataFrame:
        """Number table per user; errors delete the entry."""
        kind = F.col("event_type")
        return self._keyed.filter(kind.isin("purchase", "error")).select(
            "key", "offset", F.when(kind != "error", F.floor("value")).alias("value")
        )

    def keyed_records(self, kind: str) -> DataFrame:
        """Records of one event type: key, offset, ts, metric (number) and label (text)."""
        return self._keyed.filter(F.col("event_type") == kind).select(
            "key", "offset", "ts", F.floor("value").alias("metric"),
            F.concat_ws("-", "event_type", F.col("k").cast("string")).alias("label"), "user_id",
        )

    # --- geometry ------------------------------------------------------------

    @property
    def beam_polygons(self) -> DataFrame:
        """One concave five-sided polygon per nation; the region names the beam."""
        step = F.floor(F.col("n_nationkey") / 5).cast("double")
        cx, cy = step * 25 + 15, step * 15 + 20
        corners = [(-12, -15), (12, -12), (5, 0), (14, 18), (-10, 10), (-12, -15)]
        ring = F.array(*[F.struct((cx + float(x)).alias("x"), (cy + float(y)).alias("y")) for x, y in corners])
        return self.table("nation").select(
            "n_nationkey",
            F.concat(F.lit("B"), F.col("n_regionkey").cast("string")).alias("beam"),
            F.array(ring).alias("polygon"),
        )

    @property
    def points(self) -> DataFrame:
        return self.events.select(
            "event_id",
            F.col("value").alias("x"),
            F.col("k").cast("double").alias("y"),
            F.concat(F.lit("B"), (F.col("user_id") % 5).cast("string")).alias("point_beam"),
        )
