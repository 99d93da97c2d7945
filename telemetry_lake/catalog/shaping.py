"""Projections, filters, set operations and ordering."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.times import in_preset
from ..operators import reshape
from ..plans import checkins, service_desk, usage
from ..operators.joins import without_tagged
from ..schemas import QUOTED_METRICS
from .registry import query
from .views import Lake


@query(
    """SELECT p_partkey AS part, CAST(p_size AS DOUBLE) AS size, CAST(p_retailprice AS INTEGER) AS price, p_brand AS brand
    FROM (SELECT p_partkey, p_size, trunc(p_retailprice) AS p_retailprice, p_brand FROM part)"""
)
def project_cast(lake: Lake) -> DataFrame:
    return lake.table("part").select(
        F.col("p_partkey").alias("part"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").cast("int").alias("price"),
        F.col("p_brand").alias("brand"),
    )


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part")
def project_drop(lake: Lake) -> DataFrame:
    return lake.table("part").drop("p_type", "p_retailprice")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity AS "+1_1V_D", l_discount AS "Temperature__C", l_tax AS tax FROM lineitem"""
)
def rename_map(lake: Lake) -> DataFrame:
    """Raw metric names to names at rest, there and back and there again."""
    raw = lake.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("+1.1V_D (V)"),
        F.col("l_discount").alias("Temperature (C)"), F.col("l_tax").alias("tax"),
    )
    at_rest = reshape.rename_columns(raw, QUOTED_METRICS)
    back = reshape.rename_columns(at_rest, {new: old for old, new in QUOTED_METRICS.items()})
    return reshape.rename_columns(back, QUOTED_METRICS)


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS quantity,
        CASE WHEN l_linestatus <> 'O' THEN l_tax END AS tax FROM lineitem"""
)
def bulk_try_cast(lake: Lake) -> DataFrame:
    """Numbers that arrive as text; text that is no number becomes null."""
    text = lake.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("string")).otherwise("n/a").alias("quantity"),
        F.when(F.col("l_linestatus") != "O", F.col("l_tax").cast("string")).otherwise("").alias("tax"),
    )
    return reshape.try_cast_columns(text, ["quantity", "tax"])


@query("SELECT s_suppkey, s_name, 'year' AS duration FROM supplier")
def const_column(lake: Lake) -> DataFrame:
    return lake.table("supplier").select("s_suppkey", "s_name", F.lit("year").alias("duration"))


@query(
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS metric, l_quantity AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem"""
)
def melt(lake: Lake) -> DataFrame:
    return reshape.melt(
        lake.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "metric", "amount"
    )


@query(
    """SELECT "TerminalId" AS "TP-TerminalId", "SN" AS "TP-SN", 'terminal-' || "TerminalId" AS "TP-Name",
        "Id" AS "TerminalPropertyId", "Key" AS "TP-Key", "Value" AS "TP-Value", "Description" AS "TP-Description"
    FROM terminal_properties"""
)
def explode_props(lake: Lake) -> DataFrame:
    return usage.terminal_properties(lake.terminal_documents)


@query(
    """SELECT "ASMSerial", 'ASM-ALTITUDE' AS "ASMMetric", altitude AS data FROM device_metrics
    UNION ALL SELECT "ASMSerial", 'ASM-LATITUDE', latitude FROM device_metrics"""
)
def metric_code_lookup(lake: Lake) -> DataFrame:
    """Melted metrics under their report codes; columns the dictionary does not know drop out."""
    metrics = lake.device_metrics.withColumn("unlisted", F.col("altitude"))
    melted = reshape.melt(metrics, ["ASMSerial"], ["altitude", "latitude", "unlisted"], "ASMMetric", "data")
    return reshape.with_metric_code(melted)


@query(
    """SELECT "Number", "Priority", (SELECT count(*) FROM kept_tickets WHERE "Status" <> 'closed') AS open_all,
        (SELECT max("ModifiedOn") FROM kept_tickets) AS last_change
    FROM kept_tickets"""
)
def attach_scalar(lake: Lake) -> DataFrame:
    """Two overall numbers on every ticket, as scalar subqueries."""
    tickets = without_tagged(lake.tickets, lake.tags)
    return reshape.attach_scalar(
        tickets.select("Number", "Priority"),
        open_all=tickets.filter(F.col("Status") != "closed").agg(F.count(F.lit(1))),
        last_change=tickets.agg(F.max("ModifiedOn")),
    )


@query("SELECT event_id, ts, value FROM ev WHERE event_type = 'purchase'")
def filter_eq(lake: Lake) -> DataFrame:
    return lake.events.filter(F.col("event_type") == "purchase").select("event_id", "ts", "value")


@query("""SELECT "Number", "Priority" FROM tickets WHERE "Priority" <> 'low'""")
def filter_neq_null(lake: Lake) -> DataFrame:
    """An inequality also drops rows whose value is missing."""
    return lake.tickets.filter(F.col("Priority") != "low").select("Number", "Priority")


@query(
    """SELECT "EntityName", "Timestamp", "Action" FROM activity
    WHERE ("Action" = 'updateticket' AND "FieldName" = 'status') OR "NewValue" = 'open'"""
)
def filter_and_or(lake: Lake) -> DataFrame:
    wanted = ((F.col("Action") == "updateticket") & (F.col("FieldName") == "status")) | (F.col("NewValue") == "open")
    return lake.activity.filter(wanted).select("EntityName", "Timestamp", "Action")


@query("""SELECT "ASMSerial", altitude FROM device_metrics WHERE starts_with("ASMSerial", 'AAE')""")
def filter_prefix(lake: Lake) -> DataFrame:
    return lake.device_metrics.filter(F.col("ASMSerial").startswith("AAE")).select("ASMSerial", "altitude")


@query("""SELECT "Id", "Name" FROM kept_accounts""")
def filter_not_rlike(lake: Lake) -> DataFrame:
    return service_desk.customer_accounts(lake.accounts, ".*((77)|(42)).*").select("Id", "Name")


@query("""SELECT "Id", "Description" FROM terminal_properties WHERE "Description" NOT LIKE '%NMS_SSPP%'""")
def filter_not_contains(lake: Lake) -> DataFrame:
    properties = usage.terminal_properties(lake.terminal_documents)
    return properties.filter(~F.col("TP-Description").contains("NMS_SSPP")).select(
        F.col("TerminalPropertyId").alias("Id"), F.col("TP-Description").alias("Description")
    )


@query("""SELECT "Number", "Priority", "Status" FROM tickets WHERE "Priority" IS NOT NULL""")
def drop_nulls(lake: Lake) -> DataFrame:
    return lake.tickets.select("Number", "Priority", "Status").dropna()


@query(
    """SELECT "Id", "Name", coalesce("ModemSerial", 0) AS "ModemSerial" FROM remotes"""
)
def fill_nulls(lake: Lake) -> DataFrame:
    return lake.remotes.fillna(0)


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders
    WHERE o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '1998-08-01'"""
)
def date_range_preset(lake: Lake) -> DataFrame:
    """The orders of the month before a given day."""
    last_month = in_preset(F.col("o_orderdate"), dt.date(1998, 8, 15), "Last Month")
    return lake.table("orders").filter(last_month).select("o_orderkey", "o_orderdate")


@query(
    """SELECT key, "offset", value FROM region_changes
    UNION ALL SELECT key, "offset", CAST(value AS VARCHAR) FROM metric_changes"""
)
def union_all(lake: Lake) -> DataFrame:
    metrics = lake.metric_changes.withColumn("value", F.col("value").cast("string"))
    return lake.region_changes.unionByName(metrics)


@query(
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS size FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier
    UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part"""
)
def union_many(lake: Lake) -> DataFrame:
    """Tables of differing layout stacked by column name."""
    parts = [
        lake.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        lake.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        lake.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(lake: Lake) -> DataFrame:
    return lake.table("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def except_rows(lake: Lake) -> DataFrame:
    customers = lake.table("customer").select(F.col("c_custkey").alias("custkey"))
    large = lake.table("orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("custkey"))
    return customers.subtract(large.distinct())


@query(
    """SELECT DISTINCT "ASMSerial", altitude, latitude FROM device_metrics"""
)
def dedup_rows(lake: Lake) -> DataFrame:
    return lake.device_metrics.select("ASMSerial", "altitude", "latitude").dropDuplicates()


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def sort_multi(lake: Lake) -> DataFrame:
    orders = lake.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return orders.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query(
    """SELECT "Number", "Priority", "Subject", "CreatedOn" FROM tickets ORDER BY "CreatedOn" DESC, "Number" DESC LIMIT 20"""
)
def top20_created(lake: Lake) -> DataFrame:
    return service_desk.last_created(lake.tickets)


@query(
    """SELECT "Number", "Priority", "Subject",
        (epoch_us("ModifiedOn") // 1000000 - epoch_us("CreatedOn") // 1000000) / 86400 AS "ResolutionTime_Days"
    FROM tickets WHERE "Status" = 'closed' AND "Type" <> 'rma' ORDER BY "ModifiedOn" DESC, "Number" DESC LIMIT 20"""
)
def top20_closed(lake: Lake) -> DataFrame:
    return service_desk.last_closed(lake.tickets)


@query("""SELECT "ASMSerial", "Timestamp", "Type", "Free" FROM checkins WHERE "ASMSerial" = 'TEST7' ORDER BY "Timestamp" """)
def by_serial_sorted(lake: Lake) -> DataFrame:
    return checkins.by_serial(lake.checkins, "TEST7").select("ASMSerial", "Timestamp", "Type", "Free")
