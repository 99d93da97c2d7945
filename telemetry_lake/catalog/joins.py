"""Joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import joins
from ..operators.asof import asof_join
from ..operators.spatial import spatial_join
from ..plans import metric_history, telemetry_rollups
from .registry import query
from .views import Lake

#: The stream-stream default of five minutes would join next to nothing on two events per user and day.
WITHIN = dt.timedelta(hours=6)

_TABLE_JOIN = """
    SELECT key, {text} AS value FROM region_table r {how} JOIN metric_table m USING (key)"""
TABLE_JOIN_SQL = {
    "inner": _TABLE_JOIN.format(how="", text="r.value || '/' || m.value"),
    "left": _TABLE_JOIN.format(how="LEFT", text="r.value || '/' || coalesce(m.value, 0)"),
    "full": _TABLE_JOIN.format(how="FULL", text="coalesce(r.value, 'null') || '/' || coalesce(m.value, 0)"),
}

_REPLAY = """
    SELECT s.key, s."offset", s.metric || '/' || coalesce(r.value, 'null') AS value
    FROM (SELECT * FROM keyed WHERE event_type = 'purchase') s
    ASOF LEFT JOIN region_changes r ON s.key = r.key AND s."offset" >= r."offset" """
REPLAY_SQL = {"inner": _REPLAY + "WHERE r.value IS NOT NULL", "left": _REPLAY}

_WITHIN = """
    SELECT coalesce(p.key, c.key) AS key, p."offset" AS left_id, c."offset" AS right_id,
        coalesce(p.metric, 0) || '/' || coalesce(c.label, 'null') AS value
    FROM (SELECT * FROM keyed WHERE event_type = 'purchase') p
    {how} JOIN (SELECT * FROM keyed WHERE event_type = 'click') c
    ON p.key = c.key AND c.ts BETWEEN p.ts - INTERVAL 6 HOUR AND p.ts + INTERVAL 6 HOUR"""
WITHIN_SQL = {"inner": _WITHIN.format(how=""), "left": _WITHIN.format(how="LEFT"), "full": _WITHIN.format(how="FULL")}

_GLOBAL = """
    SELECT k."offset", k.key, k.metric || '/' || coalesce(c_mktsegment, 'null') AS value
    FROM keyed k {how} JOIN customer ON c_custkey = k.user_id * 20 WHERE k.event_type = 'purchase'"""
GLOBAL_SQL = {"inner": _GLOBAL.format(how=""), "left": _GLOBAL.format(how="LEFT")}


def _register_stream_style_joins() -> None:
    for how, short in (("inner", "inner"), ("left", "left"), ("full", "outer")):

        def tables(lake: Lake, how=how) -> DataFrame:
            regions = joins.current_table(lake.region_changes, "key", "value", "offset")
            metrics = joins.current_table(lake.metric_changes, "key", "value", "offset")
            return joins.join_tables(regions, metrics, "key", "value", "value", how)

        def within(lake: Lake, how=how) -> DataFrame:
            purchases, clicks = within_sides(lake)
            return within_result(joins.join_within(purchases, clicks, "key", "left_ts", "right_ts", WITHIN, how))

        query(TABLE_JOIN_SQL[how], name=f"tt_join_{short}")(tables)
        query(WITHIN_SQL[how], name=f"ss_join_{short}")(within)

    for how in ("inner", "left"):

        def replay(lake: Lake, how=how) -> DataFrame:
            stream = lake.keyed_records("purchase").select("key", "offset", "metric")
            joined = joins.replay_stream_table(stream, lake.region_changes, "key", "offset", "metric", "value", how)
            return joined.select("key", "offset", "value")

        def global_table(lake: Lake, how=how) -> DataFrame:
            stream = lake.keyed_records("purchase")
            return global_lookup(stream, lake.table("customer"), how)

        query(REPLAY_SQL[how], name=f"st_join_{how}")(replay)
        query(GLOBAL_SQL[how], name=f"sg_join_{how}")(global_table)


def within_sides(lake: Lake) -> tuple[DataFrame, DataFrame]:
    purchases = lake.keyed_records("purchase").select(
        "key", F.col("offset").alias("left_id"), F.col("metric"), F.col("ts").alias("left_ts")
    )
    clicks = lake.keyed_records("click").select(
        "key", F.col("offset").alias("right_id"), F.col("label"), F.col("ts").alias("right_ts")
    )
    return purchases, clicks


def within_result(joined: DataFrame) -> DataFrame:
    schema = joined.schema
    text = joins.render_pair(F.col("metric"), schema["metric"].dataType, F.col("label"), schema["label"].dataType)
    return joined.select("key", "left_id", "right_id", text.alias("value"))


def global_lookup(stream: DataFrame, customers: DataFrame, how: str) -> DataFrame:
    """The lookup key is an expression of the record, not its key."""
    joined = joins.join_stream_table(stream, customers, F.col("user_id") * 20, "c_custkey", "metric", "c_mktsegment", how)
    return joined.select("offset", "key", "value")


_register_stream_style_joins()


@query(
    """SELECT o_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_using(lake: Lake) -> DataFrame:
    orders = lake.table("orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    customers = lake.table("customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return orders.join(customers, ["custkey"])


@query(
    """SELECT 3155378975999999999 - CAST(h."RowKey" AS BIGINT) AS "timestamp", h."Data", t."Name" AS "TerminalName",
        t."SN" AS "ModemSerial"
    FROM metric_history h JOIN terminals t ON split_part(h."PartitionKey", '.', 1) = t.id"""
)
def join_decode(lake: Lake) -> DataFrame:
    """Facts joined to a dimension whose key is named differently."""
    records = metric_history.decode(lake.metric_history)
    renamed = {"Name": "TerminalName", "SN": "ModemSerial"}
    joined = joins.join_dimension(records, lake.terminals, "TerminalId", "id", renamed)
    return joined.select("timestamp", "Data", "TerminalName", "ModemSerial")


@query("""SELECT "Id", "Status", "AccountId" FROM kept_tickets""")
def join_anti(lake: Lake) -> DataFrame:
    return joins.without_tagged(lake.tickets, lake.tags).select("Id", "Status", "AccountId")


@query("""SELECT "ASMSerial", "ASMMetric", "timestamp", data FROM long_records""")
def long_records(lake: Lake) -> DataFrame:
    """Distinct records of the chosen devices. The chosen serials are those with the prefix, so the
    prefix filter stands for the semi-join with their list."""
    return telemetry_rollups.long_records(lake.device_metrics)


@query(
    """SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)"""
)
def join_semi(lake: Lake) -> DataFrame:
    """Rows whose key is in a list of chosen ones."""
    chosen = lake.table("supplier").filter(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("l_suppkey"))
    return joins.with_key_in(lake.table("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), chosen, "l_suppkey")


@query(
    """SELECT l_suppkey, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, l_orderkey, l_linenumber
    FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) AS rk FROM lineitem) WHERE rk = 1"""
)
def latest_per_key_ties(lake: Lake) -> DataFrame:
    """The last shipments of every supplier, all of the last day."""
    lines = lake.table("lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return joins.latest_with_ties(lines, "l_suppkey", "l_shipdate")


def _asof_sides(lake: Lake, kind: str) -> tuple[DataFrame, DataFrame]:
    left = lake.keyed_records("purchase").select("key", F.col("offset").alias("left_id"), F.col("ts").alias("left_ts"))
    right = lake.keyed_records(kind).select("key", F.col("offset").alias("right_id"), F.col("ts").alias("right_ts"))
    return left, right


@query(
    """SELECT p.key, p."offset" AS left_id, p.ts AS left_ts,
        CASE WHEN p.ts - v.ts <= INTERVAL 1 DAY THEN v."offset" END AS right_id,
        CASE WHEN p.ts - v.ts <= INTERVAL 1 DAY THEN v.ts END AS right_ts
    FROM (SELECT * FROM keyed WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM keyed WHERE event_type = 'view') v ON p.key = v.key AND p.ts >= v.ts"""
)
def asof_backward(lake: Lake) -> DataFrame:
    """The last view of the user within a day before each purchase."""
    left, right = _asof_sides(lake, "view")
    return asof_join(left, right, ["key"], "left_ts", "right_ts", dt.timedelta(days=1))


@query(
    """SELECT p.key, p."offset" AS left_id, p.ts AS left_ts,
        CASE WHEN v.ts - p.ts <= INTERVAL 2 DAY THEN v."offset" END AS right_id,
        CASE WHEN v.ts - p.ts <= INTERVAL 2 DAY THEN v.ts END AS right_ts
    FROM (SELECT * FROM keyed WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM keyed WHERE event_type = 'click') v ON p.key = v.key AND p.ts <= v.ts"""
)
def asof_forward(lake: Lake) -> DataFrame:
    """The next click of the user within two days after each purchase."""
    left, right = _asof_sides(lake, "click")
    return asof_join(left, right, ["key"], "left_ts", "right_ts", dt.timedelta(days=2), "forward")


@query(
    """SELECT p.event_id, p.x, p.y, e.beam, CAST(e.n_nationkey AS INTEGER) AS n_nationkey
    FROM points p JOIN polygon_edges e ON p.point_beam = e.beam
    GROUP BY p.event_id, p.x, p.y, e.beam, e.n_nationkey
    HAVING sum(CASE WHEN (e.y1 > p.y) <> (e.y2 > p.y)
        THEN CASE WHEN p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END ELSE 0 END) % 2 = 1"""
)
def point_in_polygon(lake: Lake) -> DataFrame:
    """Points joined to the polygons of their beam that they lie in."""
    joined = spatial_join(
        lake.points, lake.beam_polygons, "x", "y", "polygon", cell=20.0, on=[("point_beam", "beam")]
    )
    return joined.select("event_id", "x", "y", "beam", "n_nationkey")
