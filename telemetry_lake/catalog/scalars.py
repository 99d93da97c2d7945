"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import numbers, text, times
from ..plans import checkins
from .aggregates import WORDS_SQL
from .registry import query
from .views import Lake


@query(
    """SELECT split_part("PartitionKey", '.', 1) AS terminal, split_part("PartitionKey", '.', 2) AS metric,
        split_part("PartitionKey", '.', 3) AS property, CAST(NULL AS VARCHAR) AS beyond
    FROM metric_history"""
)
def split_key(lake: Lake) -> DataFrame:
    """Key parts; one past the end is null."""
    names = ("terminal", "metric", "property", "beyond")
    key = F.col("PartitionKey")
    return lake.metric_history.select(*[text.key_part(key, i).alias(name) for i, name in enumerate(names)])


@query("""SELECT "Id", split_part("Description", ':', 2) AS service FROM terminal_properties""")
def split_desc(lake: Lake) -> DataFrame:
    properties = lake.terminal_documents.select(F.explode("Properties").alias("p"))
    return properties.select(F.col("p.Id").alias("Id"), text.key_part(F.col("p.Description"), 1, ":").alias("service"))


@query(f"SELECT doc_id, word FROM ({WORDS_SQL})")
def tokenize(lake: Lake) -> DataFrame:
    return lake.table("documents").select("doc_id", F.explode(text.tokenize(F.col("text"))).alias("word"))


@query("SELECT doc_id, lower(text) AS text FROM documents")
def lower_text(lake: Lake) -> DataFrame:
    return lake.table("documents").select("doc_id", F.lower("text").alias("text"))


@query("""SELECT "Number", year("ModifiedOn") || '-' || week("ModifiedOn") AS label FROM tickets""")
def concat_year_week(lake: Lake) -> DataFrame:
    label = times.year_week(F.year("ModifiedOn"), F.weekofyear("ModifiedOn"))
    return lake.tickets.select("Number", label.alias("label"))


_SECONDS = '(epoch_us("ModifiedOn") // 1000000 - epoch_us("CreatedOn") // 1000000)'
#: One decimal, halves away from zero.
DAYS_SQL = f"CAST(CAST(round(CAST({_SECONDS} / 86400 AS DECIMAL(30,15)), 1) AS DECIMAL(20,1)) AS VARCHAR)"


@query(f"""SELECT "Number", {DAYS_SQL} AS "Days" FROM tickets""")
def format_days(lake: Lake) -> DataFrame:
    elapsed = times.elapsed_seconds(F.col("CreatedOn"), F.col("ModifiedOn"))
    return lake.tickets.select("Number", numbers.format_days(elapsed).alias("Days"))


def si_sql(value: str) -> str:
    """Size text: two decimals (halves up) and a unit from 1000 up, the plain number below."""

    def scaled(step: str, unit: str) -> str:
        return (
            f"WHEN {value} >= {step} THEN CAST(CAST(round(CAST(CAST({value} / {step} AS VARCHAR) AS DECIMAL(30,15)), 2) "
            f"AS DECIMAL(20,2)) AS VARCHAR) || ' {unit}'"
        )

    steps = [("1e12", "TB"), ("1e9", "GB"), ("1e6", "MB"), ("1e3", "KB")]
    return f"CASE {' '.join(scaled(*s) for s in steps)} ELSE CAST({value} AS VARCHAR) || ' B' END"


@query(
    f"""SELECT o_orderkey, {si_sql("size")} AS text
    FROM (SELECT o_orderkey, o_totalprice * CASE o_orderpriority WHEN '1-URGENT' THEN 10000000 WHEN '2-HIGH' THEN 10000
        WHEN '3-MEDIUM' THEN 10 WHEN '5-LOW' THEN -1 ELSE 0.0009765625 END AS size FROM orders)"""
)
def si_prefix(lake: Lake) -> DataFrame:
    """Sizes over all steps, negative ones included."""
    factor = (
        F.when(F.col("o_orderpriority") == "1-URGENT", 10000000.0).when(F.col("o_orderpriority") == "2-HIGH", 10000.0)
        .when(F.col("o_orderpriority") == "3-MEDIUM", 10.0).when(F.col("o_orderpriority") == "5-LOW", -1.0)
        .otherwise(0.0009765625)
    )
    size = F.col("o_totalprice") * factor
    return lake.table("orders").select("o_orderkey", numbers.si_prefix(size).alias("text"))


_STORE_SQL = r"regexp_replace(url, '^[a-z]+://([^/?#]+)/([^/?#]+)', 'wasbs://\2@\1')"


@query(f"SELECT page_id, {_STORE_SQL} AS uri FROM pages")
def uri_to_store(lake: Lake) -> DataFrame:
    return lake.table("pages").select("page_id", text.uri_to_store(F.col("url")).alias("uri"))


@query("SELECT page_id, regexp_replace(url, '^http:', 'https:') AS uri FROM pages")
def uri_from_store(lake: Lake) -> DataFrame:
    """Store form and back: the scheme becomes https, the rest returns as it was."""
    stored = text.uri_to_store(F.col("url"))
    return lake.table("pages").select("page_id", text.uri_from_store(stored).alias("uri"))


@query("SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS container FROM pages")
def path_segment(lake: Lake) -> DataFrame:
    url = F.col("url")
    return lake.table("pages").select(
        "page_id", text.path_segment(url, 2).alias("host"), text.path_segment(url, 3).alias("container")
    )


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(week(o_orderdate) AS INTEGER) AS week FROM orders"""
)
def date_parts(lake: Lake) -> DataFrame:
    day = F.col("o_orderdate")
    return lake.table("orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"), F.weekofyear(day).alias("week")
    )


@query(f"""SELECT "Number", {_SECONDS} AS seconds, round({_SECONDS} / 86400, 6) AS days FROM tickets""")
def elapsed_days(lake: Lake) -> DataFrame:
    elapsed = times.elapsed_seconds(F.col("CreatedOn"), F.col("ModifiedOn"))
    return lake.tickets.select("Number", elapsed.alias("seconds"), F.round(numbers.days(elapsed), 6).alias("days"))


@query(
    """SELECT event_id, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS seconds, ts AS nanos FROM ev"""
)
def epoch_to_ts(lake: Lake) -> DataFrame:
    """Timestamps from epoch seconds and from epoch nanoseconds."""
    return lake.events.select(
        "event_id",
        F.timestamp_seconds(F.unix_timestamp("ts")).alias("seconds"),
        times.from_epoch_nanos(F.unix_micros("ts") * 1000).alias("nanos"),
    )


@query("SELECT event_id, ts AS plain, ts + INTERVAL 8 HOUR AS pacific FROM ev")
def to_utc(lake: Lake) -> DataFrame:
    """Wall-clock times read as UTC and as Pacific time (all of them fall in winter)."""
    ts = F.col("ts")
    return lake.events.select(
        "event_id", times.to_utc(ts).alias("plain"), times.to_utc(ts, "America/Los_Angeles").alias("pacific")
    )


@query(
    """SELECT "PartitionKey", 3155378975999999999 - CAST("RowKey" AS BIGINT) AS epoch_second, "Data" FROM metric_history"""
)
def reverse_key_decode(lake: Lake) -> DataFrame:
    second = times.decode_reversed_key(F.col("RowKey"))
    return lake.metric_history.select("PartitionKey", second.alias("epoch_second"), "Data")


@query("""SELECT "ASMSerial", "Size", "Used", "Free" FROM checkins""")
def free_space(lake: Lake) -> DataFrame:
    return checkins.cleaned(lake.checkins).select("ASMSerial", "Size", "Used", "Free")


@query("SELECT event_id, k FROM ev")
def json_extract(lake: Lake) -> DataFrame:
    """A field of a JSON text column."""
    return lake.table("events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    """SELECT l_orderkey, l_linenumber,
        CAST(sign(x) * ceil(abs(x) * 10 - 0.5) / 10 AS FLOAT) AS tenth
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS DECIMAL(20,4)) AS x
        FROM lineitem)"""
)
def round_half_down(lake: Lake) -> DataFrame:
    """Prices to one decimal, exact halves towards zero, returns as negative amounts."""
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return lake.table("lineitem").select("l_orderkey", "l_linenumber", numbers.round_half_down(signed).alias("tenth"))
