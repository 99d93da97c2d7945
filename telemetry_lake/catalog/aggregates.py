"""Aggregations and window functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import without_tagged
from ..operators.rollups import nest, with_group_stats
from ..operators.buckets import with_previous
from ..plans import service_desk, telemetry_rollups, ticket_activity, usage
from ..streaming.transforms import count_by, word_count as count_words
from .registry import query
from .views import Lake


@query("SELECT event_type, count(*) AS count FROM ev GROUP BY event_type")
def group_count(lake: Lake) -> DataFrame:
    return count_by(lake.events, "event_type")


#: Words of a text: a leading empty word stays, trailing ones go, text without a separator is one word.
WORDS_SQL = r"""
    SELECT doc_id, unnest(CASE
        WHEN len(parts) = 1 THEN parts
        WHEN len(parts) = 2 AND parts[1] = '' AND parts[2] = '' THEN []
        WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END) AS word
    FROM (SELECT doc_id, string_split_regex(lower(text), '[^a-zA-Z0-9_]+') AS parts FROM documents)"""


@query(f"SELECT word, count(*) AS count FROM ({WORDS_SQL}) GROUP BY word")
def word_count(lake: Lake) -> DataFrame:
    return count_words(lake.table("documents"), "text")


_STATS = 'avg, max, min, round(stddev, 4) AS stddev'
_ROLLUP = 'SELECT "ASMSerial", "ASMMetric", duration, start, "end", records, ' + _STATS + " FROM {view}"


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _interval(lake: Lake, period: str) -> DataFrame:
    records = telemetry_rollups.long_records(lake.device_metrics)
    return rounded(telemetry_rollups.intervals(records, period), "stddev")


@query(_ROLLUP.format(view="yearly"))
def rollup_year(lake: Lake) -> DataFrame:
    return _interval(lake, "year")


@query(_ROLLUP.format(view="monthly"))
def rollup_month(lake: Lake) -> DataFrame:
    return _interval(lake, "month")


@query(_ROLLUP.format(view="daily"))
def rollup_day(lake: Lake) -> DataFrame:
    return _interval(lake, "day")


def traffic(lake: Lake) -> DataFrame:
    properties = usage.terminal_properties(lake.terminal_documents)
    return usage.traffic(lake.metric_history, lake.terminals, lake.metrics, properties)


@query('SELECT "ModemSerial", start, "end", records, used FROM usage_months')
def usage_month(lake: Lake) -> DataFrame:
    return usage.usage(traffic(lake), "month")


@query('SELECT "ModemSerial", start, "end", records, used FROM usage_days')
def usage_day(lake: Lake) -> DataFrame:
    return usage.usage(traffic(lake), "day")


@query(
    """SELECT "Ticket", CAST(coalesce(sum(seconds) FILTER (WHERE "Status" = 'open'), 0) AS BIGINT) AS open,
        CAST(coalesce(sum(seconds) FILTER (WHERE "Status" = 'closed'), 0) AS BIGINT) AS closed,
        CAST(coalesce(sum(seconds) FILTER (WHERE "Status" = 'waiting_on_customer'), 0) AS BIGINT) AS waiting_on_customer
    FROM status_spells GROUP BY "Ticket" """
)
def pivot_sum(lake: Lake) -> DataFrame:
    """Sums per status as columns; a status nobody had still gets its column."""
    spells = ticket_activity.status_spells(lake.activity)
    statuses = ["open", "closed", "waiting_on_customer"]
    return spells.groupBy("Ticket").pivot("Status", statuses).sum("seconds").fillna(0)


@query(
    """SELECT o_orderstatus, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
        count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low
    FROM orders GROUP BY o_orderstatus"""
)
def pivot_count(lake: Lake) -> DataFrame:
    counted = lake.table("orders").groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).count()
    return counted.fillna(0).withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"})


@query("SELECT user_id, max(ts) AS last_seen FROM ev GROUP BY user_id")
def max_per_key(lake: Lake) -> DataFrame:
    return lake.events.groupBy("user_id").agg(F.max("ts").alias("last_seen"))


def kept_tickets(lake: Lake) -> DataFrame:
    return without_tagged(lake.tickets, lake.tags)


OPEN_SQL = """
    SELECT count(*) AS "All", count(*) FILTER (WHERE "Priority" = 'urgent') AS "SeverityLevel1",
        count(*) FILTER (WHERE "Priority" = 'high') AS "SeverityLevel2",
        count(*) FILTER (WHERE "Priority" IS NULL OR "Priority" NOT IN ('urgent', 'high')) AS "SeverityLevel3"
    FROM kept_tickets WHERE "Status" <> 'closed'"""


@query(OPEN_SQL)
def open_by_severity(lake: Lake) -> DataFrame:
    return service_desk.open_by_severity(kept_tickets(lake))


WEEKS_SQL = """
    SELECT CAST(year("ModifiedOn") AS INTEGER) AS "Year", CAST(week("ModifiedOn") AS INTEGER) AS "Week",
        count(*) AS count, year("ModifiedOn") || '-' || week("ModifiedOn") AS "Year-Week"
    FROM kept_tickets WHERE "Status" = 'closed' GROUP BY ALL"""


@query(WEEKS_SQL)
def closed_by_week(lake: Lake) -> DataFrame:
    return service_desk.closed_by_week(kept_tickets(lake))


TWO_WEEKS_SQL = f"""
    SELECT (SELECT count FROM ({WEEKS_SQL}) ORDER BY "Year" DESC, "Week" DESC LIMIT 1) AS "CurrentWeek",
        (SELECT count FROM ({WEEKS_SQL}) ORDER BY "Year" DESC, "Week" DESC LIMIT 1 OFFSET 1) AS "PrevWeek" """


@query(TWO_WEEKS_SQL)
def closed_last_two_weeks(lake: Lake) -> DataFrame:
    return service_desk.closed_last_two_weeks(kept_tickets(lake))


@query(
    """SELECT CAST(year("ModifiedOn") AS INTEGER) AS "Year", CAST(month("ModifiedOn") AS INTEGER) AS "Month",
        count(*) AS count, year("ModifiedOn") || '-' || month("ModifiedOn") AS "Year-Month"
    FROM kept_tickets WHERE "Status" = 'closed' GROUP BY ALL"""
)
def closed_by_month(lake: Lake) -> DataFrame:
    return service_desk.closed_by_month(kept_tickets(lake))


def average_sql(rma: bool) -> str:
    """Half-down rounding of the mean days, overall and over the latest 15, 50 and 200."""

    def rounded_mean(condition: str) -> str:
        mean = f"CAST(avg(days) FILTER (WHERE {condition}) AS DECIMAL(30,15))"
        return f"CAST(ceil({mean} * 10 - 0.5) / 10 AS FLOAT)"

    return f"""
    SELECT {rounded_mean("true")} AS "All", {rounded_mean("rn <= 15")} AS "Last#15",
        {rounded_mean("rn <= 50")} AS "Last#50", {rounded_mean("rn <= 200")} AS "Last#200"
    FROM (SELECT (epoch_us("ModifiedOn") // 1000000 - epoch_us("CreatedOn") // 1000000) / 86400 AS days,
            row_number() OVER (ORDER BY "ModifiedOn" DESC, "Number" DESC) AS rn
        FROM kept_tickets WHERE "Status" = 'closed' AND "Type" {'=' if rma else '<>'} 'rma')"""


@query(average_sql(rma=False))
def avg_last_n(lake: Lake) -> DataFrame:
    return service_desk.average_resolution(kept_tickets(lake))


@query(average_sql(rma=True))
def avg_last_n_rma(lake: Lake) -> DataFrame:
    return service_desk.average_resolution(kept_tickets(lake), rma=True)


@query(
    """SELECT y."ASMSerial", y."ASMMetric", CAST(year(y.start) AS INTEGER) AS year, m.start AS item_start, m.records AS item_records,
        CAST(row_number() OVER (PARTITION BY y."ASMSerial", y."ASMMetric", year(y.start) ORDER BY m.start) - 1 AS INTEGER) AS position
    FROM yearly y JOIN monthly m ON y."ASMSerial" = m."ASMSerial" AND y."ASMMetric" = m."ASMMetric"
        AND year(y.start) = year(m.start)"""
)
def ordered_breakdown(lake: Lake) -> DataFrame:
    """Months of each year in order, unfolded with their position."""
    months = telemetry_rollups.intervals(telemetry_rollups.long_records(lake.device_metrics), "month")
    nested = nest(months, telemetry_rollups.KEYS, ["year"], ["start", "records"])
    unfolded = nested.select("ASMSerial", "ASMMetric", "year", F.posexplode("breakdown").alias("position", "item"))
    return unfolded.select(
        "ASMSerial", "ASMMetric", "year", F.col("item.start").alias("item_start"),
        F.col("item.records").alias("item_records"), "position",
    )


@query(
    """SELECT "EntityName" AS "Ticket", "Timestamp" AS time,
        second - lag(second) OVER (PARTITION BY "EntityName" ORDER BY second, "Timestamp") AS seconds
    FROM (SELECT *, epoch_us("Timestamp") // 1000000 AS second FROM activity)"""
)
def lag_delta(lake: Lake) -> DataFrame:
    """Seconds since the ticket's previous record."""
    records = lake.activity.select(
        F.col("EntityName").alias("Ticket"), F.col("Timestamp").alias("time"), F.unix_timestamp("Timestamp").alias("second")
    )
    stepped = with_previous(records, ["Ticket"], "second", "before", ["time"])
    return stepped.select("Ticket", "time", (F.col("second") - F.col("before")).alias("seconds"))


@query(
    """SELECT event_id, event_type, value, min(value) OVER w AS low, max(value) OVER w AS high, count(*) OVER w AS records,
        round(sum(value) OVER w, 2) AS total, round(avg(value) OVER w, 4) AS mean, round(stddev_samp(value) OVER w, 4) AS deviation
    FROM ev WINDOW w AS (PARTITION BY event_type)"""
)
def partition_aggs(lake: Lake) -> DataFrame:
    """Aggregates of the whole group on every row."""
    measures = [
        F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("records"),
        F.round(F.sum("value"), 2).alias("total"), F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev("value"), 4).alias("deviation"),
    ]
    return with_group_stats(lake.events.select("event_id", "event_type", "value"), ["event_type"], measures)


@query(
    """SELECT "ASMSerial", "ASMMetric", start, CAST(count(*) OVER w AS INTEGER) AS items, CAST(sum(records) OVER w AS BIGINT) AS listed,
        first_value(start) OVER w AS first_start
    FROM monthly WINDOW w AS (PARTITION BY "ASMSerial", "ASMMetric", year(start) ORDER BY start)"""
)
def running_list(lake: Lake) -> DataFrame:
    """Each month with the list of the months of its year so far (at most 12)."""
    months = telemetry_rollups.intervals(telemetry_rollups.long_records(lake.device_metrics), "month")
    in_year = Window.partitionBy("ASMSerial", "ASMMetric", F.year("start")).orderBy("start")
    listed = months.withColumn("list", F.collect_list(F.struct("start", "records")).over(in_year))
    total = F.aggregate("list", F.lit(0).cast("bigint"), lambda acc, i: acc + i["records"])
    return listed.select(
        "ASMSerial", "ASMMetric", "start", F.size("list").alias("items"), total.alias("listed"),
        F.col("list")[0]["start"].alias("first_start"),
    )
