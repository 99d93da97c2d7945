"""The user-level jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans import checkins, compaction, metric_history, service_desk, signal, telemetry_rollups, ticket_activity, usage
from ..sinks import files
from ..sources import files as sources
from .aggregates import OPEN_SQL, TWO_WEEKS_SQL, traffic, average_sql, kept_tickets, rounded
from .registry import query
from .scalars import DAYS_SQL, si_sql
from .scans import COVERAGE, flat_suites, write_coverage, write_self_tests
from .views import Lake

EXCLUDED = ".*((77)|(42)).*"


@query(
    """SELECT "ASMSerial", "timestamp-S" AS second, CASE WHEN altitude < 45 THEN altitude END AS "+1_1V_D",
        direction AS "Temperature__C", latitude AS altitude, CAST(altitude AS BIGINT) AS gps_fix, altitude > 25 AS "rx-lock"
    FROM device_metrics"""
)
def compact_metrics(lake: Lake) -> DataFrame:
    """Raw device-metrics JSON, one folder per device, to one compact table."""
    root = lake.work_dir("raw-metrics")
    wide = lake.device_metrics
    reading = F.when(F.col("altitude") < 45, F.col("altitude").cast("string")).otherwise("n/a")
    record = F.struct(
        "timestamp-S", reading.alias("+1.1V_D (V)"),
        F.col("direction").cast("string").alias("Temperature (C)"), F.col("latitude").alias("altitude"),
        F.col("altitude").cast("bigint").alias("gps_fix"), (F.col("altitude") > 25).alias("rx-lock"),
    )
    raw = wide.select(F.col("ASMSerial").alias("serial"), F.to_json(record).alias("record"))
    files.write_folders(raw, root, "serial", "record")
    table = compaction.compact(compaction.device_metrics_table(lake.spark, root), lake.work_dir("metrics"), files=4)
    return table.select(
        "ASMSerial", F.col("timestamp-S").alias("second"), "+1_1V_D", "Temperature__C", "altitude", "gps_fix", "rx-lock"
    )


@query(
    """SELECT 'AAE' || l_suppkey AS "ASMSerial", 'ANT' || l_suppkey AS antenna, s_name AS customer,
        CAST(s_nationkey % 2 AS BIGINT) AS status, l_returnflag || '-' || l_linestatus AS name,
        count(*) FILTER (WHERE l_discount > 0.09) AS failures, count(*) AS tests,
        CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS start_time, max(l_quantity) AS time
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0
    GROUP BY l_suppkey, s_name, s_nationkey, l_returnflag, l_linestatus"""
)
def compact_selftest(lake: Lake) -> DataFrame:
    root = lake.work_dir("raw-tests")
    write_self_tests(lake, root)
    return flat_suites(compaction.compact(compaction.self_test_table(lake.spark, root), lake.work_dir("tests")))


@query(
    """SELECT 'J-' || p_partkey AS jira, p_brand AS band, p_type AS pattern, DATE '2019-01-01' + p_size AS "Date",
        i.point AS point, p_retailprice + i.point AS primary_angle, p_size / 2.0::DOUBLE AS level
    FROM part, (VALUES (0), (1)) AS i(point)"""
)
def compact_chamber(lake: Lake) -> DataFrame:
    """Chamber measurements with nested setups and sample arrays."""
    root = lake.work_dir("raw-chamber")
    size = F.col("p_size")

    def sample(i: int):
        return F.struct(
            F.lit(i).alias("Point"), (F.col("p_retailprice") + i).alias("Primary"), (size / 2).alias("Ch1_dB")
        )

    lake.table("part").select(
        F.concat(F.lit("J-"), F.col("p_partkey").cast("string")).alias("jira"),
        F.col("p_brand").alias("band"),
        F.struct(F.col("p_type").alias("pattern_type")).alias("Tx"),
        F.date_add(F.lit("2019-01-01").cast("date"), size).alias("Date"),
        F.array(sample(0), sample(1)).alias("data"),
    ).write.json(root)
    table = compaction.compact(compaction.chamber_table(lake.spark, root), lake.work_dir("chamber"))
    return table.select("jira", "band", F.col("Tx.pattern_type").alias("pattern"), "Date", F.explode("data").alias("d")).select(
        "jira", "band", "pattern", "Date", F.col("d.Point").alias("point"), F.col("d.Primary").alias("primary_angle"),
        F.col("d.Ch1_dB").alias("level"),
    )


@query(
    """SELECT 3155378975999999999 - CAST(h."RowKey" AS BIGINT) AS "timestamp", h."Data", t."Name" AS "TerminalName",
        t."SN" AS "ModemSerial", m."Name" AS "MetricName", m."IntId" AS "MetricInt", m."Type" AS "MetricType",
        m."Status", m."AggregationType", m."Description"
    FROM metric_history h
    JOIN terminals t ON split_part(h."PartitionKey", '.', 1) = t.id
    JOIN metrics m ON split_part(h."PartitionKey", '.', 2) = m.id"""
)
def metric_history_load(lake: Lake) -> DataFrame:
    return metric_history.load(lake.metric_history, lake.terminals, lake.metrics)


_CHECKIN = '"ASMSerial", "Timestamp", "Type", "Device", CAST(NULL AS VARCHAR) AS "Label", CAST(NULL AS VARCHAR) AS "FsType", "Size", "Used", "Free", "MountPath", "SoftwareVersion"'


@query(f"SELECT {_CHECKIN} FROM checkins")
def device_clean(lake: Lake) -> DataFrame:
    return checkins.cleaned(lake.checkins)


@query(
    f"""SELECT {_CHECKIN} FROM (SELECT *, rank() OVER (PARTITION BY "ASMSerial" ORDER BY "Timestamp" DESC) AS rk FROM checkins)
    WHERE rk = 1"""
)
def device_latest(lake: Lake) -> DataFrame:
    return checkins.latest(lake.checkins)


@query(f"""SELECT {_CHECKIN} FROM checkins WHERE "ASMSerial" = 'AAE12' ORDER BY "Timestamp" """)
def device_by_serial(lake: Lake) -> DataFrame:
    return checkins.by_serial(lake.checkins, "AAE12")


@query(
    """SELECT a."EntityName" AS "Ticket", a."Timestamp" AS time, CAST(NULL AS VARCHAR) AS "OldValue",
        CASE WHEN u.time - a."Timestamp" <= INTERVAL 100 DAY THEN u."OldValue" END AS "NewValue"
    FROM (SELECT * FROM activity WHERE "Action" = 'addticket') a
    ASOF LEFT JOIN ticket_updates u ON a."EntityName" = u."Ticket" AND a."Timestamp" <= u.time
    UNION ALL SELECT "Ticket", time, "OldValue", "NewValue" FROM ticket_updates"""
)
def activity_timeline(lake: Lake) -> DataFrame:
    """Creations with their imputed status, and all updates."""
    return ticket_activity.activity_timeline(lake.activity)


_STATUS_COLUMN = """CAST(coalesce(sum(seconds) FILTER (WHERE "Status" = '{0}'), 0) AS BIGINT) AS {0}"""


@query(
    'SELECT "Ticket", '
    + ", ".join(
        _STATUS_COLUMN.format(s)
        for s in ("open", "pending", "waiting_on_3rd_party", "waiting_on_customer", "resolved", "closed")
    )
    + ' FROM status_spells GROUP BY "Ticket"'
)
def status_durations(lake: Lake) -> DataFrame:
    return ticket_activity.status_durations(lake.activity)


#: Samples are clicks, beam switches sign-ups, SNR readings views; the nations make the beam map.
_SIGNAL_SQL = """
    SELECT s.ts AS time, 'AAE' || s.user_id AS "ASMSerial", s.y AS "Latitude", s.x AS "Longitude",
        CAST(s.user_id + 1000000 AS INTEGER) AS "ModemSerial", s.beam_name AS "PulseBeamName", s.fwd AS "CoverageBeamName",
        s.x / 10 AS "pl-esno (ASMMetrics)", s.snr AS "SNR (Pulse)", CAST(e.n_nationkey / 2.0 AS DOUBLE) AS "C/N (coverage)",
        s.y / 2 AS "rx-theta (ASMMetrics)", CAST(s.k * 1000 AS BIGINT) AS "antenna-frequency-rx (ASMMetrics)"
    FROM (
        SELECT m.*, v.value AS snr FROM (
            SELECT c.event_id, c.ts, c.user_id, c.k, c.value AS x, CAST(c.k AS DOUBLE) AS y, b.fwd, b.beam_name
            FROM (SELECT * FROM ev WHERE event_type = 'click' AND user_id IN (SELECT c_custkey FROM customer)) c
            ASOF LEFT JOIN (
                SELECT epoch_us(h.ts) // 1000000 AS second, h.user_id, 'B' || n.n_regionkey AS fwd, n.n_name AS beam_name
                FROM ev h JOIN nation n ON CAST(round(h.value * 100) AS BIGINT) % 25 = n.n_nationkey
                JOIN customer ON c_custkey = h.user_id
                WHERE h.event_type = 'signup') b
            ON c.user_id = b.user_id AND epoch_us(c.ts) >= b.second * 1000000) m
        ASOF LEFT JOIN (SELECT user_id, round(value * 100) AS value, epoch_us(ts) // 1000000 AS second FROM ev WHERE event_type = 'view') v
        ON m.user_id = v.user_id AND epoch_us(m.ts) >= v.second * 1000000
        WHERE epoch_us(m.ts) - v.second * 1000000 <= 86400000000) s
    JOIN polygon_edges e ON s.fwd = e.beam
    GROUP BY s.event_id, s.ts, s.user_id, s.k, s.x, s.y, s.fwd, s.beam_name, s.snr, e.n_nationkey
    HAVING sum(CASE WHEN (e.y1 > s.y) <> (e.y2 > s.y)
        THEN CASE WHEN s.x < (e.x2 - e.x1) * (s.y - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END ELSE 0 END) % 2 = 1"""


@query(_SIGNAL_SQL)
def signal_vs_coverage(lake: Lake) -> DataFrame:
    path = lake.work_dir("coverage")
    write_coverage(lake, path)
    coverage = sources.read_geojson(lake.spark, path, COVERAGE)
    clicks = lake.events.filter(F.col("event_type") == "click")
    samples = clicks.select(
        F.col("ts").alias("time"),
        F.concat(F.lit("AAE"), F.col("user_id").cast("string")).alias("ASMSerial"),
        F.col("value").alias("longitude"),
        F.col("k").cast("double").alias("latitude"),
        (F.col("value") / 10).alias("pl-esno"),
        (F.col("k") / 2).alias("rx-theta"),
        (F.col("k") * 1000).cast("bigint").alias("antenna-frequency-rx"),
    )
    devices = lake.table("customer").select(
        F.concat(F.lit("AAE"), F.col("c_custkey").cast("string")).alias("AsmSerial"),
        (F.col("c_custkey") + 1000000).cast("string").alias("ModemSerial"),
    )
    history = metric_history.load(lake.metric_history, lake.terminals, lake.metrics)
    history = files.materialize(history, lake.work_dir("history"))
    history = history.withColumn("timestamp", F.timestamp_seconds("timestamp")).withColumn(
        "Data", F.when(F.col("MetricInt") == 1698, F.col("Data") % 25).otherwise(F.col("Data"))
    )
    beam_map = lake.table("nation").select(
        F.col("n_nationkey").cast("string").alias("BeamID"),
        F.col("n_name").alias("PulseBeamName"),
        F.concat(F.lit("B"), F.col("n_regionkey").cast("string")).alias("FWD"),
    )
    return signal.signal_vs_coverage(samples, devices, history, beam_map, coverage, cell=20.0)


def _breakdown_sql(parent: str, child: str, unit: str, month: bool) -> str:
    parts = 'CAST(year(p.start) AS INTEGER) AS year' + (', CAST(month(p.start) AS INTEGER) AS month' if month else "")
    return f"""
    SELECT p."ASMSerial", p."ASMMetric", {parts}, p.duration, p.start, p."end", p.records, p.avg,
        CAST(row_number() OVER (PARTITION BY p."ASMSerial", p."ASMMetric", p.start ORDER BY c.start) - 1 AS INTEGER) AS position,
        c.start AS item_start, c."end" AS item_end, c.records AS item_records, c.avg AS item_avg, c.max AS item_max,
        c.min AS item_min, round(c.stddev, 4) AS item_stddev
    FROM {parent} p JOIN {child} c ON p."ASMSerial" = c."ASMSerial" AND p."ASMMetric" = c."ASMMetric"
        AND date_trunc('{unit}', p.start) = date_trunc('{unit}', c.start)"""


def _unfolded(nested: DataFrame, parts: list[str]) -> DataFrame:
    rows = nested.select(
        "ASMSerial", "ASMMetric", *parts, "duration", "start", "end", "records", "avg",
        F.posexplode("breakdown").alias("position", "i"),
    )
    items = [F.col(f"i.{c}").alias(f"item_{c}") for c in ("start", "end", "records", "avg", "max", "min", "stddev")]
    return rounded(rows.select("*", *items).drop("i"), "item_stddev")


@query(_breakdown_sql("yearly", "monthly", "year", month=False))
def rollup_breakdown_year(lake: Lake) -> DataFrame:
    """Years with their months, one row per month."""
    records = telemetry_rollups.long_records(lake.device_metrics)
    return _unfolded(telemetry_rollups.yearly_breakdown(records), ["year"])


@query(_breakdown_sql("monthly", "daily", "month", month=True))
def rollup_breakdown_month(lake: Lake) -> DataFrame:
    """Months with their days, one row per day."""
    records = telemetry_rollups.long_records(lake.device_metrics)
    return _unfolded(telemetry_rollups.monthly_breakdown(records), ["year", "month"])


@query(
    f"""SELECT r."Id" AS "RemoteId", r."Name" AS "RemoteName", m."ModemSerial" AS "RemoteSerial", m.year, m.month, m.start,
        m."end", m.records, m.used, {si_sql("m.used")} AS "SI",
        CAST(row_number() OVER (PARTITION BY r."Id", m.year, m.month ORDER BY d.start) - 1 AS INTEGER) AS position,
        d.start AS day_start, d.records AS day_records, d.used AS day_used
    FROM usage_months m JOIN usage_days d ON m."ModemSerial" = d."ModemSerial" AND m.year = year(d.start) AND m.month = month(d.start)
    JOIN remotes r ON r."ModemSerial" = m."ModemSerial" """
)
def usage_by_remote(lake: Lake) -> DataFrame:
    """Monthly traffic per remote, one row per day of its breakdown."""
    report = usage.usage_by_remote(traffic(lake), lake.remotes)
    rows = report.select(
        "RemoteId", "RemoteName", "RemoteSerial", "year", "month", "start", "end", "records",
        "used", "SI", F.posexplode("breakdown").alias("position", "d"),
    )
    return rows.select(
        "*", F.col("d.start").alias("day_start"), F.col("d.records").alias("day_records"),
        F.col("d.used").alias("day_used"),
    ).drop("d")


_PRIORITY = "count(*) FILTER (WHERE coalesce(\"Priority\", 'normal') = '{0}') AS {0}"


@query(
    'SELECT "Status", ' + ", ".join(_PRIORITY.format(p) for p in ("high", "low", "normal", "urgent"))
    + ' FROM kept_tickets GROUP BY "Status"'
)
def status_priority(lake: Lake) -> DataFrame:
    return service_desk.status_priority(kept_tickets(lake))


@query(
    """SELECT "Number", "Priority", "Subject", "CreatedOn" FROM kept_tickets ORDER BY "CreatedOn" DESC, "Number" DESC LIMIT 20"""
)
def last20_created(lake: Lake) -> DataFrame:
    return service_desk.last_created(kept_tickets(lake))


@query(
    """SELECT "Number", "Priority", "Subject",
        (epoch_us("ModifiedOn") // 1000000 - epoch_us("CreatedOn") // 1000000) / 86400 AS "ResolutionTime_Days"
    FROM kept_tickets WHERE "Status" = 'closed' AND "Type" <> 'rma' ORDER BY "ModifiedOn" DESC, "Number" DESC LIMIT 20"""
)
def last20_closed(lake: Lake) -> DataFrame:
    return service_desk.last_closed(kept_tickets(lake))


@query(
    """SELECT "AccountId", a."Name", round(sum((epoch_us("ModifiedOn") // 1000000 - epoch_us("CreatedOn") // 1000000) / 86400), 4) AS "Total Days"
    FROM kept_tickets t JOIN kept_accounts a ON a."Id" = t."AccountId" GROUP BY "AccountId", a."Name" """
)
def resolution_by_account(lake: Lake) -> DataFrame:
    report = service_desk.resolution_by_account(kept_tickets(lake), lake.accounts, EXCLUDED)
    return rounded(report, "Total Days")


@query(
    f"""SELECT "AccountId", a."Name" AS "AccountName", t."Number", {DAYS_SQL} AS "Days", "Subject"
    FROM kept_tickets t JOIN kept_accounts a ON a."Id" = t."AccountId" ORDER BY t."Number" DESC"""
)
def tickets_by_account(lake: Lake) -> DataFrame:
    return service_desk.tickets_by_account(kept_tickets(lake), lake.accounts, EXCLUDED)


@query(
    """SELECT DISTINCT "AccountId", a."Name" AS "AccountName"
    FROM kept_tickets t JOIN kept_accounts a ON a."Id" = t."AccountId" """
)
def account_list(lake: Lake) -> DataFrame:
    return service_desk.account_list(kept_tickets(lake), lake.accounts, EXCLUDED)


@query(
    """SELECT "Number", "Priority", "Status", "Subject", "Type", "CreatedOn" FROM kept_tickets
    WHERE "Status" <> 'closed' ORDER BY "Number" DESC"""
)
def wip_tickets(lake: Lake) -> DataFrame:
    return service_desk.work_in_progress(kept_tickets(lake))


@query(
    f"""SELECT o."All" AS open_all, o."SeverityLevel1" AS open_1, o."SeverityLevel2" AS open_2, o."SeverityLevel3" AS open_3,
        w."CurrentWeek" AS current_week, w."PrevWeek" AS previous_week, r."All" AS days_all, r."Last#15" AS days_15,
        r."Last#50" AS days_50, r."Last#200" AS days_200, x."All" AS rma_all, x."Last#15" AS rma_15, x."Last#50" AS rma_50,
        x."Last#200" AS rma_200
    FROM ({OPEN_SQL}) o, ({TWO_WEEKS_SQL}) w, ({average_sql(False)}) r, ({average_sql(True)}) x"""
)
def ticket_stats(lake: Lake) -> DataFrame:
    """The four maps of the summary, laid out as columns."""
    stats = service_desk.ticket_stats(kept_tickets(lake))
    columns = {
        "open_all": ("Open", "All"), "open_1": ("Open", "SeverityLevel1"), "open_2": ("Open", "SeverityLevel2"),
        "open_3": ("Open", "SeverityLevel3"), "current_week": ("Closed", "CurrentWeek"), "previous_week": ("Closed", "PrevWeek"),
        "days_all": ("ResolutionTime", "All"), "days_15": ("ResolutionTime", "Last#15"),
        "days_50": ("ResolutionTime", "Last#50"), "days_200": ("ResolutionTime", "Last#200"),
        "rma_all": ("RMAResolutionTime", "All"), "rma_15": ("RMAResolutionTime", "Last#15"),
        "rma_50": ("RMAResolutionTime", "Last#50"), "rma_200": ("RMAResolutionTime", "Last#200"),
    }
    return stats.select(*[F.col(m)[k].alias(name) for name, (m, k) in columns.items()])
