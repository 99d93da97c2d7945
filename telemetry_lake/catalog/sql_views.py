"""SQL twins of the views in :mod:`views`, in dependency order."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "tickets": """
        SELECT o_orderkey AS "Id", o_orderkey AS "Number",
            CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' WHEN 'P' THEN 'pending' END AS "Status",
            CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
                WHEN '3-MEDIUM' THEN 'normal' WHEN '5-LOW' THEN 'low' END AS "Priority",
            CASE WHEN o_totalprice < 60000 THEN 'rma' ELSE 'support' END AS "Type",
            CAST(o_orderdate AS TIMESTAMP) AS "CreatedOn",
            CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 90 AS INTEGER))
                + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "ModifiedOn",
            o_custkey AS "AccountId", 'T-' || o_orderkey AS "Subject"
        FROM orders""",
    "tags": """
        SELECT o_orderkey AS "EntityId", CASE WHEN o_totalprice > 490000 THEN 'vip' ELSE 'ignore' END AS "Name"
        FROM orders WHERE o_totalprice BETWEEN 100000 AND 110000 OR o_totalprice > 490000""",
    "kept_tickets": """
        SELECT * FROM tickets t
        WHERE NOT EXISTS (SELECT 1 FROM tags g WHERE g."Name" = 'ignore' AND g."EntityId" = t."Id")""",
    "accounts": """
        SELECT c_custkey AS "Id", c_name AS "Name", c_custkey AS "Number" FROM customer""",
    "kept_accounts": """
        SELECT * FROM accounts WHERE NOT regexp_matches("Name", '.*((77)|(42)).*')""",
    "ev": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "device_metrics": """
        SELECT CASE WHEN l_suppkey % 5 = 0 THEN 'TEST' ELSE 'AAE' END || l_suppkey AS "ASMSerial",
            epoch_us(CAST(l_shipdate AS TIMESTAMP)) // 1000000 AS "timestamp-S",
            l_quantity AS altitude, round(l_extendedprice * 100) AS direction,
            round(l_discount * 100) AS latitude, round(l_tax * 100) AS longitude
        FROM lineitem""",
    "long_records": """
        SELECT DISTINCT "ASMSerial", make_timestamp("timestamp-S" * 1000000) AS "timestamp", "ASMMetric", data FROM (
            SELECT "ASMSerial", "timestamp-S", 'ASM-ALTITUDE' AS "ASMMetric", altitude AS data FROM device_metrics
            UNION ALL SELECT "ASMSerial", "timestamp-S", 'ASM-DIRECTION', direction FROM device_metrics
            UNION ALL SELECT "ASMSerial", "timestamp-S", 'ASM-LATITUDE', latitude FROM device_metrics
            UNION ALL SELECT "ASMSerial", "timestamp-S", 'ASM-LONGITUDE', longitude FROM device_metrics)
        WHERE "ASMSerial" LIKE 'AAE%'""",
    "yearly": """
        SELECT "ASMSerial", "ASMMetric", 'year' AS duration, min("timestamp") AS start, max("timestamp") AS "end",
            count(data) AS records, avg(data) AS avg, max(data) AS max, min(data) AS min, stddev_samp(data) AS stddev
        FROM long_records GROUP BY "ASMSerial", "ASMMetric", year("timestamp")""",
    "monthly": """
        SELECT "ASMSerial", "ASMMetric", 'month' AS duration, min("timestamp") AS start, max("timestamp") AS "end",
            count(data) AS records, avg(data) AS avg, max(data) AS max, min(data) AS min, stddev_samp(data) AS stddev
        FROM long_records GROUP BY "ASMSerial", "ASMMetric", year("timestamp"), month("timestamp")""",
    "daily": """
        SELECT "ASMSerial", "ASMMetric", 'day' AS duration, min("timestamp") AS start, max("timestamp") AS "end",
            count(data) AS records, avg(data) AS avg, max(data) AS max, min(data) AS min, stddev_samp(data) AS stddev
        FROM long_records GROUP BY "ASMSerial", "ASMMetric", date_trunc('day', "timestamp")""",
    "metric_history": """
        SELECT user_id || '.' || event_type || '.' || (user_id * 100 + k) AS "PartitionKey",
            CAST(3155378975999999999 - epoch_us(ts) // 1000000 AS VARCHAR) AS "RowKey",
            round(value * 100) AS "Data", 'gauge' AS "Type", ts AS "Timestamp"
        FROM ev""",
    "metrics": """
        SELECT DISTINCT event_type AS id, upper(event_type) AS "Name",
            CAST(CASE event_type WHEN 'click' THEN 1054 WHEN 'purchase' THEN 1055 WHEN 'view' THEN 1098
                WHEN 'signup' THEN 1698 WHEN 'error' THEN 1 END AS INTEGER) AS "IntId",
            'counter' AS "Type", 'active' AS "Status", 'sum' AS "AggregationType",
            'metric ' || event_type AS "Description"
        FROM events""",
    "terminals": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS "Name", c_custkey + 1000000 AS "SN" FROM customer""",
    "terminal_properties": """
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS "TerminalId", user_id + 1000000 AS "SN",
            CAST(user_id * 100 + k AS VARCHAR) AS "Id", 'k' || k AS "Key", CAST(k AS VARCHAR) AS "Value",
            CASE WHEN k < 10 THEN 'x:NMS_SSPP' ELSE 'x:SSPP' || k END AS "Description"
        FROM ev""",
    "remotes": """
        SELECT 'R' || c_custkey AS "Id", c_name AS "Name",
            CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey + 1000000 END AS "ModemSerial"
        FROM customer""",
    "traffic": """
        SELECT make_timestamp((3155378975999999999 - CAST(h."RowKey" AS BIGINT)) * 1000000) AS "timestamp",
            t."SN" AS "ModemSerial", m."IntId" AS "MetricIntId", h."Data",
            split_part(p."Description", ':', 2) AS "SSPP"
        FROM metric_history h
        JOIN terminals t ON split_part(h."PartitionKey", '.', 1) = t.id
        JOIN metrics m ON split_part(h."PartitionKey", '.', 2) = m.id
        JOIN terminal_properties p ON split_part(h."PartitionKey", '.', 3) = p."Id"
        WHERE m."IntId" IN (1054, 1055) AND split_part(p."Description", ':', 2) NOT LIKE '%NMS_SSPP%'""",
    "usage_months": """
        SELECT "ModemSerial", CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
            min("timestamp") AS start, max("timestamp") AS "end", count("timestamp") AS records,
            sum("Data") AS used
        FROM traffic GROUP BY 1, 2, 3""",
    "usage_days": """
        SELECT "ModemSerial", min("timestamp") AS start, max("timestamp") AS "end", count("timestamp") AS records,
            sum("Data") AS used
        FROM traffic GROUP BY "ModemSerial", date_trunc('day', "timestamp")""",
    "activity": """
        SELECT CAST(user_id AS VARCHAR) AS "EntityName", ts AS "Timestamp",
            CASE WHEN event_type = 'signup' THEN 'addticket' ELSE 'updateticket' END AS "Action",
            CASE WHEN event_type = 'signup' THEN NULL WHEN value > 200 THEN 'priority' ELSE 'status' END AS "FieldName",
            CASE event_type WHEN 'click' THEN 'open' WHEN 'view' THEN 'pending' WHEN 'purchase' THEN 'resolved'
                WHEN 'error' THEN 'closed' END AS "OldValue",
            CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'resolved' WHEN 'purchase' THEN 'closed'
                WHEN 'error' THEN 'open' END AS "NewValue"
        FROM ev""",
    "ticket_updates": """
        SELECT "EntityName" AS "Ticket", "Timestamp" AS time, "OldValue", "NewValue" FROM activity
        WHERE "Action" = 'updateticket' AND "FieldName" = 'status'""",
    "status_spells": """
        SELECT * FROM (
            SELECT "Ticket", "OldValue" AS "Status", second - lag(second) OVER (PARTITION BY "Ticket" ORDER BY second, time) AS seconds
            FROM (
                SELECT "Ticket", time, "OldValue", epoch_us(time) // 1000000 AS second FROM ticket_updates
                UNION ALL SELECT "EntityName", "Timestamp", NULL, epoch_us("Timestamp") // 1000000
                FROM activity WHERE "Action" = 'addticket'))
        WHERE "Status" IS NOT NULL AND seconds IS NOT NULL""",
    "checkins": """
        SELECT CASE user_id % 3 WHEN 0 THEN 'AAE' WHEN 1 THEN 'TEST' ELSE 'LAB' END || user_id AS "ASMSerial",
            ts AS "Timestamp",
            CASE WHEN event_type <> 'error' THEN event_type END AS "Type",
            CASE WHEN event_type <> 'error' THEN '/dev/sd' || k END AS "Device",
            CASE WHEN event_type <> 'error' THEN CAST(k AS BIGINT) * 1000 END AS "Size",
            CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS "Used",
            CASE WHEN event_type <> 'error' THEN CAST(k AS BIGINT) * 1000 - CAST(floor(value) AS BIGINT) END AS "Free",
            CASE WHEN event_type <> 'error' THEN '/' END AS "MountPath",
            CASE WHEN event_type <> 'error' THEN 'v' || k END AS "SoftwareVersion"
        FROM ev WHERE user_id % 3 < 2""",
    "region_changes": """
        SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
            CASE WHEN event_type <> 'view' THEN event_type || '-' || k END AS value
        FROM ev WHERE event_type IN ('click', 'signup', 'view')""",
    "metric_changes": """
        SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
            CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS value
        FROM ev WHERE event_type IN ('purchase', 'error')""",
    "region_table": """
        SELECT key, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS rn FROM region_changes)
        WHERE rn = 1 AND value IS NOT NULL""",
    "metric_table": """
        SELECT key, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS rn FROM metric_changes)
        WHERE rn = 1 AND value IS NOT NULL""",
    "keyed": """
        SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset", ts, CAST(floor(value) AS BIGINT) AS metric,
            event_type || '-' || k AS label, user_id, event_type
        FROM ev""",
    "polygon_edges": """
        SELECT n_nationkey, 'B' || n_regionkey AS beam,
            (n_nationkey // 5) * 25.0::DOUBLE + 15 + e.x1 AS x1, (n_nationkey // 5) * 15.0::DOUBLE + 20 + e.y1 AS y1,
            (n_nationkey // 5) * 25.0::DOUBLE + 15 + e.x2 AS x2, (n_nationkey // 5) * 15.0::DOUBLE + 20 + e.y2 AS y2
        FROM nation, (VALUES (-12, -15, 12, -12), (12, -12, 5, 0), (5, 0, 14, 18), (14, 18, -10, 10),
            (-10, 10, -12, -15)) AS e(x1, y1, x2, y2)""",
    "points": """
        SELECT event_id, value AS x, CAST(k AS DOUBLE) AS y, 'B' || (user_id % 5) AS point_beam FROM ev""",
}
