from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from telemetry_lake.functions.numbers import round_half_down
from telemetry_lake.operators import rollups
from telemetry_lake.plans import checkins, compaction, metric_history, service_desk, telemetry_rollups, ticket_activity, usage
from telemetry_lake.schemas import QUOTED_METRICS, SELF_TEST_FULL, device_metrics
from telemetry_lake.sinks import files
from telemetry_lake.sources import files as sources
from telemetry_lake.sources.files import with_path_serial


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_device_metrics_are_compacted(spark, tmp_path):
    sample = {"+1.1V_D (V)": "1.099", "Temperature (C)": "n/a", "altitude": 0.5, "gps_fix": 1, "rx-lock": True, "timestamp-S": 1547786073}
    put(tmp_path / "raw/AAE1/a.json", json.dumps(sample) + "\nbroken {\n")
    put(tmp_path / "raw/AAE2/deep/b.json", json.dumps({**sample, "+1.1V_D (V)": "2.5"}) + "\n")
    table = compaction.compact(compaction.device_metrics_table(spark, str(tmp_path / "raw")), str(tmp_path / "out"), files=4)
    rows = {(r["ASMSerial"], r["+1_1V_D"], r["Temperature__C"], r["timestamp-S"], r["rx-lock"]) for r in table.collect()}
    assert rows == {("AAE1", 1.099, None, 1547786073, True), ("AAE1", None, None, None, None), ("AAE2", 2.5, None, 1547786073, True)}
    assert len(table.columns) == 54 and len(device_metrics()) == 53
    assert len([f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet")]) <= 4
    back = compaction.load_device_metrics(spark, str(tmp_path / "out"))
    assert set(QUOTED_METRICS) < set(back.columns)


def test_self_tests_drop_broken_documents(spark, tmp_path):
    document = {
        "asm-serial-number": "S", "status": 3,
        "testsuites": [{"name": "rf", "tests": 2, "failures": 1, "start-time": "t", "time": 0.5,
                        "testsuite": [{"name": "x", "testcase": [{"name": "c", "data": {"values": [1.5, 2.5]}}]}]}],
    }
    put(tmp_path / "raw/AAE1/a.json", json.dumps(document, indent=2))
    put(tmp_path / "raw/AAE2/a.json", '{\n "status": ')
    root = str(tmp_path / "raw")
    pruned = compaction.self_test_table(spark, root).collect()
    assert [(r["ASMSerial"], r["status"], r["testsuites"][0]["start-time"]) for r in pruned] == [("AAE1", 3, "t")]
    assert "testsuite" not in pruned[0]["testsuites"][0].asDict()
    full = compaction.self_test_table(spark, root, SELF_TEST_FULL).first()
    assert full["testsuites"][0]["testsuite"][0]["testcase"][0]["data"]["values"] == [1.5, 2.5]


def test_chamber_files_that_differ_line_up(spark, tmp_path):
    put(tmp_path / "raw/a/x.json", '{"jira":"J1","Date":"2019-02-03","Rx":{"wave_equation_parameters":{"phi":1.5}},"lib_version":"7"}\n')
    put(tmp_path / "raw/b/y.json", '{"data":[{"Point":1,"Ch1_dB":-3.5}],"jira":"J2"}\n')
    rows = compaction.chamber_table(spark, str(tmp_path / "raw"), "lib_version string").orderBy("jira").collect()
    assert (str(rows[0]["Date"]), rows[0]["Rx"]["wave_equation_parameters"]["phi"], rows[0]["lib_version"]) == ("2019-02-03", 1.5, "7")
    assert rows[1]["data"][0]["Ch1_dB"] == -3.5 and rows[1]["Tx"] is None


def test_text_nulls(spark, tmp_path):
    put(tmp_path / "t.csv", "1,a\n2,\\N\n\\N,\n")
    rows = sources.read_text_nulls(spark, str(tmp_path / "t.csv"), "n int, s string").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None), (None, None)]


def test_geojson_keeps_polygons_only(spark, tmp_path):
    features = [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "properties": {"fwd_cn (dB)": 3.5}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"Beam Info": "B"}},
    ]
    put(tmp_path / "c.geojson", json.dumps({"type": "FeatureCollection", "features": features[:1]}, indent=1))
    rows = sources.read_geojson(spark, str(tmp_path / "c.geojson"), {"cn": "fwd_cn (dB)", "beam": "Beam Info"}).collect()
    assert rows[0]["cn"] == "3.5" and rows[0]["beam"] is None
    assert [tuple(p) for p in rows[0]["polygon"][0]] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


HISTORY = "PartitionKey string, RowKey string, Data double"


@pytest.fixture
def history(spark, tmp_path):
    base, staging, ledger = (str(tmp_path / n) for n in ("data", "to_process", "ledger"))
    spark.createDataFrame([("a", "900", 1.0), ("b", "800", None)], HISTORY).write.parquet(f"{base}/800")
    spark.createDataFrame([("c", "700", 3.0)], HISTORY).write.parquet(f"{base}/700")
    return base, staging, ledger


def stage(spark, staging, rows):
    spark.createDataFrame(rows, HISTORY).write.mode("append").parquet(f"{staging}/x")


def keys(spark, base, name):
    return sorted(r["RowKey"] for r in spark.read.parquet(f"{base}/{name}").collect())


def test_increment_against_latest(spark, history):
    base, staging, ledger = history
    stage(spark, staging, [("c", "700", 3.0), ("d", "600", 4.0), ("d", "600", 4.0), ("b", "800", None)])
    assert metric_history.process_staging(spark, staging, base, ledger) == "600"
    assert keys(spark, base, "600") == ["600", "800"]
    # The same files again, as after a crash before clean-up: nothing is added.
    assert metric_history.process_staging(spark, staging, base, ledger) is None
    stage(spark, staging, [("e", "500", 5.0)])
    assert metric_history.process_staging(spark, staging, base, ledger) == "500"
    assert keys(spark, base, "500") == ["500"]
    assert metric_history.newest_batch(spark, base) == "500"


def test_late_row_does_not_replace_a_batch(spark, history):
    base, staging, ledger = history
    stage(spark, staging, [("z", "650", 3.0)])
    assert metric_history.process_staging(spark, staging, base, ledger) == "650"
    stage(spark, staging, [("late", "650", 9.0)])
    name = metric_history.process_staging(spark, staging, base, ledger)
    assert name.startswith("650-")
    assert keys(spark, base, "650") == ["650"] and keys(spark, base, name) == ["650"]


def test_repeat_before_the_ledger_was_written(spark, history, monkeypatch):
    base, staging, ledger = history
    stage(spark, staging, [("c", "700", 3.0), ("d", "600", 4.0), ("b", "800", None)])

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(metric_history, "record_processed", crash)
        with pytest.raises(RuntimeError):
            metric_history.process_staging(spark, staging, base, ledger)
    before = keys(spark, base, "600")
    names = metric_history.batch_names(spark, base)
    assert metric_history.process_staging(spark, staging, base, ledger) == "600"
    assert keys(spark, base, "600") == before and metric_history.batch_names(spark, base) == names


def test_first_ingestion(spark, history, tmp_path):
    _, staging, ledger = history
    stage(spark, staging, [("c", "700", 3.0), ("c", "700", 3.0)])
    base = str(tmp_path / "new-base")
    assert metric_history.process_staging(spark, staging, base, ledger) == "700"
    assert keys(spark, base, "700") == ["700"]


def test_other_priorities_have_a_column(spark):
    tickets = spark.createDataFrame([("open", "critical"), ("open", None), ("closed", "low")], "Status string, Priority string")
    rows = {r["Status"]: r for r in service_desk.status_priority(tickets).collect()}
    assert rows["open"]["critical"] == 1 and rows["open"]["normal"] == 1 and rows["closed"]["critical"] == 0


def test_group_stats_keep_missing_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, v int")
    rows = rollups.with_group_stats(df, ["k"], [F.sum("v").alias("total")]).collect()
    assert sorted((str(r["k"]), r["v"], r["total"]) for r in rows) == [("None", 1, 4), ("None", 3, 4), ("a", 2, 2)]


def test_large_values_stay(spark):
    df = spark.createDataFrame([(2e15,), (float("nan"),), (0.25,), (None,), (-1e300,)], "v double")
    got = [r[0] for r in df.select(round_half_down(F.col("v"))).collect()]
    assert got[0] == pytest.approx(2e15, rel=1e-6) and got[1] != got[1] and got[2] == pytest.approx(0.2) and got[3] is None and got[4] < -3e38


def test_serial_of_odd_paths(spark, tmp_path):
    root = tmp_path / "a root+x"
    spark.range(1).write.parquet(f"{root}/dev 1/files")
    for given in (str(root), str(tmp_path / "a*x")):
        scan = spark.read.option("recursiveFileLookup", "true").parquet(str(root))
        assert with_path_serial(scan, given).first()["ASMSerial"] == "dev 1"
    with pytest.raises(Exception, match="no serial"):
        with_path_serial(spark.read.parquet(f"{root}/dev 1/files"), "/elsewhere").collect()


def test_increment_against_all(spark, history):
    base, staging, ledger = history
    stage(spark, staging, [("b", "800", None), ("d", "600", 4.0)])
    assert metric_history.process_staging(spark, staging, base, ledger, against="all") == "600"
    assert keys(spark, base, "600") == ["600"]


def test_except_removes_copies_and_equal_nulls(spark):
    staged = spark.createDataFrame([("a", None, 1.0)] * 3 + [("b", "1", 2.0)], HISTORY)
    known = spark.createDataFrame([("b", "1", 2.0)], HISTORY)
    assert [tuple(r) for r in metric_history.new_rows(staged, known).collect()] == [("a", None, 1.0)]


def test_pooled_statistics_equal_direct_ones(spark):
    day = 86400
    rows = [("AAE1", s * day // 3, float((s * 7919) % 1000) + 1e6, float(s % 5)) for s in range(1500)] + [("AAE2", 0, 1.0, 2.0)]
    wide = spark.createDataFrame(rows, "ASMSerial string, `timestamp-S` bigint, altitude double, speed double")
    records = telemetry_rollups.long_records(wide)
    years, months = telemetry_rollups.yearly_breakdown(records), telemetry_rollups.monthly_breakdown(records)
    for nested, period in ((years, "year"), (months, "month")):
        direct = telemetry_rollups.intervals(records, period).select(*nested.columns[:2], *telemetry_rollups.ITEM)
        got = {tuple(r)[:4]: r for r in nested.select(*direct.columns).collect()}
        want = {tuple(r)[:4]: r for r in direct.collect()}
        assert got.keys() == want.keys()
        for k, row in want.items():
            assert (got[k]["records"], got[k]["max"], got[k]["min"]) == (row["records"], row["max"], row["min"])
            assert got[k]["avg"] == pytest.approx(row["avg"], rel=1e-12)
            assert got[k]["stddev"] == (None if row["stddev"] is None else pytest.approx(row["stddev"], rel=1e-9))


def test_months_and_their_days_follow_the_zone(spark):
    """A month that ends within a UTC day does not take the first hours of the next one."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        end = 1548997200  # 21:00 of 31 January there, 5:00 of 1 February in UTC
        rows = [("AAE1", end, 1.0), ("AAE1", end + 4 * 3600, 2.0), ("AAE1", end - 6 * 3600, 4.0)]
        records = telemetry_rollups.long_records(
            spark.createDataFrame(rows, "ASMSerial string, `timestamp-S` bigint, altitude double")
        )
        months = {r["month"]: r for r in telemetry_rollups.monthly_breakdown(records).collect()}
        assert {m: (r["records"], r["avg"], [d["records"] for d in r["breakdown"]]) for m, r in months.items()} == {
            1: (2, 2.5, [2]), 2: (1, 2.0, [1]),
        }
        direct = {(r["records"], r["avg"]) for r in telemetry_rollups.intervals(records, "month").collect()}
        assert direct == {(2, 2.5), (1, 2.0)}
        traffic = spark.createDataFrame([("m", float(d), t) for _, t, d in rows], "ModemSerial string, Data double, t bigint")
        traffic = traffic.select("ModemSerial", "Data", F.timestamp_seconds("t").alias("timestamp"))
        remotes = spark.createDataFrame([("r", "name", "m")], "Id string, Name string, ModemSerial string")
        used = {r["month"]: (r["used"], len(r["breakdown"])) for r in usage.usage_by_remote(traffic, remotes).collect()}
        assert used == {1: (5.0, 1), 2: (2.0, 1)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_records_are_distinct_per_metric(spark):
    rows = [
        ("AAE1", 5, 1.0, 7.0), ("AAE1", 5, 1.0, 7.0), ("AAE1", 5, 1.0, 8.0), ("AAE1", 5, None, 7.0), ("AAE1", 6, 1.0, 7.0),
        ("AAE1", None, 1.0, 7.0), ("TEST1", 5, 1.0, 7.0), ("AAE2", 9, 2.0, float("nan")),
    ]
    wide = spark.createDataFrame(rows, "ASMSerial string, `timestamp-S` bigint, altitude double, speed double")
    got = telemetry_rollups.long_records(wide).select("ASMSerial", F.unix_timestamp("timestamp"), "ASMMetric", "data")
    assert sorted(map(tuple, got.collect())) == [
        ("AAE1", 5, "ASM-ALTITUDE", 1.0), ("AAE1", 5, "ASM-SPEED", 7.0), ("AAE1", 5, "ASM-SPEED", 8.0),
        ("AAE1", 6, "ASM-ALTITUDE", 1.0), ("AAE1", 6, "ASM-SPEED", 7.0), ("AAE2", 9, "ASM-ALTITUDE", 2.0),
    ]


def test_rollups_shuffle_no_values(spark, monkeypatch):
    """Values meet where the wide rows of a device and month were dealt, in as many tasks as they are many."""
    monkeypatch.setattr(telemetry_rollups, "TASK_VALUES", 10)
    rows = [("AAE1", s * 43200, float(s), float(s % 5)) for s in range(100)]
    wide = spark.createDataFrame(rows, "ASMSerial string, `timestamp-S` bigint, altitude double, speed double")
    records = telemetry_rollups.long_records(wide)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (telemetry_rollups.intervals(records, p) for p in ("day", "date", "month")):
        assert plan(df).count("Exchange") == 2 and "hashpartitioning(ASMSerial" in plan(df)
    assert plan(telemetry_rollups.monthly_breakdown(records)).count("Exchange") == 2
    assert "20), REPARTITION_BY_NUM" in plan(records)
    days = telemetry_rollups.intervals(records, "day").filter("ASMMetric = 'ASM-ALTITUDE'").collect()
    assert len(days) == 50 and all(d["records"] == 2 for d in days)


def test_nested_trees_are_small(spark, tmp_path):
    """Stored records are shuffled once for months and their days, and the trees take a fraction of their text."""
    rows = [("AAE1", s * 43200, float(s), float(s % 5)) for s in range(400)]
    wide = spark.createDataFrame(rows, "ASMSerial string, `timestamp-S` bigint, altitude double, speed double")
    records = files.materialize(telemetry_rollups.long_records(wide), str(tmp_path / "records"))
    years = telemetry_rollups.yearly_breakdown(records)
    months = telemetry_rollups.monthly_breakdown(telemetry_rollups.dealt(records))
    assert months._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    sizes = {}
    for kind in ("none", "gzip"):
        _, path = files.write_nested_periods(years, months, str(tmp_path / kind), ["ASMMetric"], kind)
        written = [p for p in (tmp_path / kind / "monthly").rglob("part-*")]
        sizes[kind] = sum(p.stat().st_size for p in written)
        read = spark.read.schema(months.drop("duration").schema).json(path)
        assert read.count() == months.count() and read.exceptAll(months.select(read.columns)).isEmpty()
    assert sizes["gzip"] < sizes["none"] / 4


def test_daily_usage_adds_up(spark):
    rows = [(1, h * 3600, float(h)) for h in range(24 * 70)]
    records = spark.createDataFrame(rows, "ModemSerial bigint, s bigint, Data double").withColumn("timestamp", F.timestamp_seconds("s"))
    remotes = spark.createDataFrame([("R", "n", 1), ("S", "m", None)], "Id string, Name string, ModemSerial bigint")
    report = usage.usage_by_remote(records, remotes).orderBy("start").collect()
    assert len(report) == 3 and all(r["used"] == sum(d["used"] for d in r["breakdown"]) for r in report)
    assert sum(r["records"] for r in report) == len(rows)
    assert [d["start"] for r in report for d in r["breakdown"]] == sorted(d["start"] for r in report for d in r["breakdown"])


def test_checkins_with_ties(spark):
    document = '{"Type":"ext4","Size":10,"Used":4}'
    rows = [("AAE1", 1, document), ("AAE1", 2, document), ("AAE1", 2, "{"), ("LAB9", 9, document), ("TEST1", None, document)]
    raw = spark.createDataFrame(rows, "PartitionKey string, t int, ActivePartition string").withColumnRenamed("t", "Timestamp")
    latest = sorted((r["ASMSerial"], r["Timestamp"], r["Free"]) for r in checkins.latest(raw).collect() if r["Free"])
    assert latest == [("AAE1", 2, 6)] and checkins.latest(raw).count() == 2


TICKETS = "Id int, Number int, Status string, Priority string, Type string, CreatedOn timestamp, ModifiedOn timestamp, Subject string"


def test_ticket_stats_without_closed_tickets(spark):
    tickets = spark.sql("SELECT 1 Id, 1 Number, 'open' Status, CAST(NULL AS STRING) Priority, 'x' Type, timestamp'2024-01-01' CreatedOn, timestamp'2024-01-02' ModifiedOn, 's' Subject")
    row = service_desk.ticket_stats(tickets).first()
    assert row["Open"] == {"All": 1, "SeverityLevel1": 0, "SeverityLevel2": 0, "SeverityLevel3": 1}
    assert row["Closed"] == {"CurrentWeek": None, "PrevWeek": None}
    assert set(row["ResolutionTime"].values()) == {None}


def test_ticket_stats_agree_with_the_parts(spark):
    from telemetry_lake.catalog.aggregates import kept_tickets
    from telemetry_lake.catalog.views import Lake

    tickets = kept_tickets(Lake(spark, "/root/testdata/sf0.001"))
    row = service_desk.ticket_stats(tickets).first()
    assert row["Open"] == service_desk.open_by_severity(tickets).first().asDict()
    assert row["Closed"] == service_desk.closed_last_two_weeks(tickets).first().asDict()
    assert row["ResolutionTime"] == service_desk.average_resolution(tickets).first().asDict()
    assert row["RMAResolutionTime"] == service_desk.average_resolution(tickets, rma=True).first().asDict()


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_status_durations(spark, limit):
    log = [
        ("T1", 0, "addticket", None, None, None), ("T1", 100, "updateticket", "status", "open", "pending"),
        ("T1", 150, "updateticket", "priority", "low", "high"), ("T1", 400, "updateticket", "status", "pending", "open"),
        ("T1", 1000, "updateticket", "status", "open", "closed"), ("T2", 50, "addticket", None, None, None),
    ]
    activity = spark.createDataFrame(log, "EntityName string, s bigint, Action string, FieldName string, OldValue string, NewValue string")
    activity = activity.withColumn("Timestamp", F.timestamp_seconds("s"))
    rows = ticket_activity.status_durations(activity, max_group_rows=limit).collect()
    assert [(r["Ticket"], r["open"], r["pending"], r["closed"], r["waiting_on_customer"]) for r in rows] == [("T1", 700, 300, 0, 0)]
    timeline = ticket_activity.activity_timeline(activity)
    created = {r["Ticket"]: r["NewValue"] for r in timeline.filter(F.col("OldValue").isNull()).collect()}
    assert created == {"T1": "open", "T2": None}


def test_index_documents_on_disk(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "g string, i int")
    files.write_index_documents(files.json_array_documents(rows, ["g"], ["i"]), str(tmp_path / "idx"), ["g"])
    part = next((tmp_path / "idx/g=a/part=0").glob("part-*"))
    assert json.loads(part.read_text()) == [{"i": 1}, {"i": 2}]


def test_large_groups_stay_one_array(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LINE_ITEMS", 7, raising=False)
    monkeypatch.setattr(files, "BLOCK", 5, raising=False)
    hot = [("hot", i // 3, "x") for i in range(900)] + [("hot", 1_000, "same")] * 400 + [("hot", None, None)] * 3
    rows = hot + [(None, i, "n") for i in range(200)] + [("", 500, "e")] + [("one", 1, "a")] * 101_000
    df = spark.createDataFrame(rows, "g string, i int, v string").repartition(5)
    files.write_index_documents(files.json_array_documents(df, ["g"], ["i"]), str(tmp_path / "idx"), ["g"])

    def read(folder):
        assert [f.name for f in (tmp_path / "idx" / folder).iterdir()] == ["part=0"]
        return json.loads("".join(f.read_text() for f in sorted((tmp_path / "idx" / folder / "part=0").glob("part-*"))))

    def want(g):
        some = sorted(((i, v) for x, i, v in rows if (x or None) == g), key=lambda r: (r[0] is not None, r[0] or 0))
        return [{k: x for k, x in (("i", i), ("v", v)) if x is not None} for i, v in some]

    assert read("g=hot") == want("hot") and read("g=__HIVE_DEFAULT_PARTITION__") == want(None)
    assert read("g=one") == want("one")
