from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemetry_lake.functions import numbers, text, times


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_tokenize(spark):
    lines = ["Hello Kafka Streams, All streams", " lead. ", "...", "", "one", None, "a  b"]
    assert values(spark, lines, text.tokenize) == [
        ["hello", "kafka", "streams", "all", "streams"], ["", "lead"], [], [""], ["one"], None, ["a", "b"],
    ]


@pytest.mark.parametrize(
    "store, web",
    [
        ("wasbs://test@host.example.net/", "https://host.example.net/test/"),
        ("wasbs://test@host.example.net/data/3155378974472885099", "https://host.example.net/test/data/3155378974472885099"),
        ("wasbs://c@h.example:8443/p?q=1#top", "https://h.example:8443/c/p?q=1#top"),
        ("wasbs://c@h.example", "https://h.example/c"),
    ],
)
def test_uris(spark, store, web):
    assert values(spark, [web], text.uri_to_store) == [store]
    assert values(spark, [store], text.uri_from_store) == [web]


def test_uris_without_container(spark):
    assert values(spark, ["https://host.example.net", "no uri"], text.uri_to_store) == [None, None]
    assert values(spark, ["wasbs://host.example.net/x"], text.uri_from_store) == [None]


def test_si_prefix(spark):
    sizes = [12.0, -5e6, 999.999, 1000.0, 1.005e6, 2.5e9, 3.456e12, 1e16, float("nan"), None]
    assert values(spark, sizes, numbers.si_prefix, "double") == [
        "12.0 B", "-5000000.0 B", "999.999 B", "1.00 KB", "1.01 MB", "2.50 GB", "3.46 TB", "10000.00 TB", "NaN B", None,
    ]


def test_round_half_down(spark):
    inputs = [2.25, 2.35, 2.251, -2.25, -2.26, 0.05, 0.0, 17.349999999999998, None]
    expected = [2.2, 2.3, 2.3, -2.2, -2.3, 0.0, 0.0, 17.3, None]
    got = values(spark, inputs, numbers.round_half_down, "double")
    assert [None if g is None else round(g, 4) for g in got] == expected


def test_format_days(spark):
    assert values(spark, [194400, 86400, 0], numbers.format_days, "bigint") == ["2.3", "1.0", "0.0"]


def test_reversed_key(spark):
    assert values(spark, ["3155378974472885099"], times.decode_reversed_key) == [1527114900]
    assert values(spark, [1527114900], times.encode_reversed_key, "bigint") == ["3155378974472885099"]


def test_nanos_keep_microseconds(spark):
    got = values(spark, [1527114900123456789], lambda c: F.unix_micros(times.from_epoch_nanos(c)), "bigint")
    assert got == [1527114900123456]


def test_key_part_past_the_end(spark):
    assert values(spark, ["a.b"], lambda c: text.key_part(c, 2)) == [None]


@pytest.mark.parametrize(
    "name, first, last",
    [
        ("Today", "2024-03-15", "2024-03-15"), ("Yesterday", "2024-03-14", "2024-03-14"),
        ("Last 7 Days", "2024-03-09", "2024-03-15"), ("Last 30 Days", "2024-02-15", "2024-03-15"),
        ("This Month", "2024-03-01", "2024-03-31"), ("Last Month", "2024-02-01", "2024-02-29"),
    ],
)
def test_presets(name, first, last):
    got = times.preset_range(name, dt.date(2024, 3, 15))
    assert got == (dt.date.fromisoformat(first), dt.date.fromisoformat(last))


def test_preset_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = orders.filter(times.in_preset(F.col("o_orderdate"), dt.date(1998, 8, 15)))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_long_form(spark):
    def render(ts):
        return times.long_form(ts.cast("timestamp"), "America/Los_Angeles", "PST", "PDT")

    got = values(spark, ["2026-12-03 21:17:33", "2026-07-01 00:00:00"], render)
    assert got == ["December 3, 2026 1:17:33 PM PST", "June 30, 2026 5:00:00 PM PDT"]


def test_render_defaults(spark):
    df = spark.createDataFrame([("MN", 99), ("IL", None), (None, 1)], "region string, metric bigint")
    kinds = [df.schema["region"].dataType, df.schema["metric"].dataType]
    rows = df.select(text.render_pair(F.col("region"), kinds[0], F.col("metric"), kinds[1])).collect()
    assert [r[0] for r in rows] == ["MN/99", "IL/0", "null/1"]
