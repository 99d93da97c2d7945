"""Stream jobs end to end; files of records stand in for topics."""

from __future__ import annotations

import datetime as dt

import pytest

from telemetry_lake import jobs
from telemetry_lake.sinks.changelog import read_current
from telemetry_lake.streaming import io

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def topics(spark, tmp_path, monkeypatch):
    """Adds records ``(key, value, minute, offset)`` to a topic; jobs read the files behind it."""

    def schema(kind):
        return f"key string, value {kind}, ts timestamp, offset long"

    def add(topic, rows, kind="string"):
        stamped = [(k, v, START + dt.timedelta(minutes=m), o) for k, v, m, o in rows]
        spark.createDataFrame(stamped, schema(kind)).coalesce(1).write.mode("append").parquet(str(tmp_path / topic))

    def read(spark, servers, topic, value_type="string"):
        return io.file_records(spark, str(tmp_path / topic), schema(value_type))

    monkeypatch.setattr(io, "topic_records", read)
    return add


def table(spark, path, key="key", value="value", offset="offset"):
    return {r[key]: r[value] for r in read_current(spark, f"{path}/table", key, value, offset).collect()}


LINES = [("sensor-1", "Alpha", 0, 0), ("sensor-2", "Beta", 1, 1), ("sensor-1", "Beta", 2, 2), ("other", "Alpha", 3, 3)]


@pytest.mark.parametrize(
    "name, extra, want",
    [
        ("stream_filter", {"value": "Beta"}, {"sensor-1": "Beta", "sensor-2": "Beta"}),
        ("stream_map", {}, {"sensor-1": "Beta-new", "sensor-2": "Beta-new", "other": "Alpha-new"}),
        ("stream_flat_map", {"prefixes": "a,b"}, {"a-Alpha": "Alpha", "b-Alpha": "Alpha", "a-Beta": "Beta", "b-Beta": "Beta"}),
        ("stream_lower", {}, {"sensor-1": "beta", "sensor-2": "beta", "other": "alpha"}),
    ],
)
def test_record_jobs(spark, tmp_path, topics, name, extra, want):
    topics("lines", LINES)
    jobs.JOBS[name](spark, servers="s", records="lines", out=str(tmp_path / "out"), once="yes", **extra)
    assert table(spark, tmp_path / "out") == want


def test_branches_and_counts(spark, tmp_path, topics):
    topics("lines", LINES)
    jobs.stream_branch(spark, "s", "lines", "sensor-1,sensor", str(tmp_path / "b"), once="yes")
    assert table(spark, tmp_path / "b/sensor-1") == {"sensor-1": "Beta"}
    assert table(spark, tmp_path / "b/sensor") == {"sensor-2": "Beta"}
    for _ in range(2):
        jobs.stream_count(spark, "s", "lines", str(tmp_path / "c"), once="yes")
        topics("lines", [("x", "Beta", 9, 9)])
    assert table(spark, tmp_path / "c", "value", "count", "version") == {"Alpha": 2, "Beta": 3}


REGIONS = [("a", "west", 0, 0), ("b", "east", 0, 1), ("d", "south", 0, 2), ("d", None, 1, 3)]
METRICS = [("a", 99, 2, 0), ("c", 7, 2, 1), ("a", 100, 8, 2), ("d", 5, 8, 3)]


@pytest.mark.parametrize(
    "how, want", [("inner", {"a": "west/100"}), ("full", {"a": "west/100", "b": "east/0", "c": "null/7", "d": "null/5"})]
)
def test_tables(spark, tmp_path, topics, how, want):
    topics("regions", REGIONS)
    topics("metrics", METRICS, "bigint")
    jobs.join_tables(spark, "s", "regions", "metrics", how, str(tmp_path / "out"), once="yes")
    assert table(spark, tmp_path / "out") == want


@pytest.mark.parametrize("replicated", ["", "yes"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_stream_with_table(spark, tmp_path, topics, how, replicated):
    topics("regions", REGIONS)
    topics("metrics", METRICS, "bigint")
    run = {"replicated": replicated, "once": "yes"}
    jobs.join_stream_with_table(spark, "s", "metrics", "regions", how, str(tmp_path / "out"), **run)
    first = {"a": "100/west"} | ({"c": "7/null", "d": "5/null"} if how == "left" else {})
    assert table(spark, tmp_path / "out") == first
    # A later change of the table alone changes nothing that was joined; the next records see it.
    topics("regions", [("a", "north", 9, 4), ("c", "centre", 9, 5)])
    topics("metrics", [("c", 8, 10, 4)], "bigint")
    jobs.join_stream_with_table(spark, "s", "metrics", "regions", how, str(tmp_path / "out"), **run)
    assert table(spark, tmp_path / "out") == first | {"c": "8/centre"}


def test_streams_within_minutes(spark, tmp_path, topics):
    topics("left", [("a", 1, 0, 0), ("a", 2, 4, 1), ("b", 3, 0, 2)], "bigint")
    topics("right", [("a", "x", 5, 0), ("a", "y", 30, 1), ("b", "z", 6, 2)])
    jobs.join_streams(spark, "s", "left", "right", "inner", str(tmp_path / "out"), once="yes")
    # Both records of a meet x; of pairs of one moment the larger text stays.
    assert table(spark, tmp_path / "out") == {"a": "2/x"}


def test_unknown_joins(spark, tmp_path, topics):
    topics("left", REGIONS)
    with pytest.raises(ValueError, match="unsupported"):
        jobs.join_stream_with_table(spark, "s", "left", "left", "full", str(tmp_path / "out"), records_type="string")
