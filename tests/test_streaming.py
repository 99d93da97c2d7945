from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import joins
from telemetry_lake.sinks.changelog import append_changes, fold_changes, read_changes, read_current
from telemetry_lake.streaming import io, tables, transforms

REGIONS = [("sensor-1", "MN"), ("sensor-2", "WI"), ("sensor-3-in-topic-one", "IL")]
METRICS = [("sensor-1", 99), ("sensor-2", 1), ("sensor-99-in-topic-two", 1), ("sensor-100-in-topic-two", 100)]
START = dt.datetime(2024, 1, 1)

# Joined values by key; table-table joins put the region first, all others the metric.
TABLE_TABLE = {
    "inner": {"sensor-1": "MN/99", "sensor-2": "WI/1"},
    "left": {"sensor-1": "MN/99", "sensor-2": "WI/1", "sensor-3-in-topic-one": "IL/0"},
    "full": {
        "sensor-1": "MN/99", "sensor-2": "WI/1", "sensor-3-in-topic-one": "IL/0",
        "sensor-99-in-topic-two": "null/1", "sensor-100-in-topic-two": "null/100",
    },
}
LOOKUP = {
    "inner": {"sensor-1": "99/MN", "sensor-2": "1/WI"},
    "left": {
        "sensor-1": "99/MN", "sensor-2": "1/WI", "sensor-99-in-topic-two": "1/null", "sensor-100-in-topic-two": "100/null",
    },
}
STREAM_STREAM = {**LOOKUP, "full": {**LOOKUP["left"], "sensor-3-in-topic-one": "0/IL"}}


def as_dict(df):
    return {r["key"]: r["value"] for r in df.collect()}


@pytest.fixture
def regions(spark):
    return spark.createDataFrame([(k, v, i, START) for i, (k, v) in enumerate(REGIONS)], "key string, value string, offset bigint, ts timestamp")


@pytest.fixture
def metrics(spark):
    rows = [(k, v, 10 + i, START + dt.timedelta(minutes=5)) for i, (k, v) in enumerate(METRICS)]
    return spark.createDataFrame(rows, "key string, value bigint, offset bigint, ts timestamp")


class Feed:
    """A folder that gets one file per micro-batch."""

    def __init__(self, spark, folder, schema, fmt="json"):
        self.spark, self.folder, self.schema, self.fmt = spark, str(folder), schema, fmt

    def add(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.mode("append").format(self.fmt).save(self.folder)

    def stream(self):
        return io.file_records(self.spark, self.folder, self.schema, files_per_batch=1, fmt=self.fmt)


@pytest.fixture
def feed(spark, tmp_path):
    io.use_rocksdb(spark)
    names = iter(range(100))
    return lambda schema, fmt="json": Feed(spark, tmp_path / f"in{next(names)}", schema, fmt)


def written(spark, tmp_path, stream, label="out"):
    path = str(tmp_path / label)
    io.to_files(stream, path, path + "-checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@pytest.mark.parametrize("how", TABLE_TABLE)
def test_tables(regions, metrics, how):
    left = joins.current_table(regions, "key", "value", "offset")
    right = joins.current_table(metrics, "key", "value", "offset")
    assert as_dict(joins.join_tables(left, right, "key", "value", "value", how)) == TABLE_TABLE[how]


@pytest.mark.parametrize("how", LOOKUP)
def test_stream_with_table(regions, metrics, how):
    table = joins.current_table(regions, "key", "value", "offset")
    assert as_dict(joins.join_stream_table(metrics, table, "key", "key", "value", "value", how)) == LOOKUP[how]
    stream = metrics.withColumnRenamed("value", "metric")
    assert as_dict(joins.replay_stream_table(stream, regions, "key", "offset", "metric", "value", how)) == LOOKUP[how]


def test_lookup_key_is_an_expression(spark, regions):
    stream = spark.createDataFrame([("x", "1", 5)], "key string, number string, metric bigint")
    table = joins.current_table(regions, "key", "value", "offset")
    key = F.concat(F.lit("sensor-"), F.col("number"))
    assert as_dict(joins.join_stream_table(stream, table, key, "key", "metric", "value")) == {"x": "5/MN"}


def test_replay_sees_versions_and_deletes(spark):
    changes = spark.createDataFrame([("a", "x", 1), ("a", "y", 5), ("a", None, 9)], "key string, value string, offset bigint")
    stream = spark.createDataFrame([("a", o, o) for o in (0, 1, 4, 6, 10)], "key string, offset bigint, metric bigint")
    got = joins.replay_stream_table(stream, changes, "key", "offset", "metric", "value", "left")
    assert {r["offset"]: r["value"] for r in got.collect()} == {0: "0/null", 1: "1/x", 4: "4/x", 6: "6/y", 10: "10/null"}


def rendered(joined):
    kinds = {f.name: f.dataType for f in joined.schema}
    return joined.select("key", joins.render_pair(F.col("metric"), kinds["metric"], F.col("region"), kinds["region"]).alias("value"))


def test_streams_within_the_window(regions, metrics):
    """The records are exactly five minutes apart, which still counts."""
    left = metrics.select("key", F.col("value").alias("metric"), F.col("ts").alias("lt"))
    right = regions.select("key", F.col("value").alias("region"), F.col("ts").alias("rt"))
    for how, expected in STREAM_STREAM.items():
        assert as_dict(rendered(joins.join_within(left, right, "key", "lt", "rt", how=how))) == expected
    narrow = joins.join_within(left, right, "key", "lt", "rt", dt.timedelta(minutes=4, seconds=59))
    assert narrow.count() == 0


@pytest.mark.parametrize("how", STREAM_STREAM)
def test_streamed_join_within(spark, tmp_path, feed, how):
    left, right = feed("key string, metric bigint, lt timestamp"), feed("key string, region string, rt timestamp")
    left.add([(k, v, START + dt.timedelta(minutes=5)) for k, v in METRICS])
    right.add([(k, v, START) for k, v in REGIONS])

    def run():
        joined = joins.join_within(
            left.stream().withWatermark("lt", "1 minute"), right.stream().withWatermark("rt", "1 minute"),
            "key", "lt", "rt", how=how,
        )
        return written(spark, tmp_path, joined)

    run()
    # Later records move the watermark past the first ones; their own keys stay unmatched.
    end = START + dt.timedelta(days=1)
    left.add([("end", 0, end)])
    right.add([("end", "end", end)])
    rows = rendered(run().filter(F.col("key") != "end"))
    assert as_dict(rows) == STREAM_STREAM[how]
    assert rows.count() == len(STREAM_STREAM[how])


def test_late_records_are_dropped(spark, tmp_path, feed):
    left, right = feed("key string, metric bigint, lt timestamp"), feed("key string, region string, rt timestamp")

    def run():
        joined = joins.join_within(
            left.stream().withWatermark("lt", "1 minute"), right.stream().withWatermark("rt", "1 minute"), "key", "lt", "rt"
        )
        return written(spark, tmp_path, joined)

    later = START + dt.timedelta(hours=1)
    left.add([("a", 1, later)])
    right.add([("a", "x", later)])
    run()
    left.add([("b", 2, START)])
    right.add([("b", "y", START)])
    assert as_dict(rendered(run())) == {"a": "1/x"}


@pytest.mark.parametrize("how", TABLE_TABLE)
def test_streamed_tables(spark, tmp_path, feed, how):
    """Three micro-batches with updates and deletes end where the join of the final tables does."""
    left, right = feed("key string, value string, offset bigint"), feed("key string, value bigint, offset bigint")
    left_changes, right_changes = [], []
    batches = [
        ([(k, v, i) for i, (k, v) in enumerate(REGIONS)], [(k, v, i + 10) for i, (k, v) in enumerate(METRICS)]),
        ([("sensor-1", "TX", 20), ("sensor-99-in-topic-two", "NY", 21)], [("sensor-2", None, 22), ("sensor-3-in-topic-one", 7, 23)]),
        ([("sensor-1", None, 30), ("sensor-2", "OR", 32), ("sensor-2", "WA", 31)], [("sensor-2", 5, 33), ("sensor-100-in-topic-two", None, 34)]),
    ]
    path = str(tmp_path / "table")
    for left_rows, right_rows in batches:
        left.add(left_rows)
        right.add(right_rows)
        left_changes += left_rows
        right_changes += right_rows
        pairs = tables.join_table_streams(left.stream(), right.stream(), how)
        io.to_table(pairs, path, path + "-checkpoint", "key", "value", "offset", mode="update").awaitTermination()
        final = joins.join_tables(
            joins.current_table(spark.createDataFrame(left_changes, left.schema), "key", "value", "offset"),
            joins.current_table(spark.createDataFrame(right_changes, right.schema), "key", "value", "offset"),
            "key", "value", "value", how,
        )
        assert as_dict(read_current(spark, path, "key", "value", "offset")) == as_dict(final)


def test_branches(spark, tmp_path, feed):
    source = feed("key string, value string")
    source.add([("sensor-1", "MN"), ("sensor-2", "WI"), ("sensor-11", "IL"), ("other", "XX")])
    got = written(spark, tmp_path, transforms.branch_by_prefix(source.stream(), ["sensor-1", "sensor-2"]))
    assert sorted(map(tuple, got.collect())) == [("sensor-1", "MN", 0), ("sensor-11", "IL", 0), ("sensor-2", "WI", 1)]


def test_stateless_transforms(spark, tmp_path, feed):
    source = feed("key string, value string")
    source.add([("sensor-1", "MN"), ("sensor-2", "WI"), ("sensor-11", "IL")])
    assert as_dict(written(spark, tmp_path, transforms.filter_values(source.stream(), "MN"), "filter")) == {"sensor-1": "MN"}
    assert as_dict(written(spark, tmp_path, transforms.append_suffix(source.stream()), "map")) == {
        "sensor-1": "MN-new", "sensor-2": "WI-new", "sensor-11": "IL-new",
    }
    flat = as_dict(written(spark, tmp_path, transforms.flat_map_prefixes(source.stream(), ["temp", "location", "codename"]), "flat"))
    assert {k: flat[k] for k in ("temp-MN", "location-MN", "codename-MN")} == dict.fromkeys(["temp-MN", "location-MN", "codename-MN"], "MN")
    assert len(flat) == 9
    rekeyed = transforms.map_records(source.stream(), key=F.lower("value"))
    assert as_dict(written(spark, tmp_path, rekeyed, "rekeyed"))["mn"] == "MN"


def test_lower_values(spark, tmp_path, feed):
    source = feed("key string, value string")
    source.add([("k", "Hello, WORLDY, World worlD Test")])
    assert as_dict(written(spark, tmp_path, transforms.lower_values(source.stream()))) == {"k": "hello, worldy, world world test"}


def test_counts_go_on_over_batches(spark, tmp_path, feed):
    source = feed("key string, value string")
    path = str(tmp_path / "counts")
    batches = [[("sensor-1", "MN"), ("sensor-2", "WI")], [("sensor-12", "MN"), ("sensor-11", "IL")]]
    for rows in batches:
        source.add(rows)
        io.to_count_table(transforms.count_by(source.stream(), "value"), path, path + "-checkpoint", "value").awaitTermination()
    counts = read_current(spark, path, "value", "count", "version")
    assert {r["value"]: r["count"] for r in counts.collect()} == {"MN": 2, "WI": 1, "IL": 1}
    assert read_changes(spark, path).count() == 4


def test_word_count(spark, tmp_path, feed):
    source = feed("line string")
    path = str(tmp_path / "words")
    for line in ("Hello Kafka Streams,", "All streams lead to Kafka"):
        source.add([(line,)])
    io.to_count_table(transforms.word_count(source.stream(), "line"), path, path + "-checkpoint", "word").awaitTermination()
    counts = {r["word"]: r["count"] for r in read_current(spark, path, "word", "count", "version").collect()}
    assert counts == {"hello": 1, "kafka": 2, "streams": 2, "all": 1, "lead": 1, "to": 1}


def test_word_rows_equal_token_arrays(spark):
    from telemetry_lake.functions.text import tokenize

    df = spark.createDataFrame([(" a  b. ",), ("...",), ("",), (None,), ("x",), ("É-é_1",)], "t string")
    rows = sorted(r["word"] for r in transforms.words(df, "t").collect())
    assert rows == sorted(w for r in df.select(tokenize(F.col("t"))).collect() for w in r[0] or [])


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    path = str(tmp_path / "log")
    changes = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "x", 3)], "key string, value string, offset bigint")
    append_changes(changes, path, 0, "key", "value", "offset")
    append_changes(changes, path, 0, "key", "value", "offset")
    append_changes(spark.createDataFrame([("b", None, 4)], changes.schema), path, 1, "key", "value", "offset")
    assert read_changes(spark, path).count() == 3
    assert as_dict(read_current(spark, path, "key", "value", "offset")) == {"a": "2"}
    fold_changes(spark, path, path + "-folded", "key", "offset")
    assert read_changes(spark, path + "-folded").count() == 2
    assert as_dict(read_current(spark, path + "-folded", "key", "value", "offset")) == {"a": "2"}


def test_lookup_follows_the_table(spark, tmp_path, feed):
    table, out = str(tmp_path / "table"), str(tmp_path / "joined")
    source = feed("key string, metric bigint")

    def look_up(batch):
        current = read_current(spark, table, "key", "value", "offset")
        return joins.join_stream_table(batch, current, "key", "key", "metric", "value", "left")

    for number, (region, metric) in enumerate([("MN", 1), ("TX", 2), (None, 3)]):
        changes = spark.createDataFrame([("a", region, number)], "key string, value string, offset bigint")
        append_changes(changes, table, number, "key", "value", "offset")
        source.add([("a", metric)])
        io.lookup_to_files(source.stream(), look_up, out, out + "-checkpoint").awaitTermination()
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["1/MN", "2/TX", "3/null"]


def test_topic_numbers(spark):
    from telemetry_lake.functions.numbers import long_from_bytes

    numbers = [0, 1, -1, 99, 2**62, -(2**63)]
    df = spark.createDataFrame([(bytearray(n.to_bytes(8, "big", signed=True)),) for n in numbers], "value binary")
    assert [r[0] for r in df.select(long_from_bytes(F.col("value"))).collect()] == numbers
