"""Ordered work in fixed buckets: results as without them, and bounded rows per task."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import buckets
from telemetry_lake.operators.asof import asof_join, asof_join_all, Lookup

from .test_operators import LONG, brute_asof, sides


@pytest.mark.parametrize("direction, strict, tolerance", [("backward", False, None), ("backward", True, 5), ("forward", False, 5), ("forward", True, None)])
@pytest.mark.parametrize("width", [1, 7])
def test_asof_over_many_buckets(spark, direction, strict, tolerance, width):
    left, right = sides(seed=width)
    # Times far off on both ends, below zero, and rows without key.
    left += [("a", -10_000, "lo"), ("a", 10**12, "hi"), (None, 5, "none"), ("b", None, "never")]
    right += [("a", -10_001, "rlo"), ("a", 10**12 - 1, "rhi"), (None, 5, "none")]
    got = asof_join(
        spark.createDataFrame(left, LONG.format("lt", "l")), spark.createDataFrame(right, LONG.format("rt", "r")),
        ["k"], "lt", "rt", tolerance, direction, strict, ["r"], width=width,
    )
    assert sorted(map(tuple, got.select("k", "lt", "l", "rt", "r").collect()), key=str) == brute_asof(left, right, tolerance, direction, strict)


def test_two_tables_are_handed_on_apart(spark):
    """The older of two tables' rows still counts where the newer one's came later."""
    left = spark.createDataFrame([("a", 100, "x")], LONG.format("lt", "l"))
    first = spark.createDataFrame([("a", 1, "f")], LONG.format("t1", "r1"))
    second = spark.createDataFrame([("a", 50, "s")], LONG.format("t2", "r2"))
    got = asof_join_all(left, [Lookup(first, "t1"), Lookup(second, "t2")], ["k"], "lt", width=10).first()
    assert (got["r1"], got["r2"]) == ("f", "s")


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_previous_with_an_outlier_and_missing_keys(spark, width):
    chance = random.Random(width)
    rows = [(chance.choice(["a", None]), 10**9 + chance.randrange(3000), i) for i in range(400)] + [("a", 0, -1), (None, -5, -2)]
    df = spark.createDataFrame(rows, "k string, t long, i long")
    got = buckets.with_previous(df, ["k"], "t", "before", ["i"], width)
    want = []
    for key in ("a", None):
        before = None
        for k, t, i in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]):
            want.append((str(k), t, i, before))
            before = t
    assert sorted((str(r["k"]), r["t"], r["i"], r["before"]) for r in got.collect()) == sorted(want)


def test_rows_of_a_task_do_not_grow_with_a_key(spark):
    """One key holds nearly all rows, half of them without a name, and one row lies far off."""
    df = spark.range(20_000).selectExpr("if(id % 2 = 0, 'hot', null) AS k", "1000000000 + id AS t").union(spark.range(1).selectExpr("'hot'", "0L"))
    sizes = df.groupBy("k", buckets.bucket_of(F.col("t"), 1000).alias("b")).count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] <= 500 and sizes[1] == 41
    carried = buckets.handed_over(df.withColumn(buckets.BUCKET, buckets.bucket_of(F.col("t"), 1000)), ["k"], {"end": F.max("t")})
    assert carried.count() == 39
    plan = buckets.with_previous(df, ["k"], "t", "before", width=1000)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Limit" not in plan and "Broadcast" not in plan
