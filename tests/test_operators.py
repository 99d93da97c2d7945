from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import joins, reshape, rollups
from telemetry_lake.operators.asof import Lookup, asof_join, asof_join_all
from telemetry_lake.operators.skew import with_previous, with_slices
from telemetry_lake.operators.spatial import CELLS, cell_cover, spatial_join
from telemetry_lake.sinks.files import json_array_documents

LONG = "k string, {0} bigint, {1} string"


def sides(seed, rows=400):
    """One key holds most rows; some keys and times are missing, some times equal."""
    rng = random.Random(seed)

    def table():
        keys = ["hot"] * 6 + ["a", "b", None]
        return [
            (rng.choice(keys), None if rng.random() < 0.05 else rng.randrange(300), f"{i:04d}") for i in range(rows)
        ]

    return table(), table()


def brute_asof(left, right, tolerance, direction, strict):
    result = []
    for k, t, name in left:
        best = None
        for rk, rt, rname in right:
            if k is None or t is None or rt is None or k != rk:
                continue
            gap = t - rt if direction == "backward" else rt - t
            if gap < 0 or (strict and gap == 0) or (tolerance is not None and gap > tolerance):
                continue
            rank = (-gap, rname) if direction == "backward" else (-gap, tuple(-ord(c) for c in rname))
            if best is None or rank > best[0]:
                best = (rank, rt, rname)
        result.append((k, t, name, *(best[1:] if best else (None, None))))
    return sorted(result, key=str)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("tolerance, strict", [(None, False), (7, False), (None, True), (3, True)])
@pytest.mark.parametrize("limit", [25, 1_000_000])
def test_asof_against_brute_force(spark, direction, tolerance, strict, limit):
    left, right = sides(seed=limit + (tolerance or 0))
    got = asof_join(
        spark.createDataFrame(left, LONG.format("lt", "l")), spark.createDataFrame(right, LONG.format("rt", "r")),
        ["k"], "lt", "rt", tolerance, direction, strict, ["r"], max_group_rows=limit,
    )
    assert sorted(map(tuple, got.select("k", "lt", "l", "rt", "r").collect()), key=str) == brute_asof(
        left, right, tolerance, direction, strict
    )


@pytest.mark.parametrize("limit", [25, 1_000_000])
def test_asof_with_two_tables(spark, limit):
    left, first = sides(1)
    second, _ = sides(2)
    got = asof_join_all(
        spark.createDataFrame(left, LONG.format("lt", "l")),
        [
            Lookup(spark.createDataFrame(first, LONG.format("t1", "r1")), "t1", 10, ["r1"]),
            Lookup(spark.createDataFrame(second, LONG.format("t2", "r2")), "t2", None, ["r2"]),
        ],
        ["k"], "lt", max_group_rows=limit,
    )
    rows = got.collect()
    for columns, table, tolerance in ((("t1", "r1"), first, 10), (("t2", "r2"), second, None)):
        expected = brute_asof(left, table, tolerance, "backward", False)
        assert sorted(((r["k"], r["lt"], r["l"], *(r[c] for c in columns)) for r in rows), key=str) == expected


def test_asof_times_and_clashes(spark):
    left = spark.createDataFrame([("a", "2024-01-01 00:00:10")], "k string, lt string")
    right = spark.createDataFrame([("a", "2024-01-01 00:00:09.5", 1), ("a", "2023-12-31 00:00:00", 2)], "k string, rt string, v int")
    left = left.withColumn("lt", F.col("lt").cast("timestamp"))
    right = right.withColumn("rt", F.col("rt").cast("timestamp_ntz"))
    assert asof_join(left, right, ["k"], "lt", "rt", dt.timedelta(seconds=1)).first()["v"] == 1
    assert asof_join(left, right, ["k"], "lt", "rt", dt.timedelta(milliseconds=400)).first()["v"] is None
    with pytest.raises(ValueError, match="rename"):
        asof_join(left, right.withColumnRenamed("rt", "lt"), ["k"], "lt", "lt")
    with pytest.raises(ValueError, match="direction"):
        asof_join(left, right, ["k"], "lt", "rt", direction="nearest")


def test_asof_plan_has_no_pairs(spark):
    left, right = sides(3)
    got = asof_join(
        spark.createDataFrame(left, LONG.format("lt", "l")), spark.createDataFrame(right, LONG.format("rt", "r")),
        ["k"], "lt", "rt",
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("limit", [20, 1_000_000])
def test_previous(spark, limit):
    rows = [r for r in sides(4)[0] if r[1] is not None]
    df = spark.createDataFrame(rows, "k string, t bigint, name string")
    got = with_previous(df, ["k"], "t", "before", ["name"], max_rows=limit).collect()
    expected = []
    for key in {r[0] for r in rows}:
        before = None
        for k, t, name in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            expected.append((k, t, name, before))
            before = t
    assert sorted(((r["k"], r["t"], r["name"], r["before"]) for r in got), key=str) == sorted(expected, key=str)


def test_slices_cut_only_hot_keys(spark):
    rows = [("hot", t) for t in range(1000)] + [("cold", t) for t in range(10)]
    sliced = with_slices(spark.createDataFrame(rows, "k string, t bigint"), ["k"], "t", max_rows=100)
    sizes = {(r["k"], r["__slice"]): r["count"] for r in sliced.groupBy("k", "__slice").count().collect()}
    assert sizes.pop(("cold", None)) == 10
    assert len(sizes) >= 10 and max(sizes.values()) <= 100


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_join_within_against_brute_force(spark, how):
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)

    def table():
        return [(rng.choice(["a", "b", None]), i, base + dt.timedelta(seconds=rng.randrange(2000))) for i in range(60)]

    left, right = table(), table()
    span = dt.timedelta(seconds=100)
    got = joins.join_within(
        spark.createDataFrame(left, "k string, l int, lt timestamp"), spark.createDataFrame(right, "k string, r int, rt timestamp"),
        "k", "lt", "rt", span, how,
    )
    pairs = {(l[1], r[1]) for l in left for r in right if l[0] is not None and l[0] == r[0] and abs(l[2] - r[2]) <= span}
    expected = set(pairs)
    if how != "inner":
        expected |= {(l[1], None) for l in left if l[1] not in {p[0] for p in pairs}}
    if how == "full":
        expected |= {(None, r[1]) for r in right if r[1] not in {p[1] for p in pairs}}
    rows = [(r["l"], r["r"]) for r in got.collect()]
    assert len(rows) == len(expected) and set(rows) == expected


def test_unsupported_joins(spark):
    df = spark.createDataFrame([("a", 1)], "key string, value bigint")
    for call in (
        lambda: joins.join_stream_table(df, df, "key", "key", "value", "value", "full"),
        lambda: joins.replay_stream_table(df, df, "key", "value", "value", "value", "full"),
        lambda: joins.join_tables(df, df, "key", "value", "value", "right"),
        lambda: joins.join_within(df, df, "key", "value", "value", how="right"),
    ):
        with pytest.raises(ValueError, match="unsupported"):
            call()


def test_latest_with_ties(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("c", 5, "c")]
    got = joins.latest_with_ties(spark.createDataFrame(rows, "k string, t int, v string"), "k", "t").collect()
    assert sorted(r["v"] for r in got) == ["c", "y", "z"]


def test_untagged_keeps_missing_ids(spark):
    tickets = spark.createDataFrame([(1,), (2,), (None,)], "Id int")
    tags = spark.createDataFrame([(1, "ignore"), (2, "vip"), (None, "ignore")], "EntityId int, Name string")
    assert sorted(joins.without_tagged(tickets, tags).collect(), key=str) == [(2,), (None,)]


def test_spatial_join_against_brute_force(spark):
    rng = random.Random(6)
    rings = {
        "concave": [[(0, 0), (10, 0), (5, 4), (10, 9), (0, 9), (0, 0)]],
        "holed": [[(20, 20), (40, 20), (40, 40), (20, 40)], [(25, 25), (35, 25), (35, 35), (25, 35)]],
        "across": [[(-7, -7), (3, -7), (3, 3), (-7, 3), (-7, -7)]],
    }
    points = [(i, rng.uniform(-10, 45), rng.uniform(-10, 45)) for i in range(500)] + [(1000, 0.0, 0.0), (1001, 20.0, 30.0)]

    def within(x, y, polygon):
        odd = False
        for ring in polygon:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
        return odd

    polygons = spark.createDataFrame(
        [(name, [[(float(x), float(y)) for x, y in ring] for ring in polygon]) for name, polygon in rings.items()],
        "name string, rings array<array<struct<x: double, y: double>>>",
    )
    got = spatial_join(spark.createDataFrame(points, "id int, px double, py double"), polygons, "px", "py", "rings", cell=6.0)
    expected = sorted((i, name) for i, x, y in points for name, polygon in rings.items() if within(x, y, polygon))
    assert sorted((r["id"], r["name"]) for r in got.collect()) == expected and expected


def test_spatial_join_of_thin_huge_and_tiny_polygons(spark):
    """Few cells each, whatever the shape; the result is that of the plain test of all pairs."""
    rng = random.Random(12)
    circle = [(5000 + 5000 * math.cos(a / 50 * math.pi), 5000 + 5000 * math.sin(a / 50 * math.pi)) for a in range(100)]
    hole = [(5000 + 700 * math.cos(a / 9), 5000 + 400 * math.sin(a / 9)) for a in range(56)]
    rings = {
        "thin": [[(-1e6, 3.0), (1e6, 3.5), (1e6, 3.6), (-1e6, 3.1)]],
        "huge": [circle, hole],
        "square": [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]],
        "tiny": [[(1.0, 1.0), (1.001, 1.0), (1.0, 1.001)]],
        "line": [[(0.0, 0.0), (5.0, 5.0)]],
        "dot": [[(2.0, 2.0)]],
        "empty": [],
        "broken": [[(0.0, 0.0), (float("nan"), 1.0), (1.0, 1.0)]],
        "null": None,
    }
    points = [(rng.uniform(-50, 10100), rng.uniform(-50, 10100)) for _ in range(400)]
    points += [(rng.uniform(-1e6, 1e6), rng.uniform(2.9, 3.7)) for _ in range(300)]
    points += [(rng.uniform(0.9, 1.1), rng.uniform(0.999, 1.002)) for _ in range(200)]
    points += [(float(a), float(b)) for a in range(-1, 10) for b in range(-1, 10)]
    points += [(a, b) for polygon in rings.values() for ring in polygon or [] for a, b in ring]
    rows = [(i, a, b) for i, (a, b) in enumerate(points)] + [(-1, None, 1.0), (-2, float("nan"), 3000.0)]

    def within(a, b, polygon):
        odd = False
        for ring in polygon:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (y1 > b) != (y2 > b) and a < (x2 - x1) * (b - y1) / (y2 - y1) + x1:
                    odd = not odd
        return odd

    table = spark.createDataFrame(list(rings.items()), "name string, rings array<array<struct<x: double, y: double>>>")
    got = spatial_join(spark.createDataFrame(rows, "id int, px double, py double"), table, "px", "py", "rings", cell=1e-6)
    whole = {name: polygon for name, polygon in rings.items() if polygon and name != "broken"}
    expected = sorted((i, name) for i, a, b in rows[:-2] for name, polygon in whole.items() if within(a, b, polygon))
    assert sorted((r["id"], r["name"]) for r in got.collect()) == expected
    assert {name for _, name in expected} == {"thin", "huge", "square", "tiny"}
    cells = cell_cover(table, "rings", 1e-6).groupBy("name").agg(
        F.count("*").alias("n"), F.count_if(F.size("__edges") == 1).alias("inner"), F.max(F.size("__edges")).alias("most")
    )
    cells = {r["name"]: r for r in cells.collect()}
    assert max(r["n"] for r in cells.values()) <= (CELLS + 1) ** 2 and cells["thin"]["n"] <= 2 * (CELLS + 1)
    assert cells["huge"]["inner"] > 4 and cells["huge"]["most"] < 100
    assert not {"empty", "broken", "null"} & set(cells)


def test_melt_keeps_odd_names(spark):
    df = spark.createDataFrame([("d", 1.5, 2)], "id string, `+1.1V_D (V)` double, n int")
    rows = reshape.melt(df, ["id"], ["+1.1V_D (V)", "n"]).collect()
    assert [tuple(r) for r in rows] == [("d", "+1.1V_D (V)", 1.5), ("d", "n", 2.0)]


def test_metric_codes(spark):
    from telemetry_lake.schemas import METRIC_CODES

    assert len(METRIC_CODES) == 35
    assert reshape.metric_dictionary(spark).count() == 35
    df = spark.createDataFrame([("altitude", 1.0), ("nothing", 2.0)], "ASMMetric string, data double")
    assert [tuple(r) for r in reshape.with_metric_code(df).collect()] == [("ASM-ALTITUDE", 1.0)]


def test_branch_takes_first_match(spark):
    df = spark.createDataFrame([("sensor-1",), ("sensor-11",), ("sensor-2",), ("x",), (None,)], "key string")
    numbered = reshape.branch(df, [F.col("key").startswith("sensor-1"), F.col("key").startswith("sensor")])
    assert [r["branch"] for r in numbered.collect()] == [0, 0, 1, 2, 2]


def test_group_stats_match_a_window(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    got = rollups.with_group_stats(df, ["k"], [F.sum("v").alias("s"), F.count("v").alias("n")])
    assert sorted(map(tuple, got.collect())) == [("a", 1.0, 4.0, 2), ("a", 3.0, 4.0, 2), ("b", 5.0, 5.0, 1)]


def test_large_arrays_become_several_documents(spark):
    import json

    rows = [("big", i) for i in range(95)] + [("small", i) for i in range(5)]
    documents = json_array_documents(spark.createDataFrame(rows, "g string, i int"), ["g"], ["i"], max_items=20).collect()
    small = [d for d in documents if d["g"] == "small"]
    assert [(d["part"], json.loads(d["document"])) for d in small] == [(0, [{"i": i} for i in range(5)])]
    big = [json.loads(d["document"]) for d in documents if d["g"] == "big"]
    assert len(big) > 1 and sorted(x["i"] for d in big for x in d) == list(range(95))
    assert all(d == sorted(d, key=lambda x: x["i"]) for d in big)
