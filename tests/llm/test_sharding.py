"""Histogram sort: shards against a plain sort, and its bounds."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pytest

from telemetry_lake.llm import sharding


def size(text) -> int:
    return len((text or "").encode()) + 1


def check(rows, found, shards: int = 8) -> dict[int, int]:
    """Every row once, slots gapless, sizes as they are; returns bytes per shard."""
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    out = found.collect()
    want = sorted((str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    slots, held = defaultdict(list), defaultdict(int)
    for r in out:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return held


def test_sizes_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    held = check(rows, sharding.places(sharding.shard(docs, 8)))
    ideal = sum(held.values()) / 8
    # A bound misses its target by the tolerance, or by half of the row that lies on it.
    assert all(abs(b - ideal) <= 2 * max(sharding.TOLERANCE * ideal, max(size(t) for _, t in rows) / 2) for b in held.values())
    assert max(held.values()) < 1.05 * ideal


def test_order_is_that_of_the_key(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = sharding.shard(docs, 5).selectExpr("shard", "slot", "xxhash64(text) AS k1", "xxhash64(doc_id) AS k2").collect()
    keys = [(r["k1"], r["k2"]) for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert keys == sorted(keys) and {r["shard"] for r in out} == set(range(5))


def test_hot_groups_are_split_only_where_they_must(spark):
    rows = [(i, f"text {i} " * 40) for i in range(400)]
    rows += [(1000 + i, "copy " * 100) for i in range(300)]  # far more than a shard
    rows += [(2000 + i, f"pair {i // 2} " * 30) for i in range(200)]
    rows += [(None, "none " * 80)] * 150 + [(7, "same " * 80)] * 150  # equal in every column
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sharded = sharding.shard(docs, 8)
    held = check(rows, sharding.places(sharded))
    ideal = sum(held.values()) / 8
    assert max(held.values()) < 1.06 * ideal and min(held.values()) > 0.94 * ideal
    pieces = sharded.groupBy("text").agg({"shard": "min"}).count(), sharded.select("text", "shard").distinct().count()
    assert pieces[1] - pieces[0] <= 7


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, None), (4, "é" * 40_000), (5, "b")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], "doc_id long, text string, k1 int, part int, at int, row string")
    sharded = sharding.shard(docs, 8)
    assert sharded.columns == [*docs.columns, "shard", "slot"]
    check(rows, sharding.places(sharded))
    check([], sharding.places(sharding.shard(docs.limit(0), 8)))
    check(rows[:1], sharding.places(sharding.shard(docs.limit(1), 8)))


def test_many_parts(spark, monkeypatch):
    """Shards that are sorted in several parts are still gapless and in order."""
    monkeypatch.setattr(sharding, "PART_BYTES", 20_000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sharded = sharding.shard(docs, 8)
    assert sharded.rdd.getNumPartitions() >= 1
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, sharding.places(sharded))


@pytest.mark.parametrize("keys", [[5, 5, 5, 5], [1 << 130, (1 << 130) + 3, (3 << 130) + (7 << 64)], list(range(0, 1 << 192, 1 << 186))])
def test_probes_lie_inside(keys):
    s = sharding.Splitter(1.0, 0.0, low=min(keys), high=max(keys) + 1)
    probes = s.probes()
    assert all(s.low < p < s.high for p in probes) and probes == sorted(set(probes))
    assert len(probes) <= sharding.PROBES
    assert bool(probes) == (s.high - s.low > 1)
