"""Shards of near equal size by histogram sort.

Rows are sorted by a key, and the sort's partitions are the shards. The key is a hash of the text, then of
the id, then of the row's number, so copies of a text lie side by side and a shard ends inside a group of
copies only where the group is larger than the tolerance.

Splitters are found before any row moves. Each splitter has an interval of keys that holds its target,
the number of bytes that should lie below it. Probes are laid into all intervals, one pass over a
narrow table of keys counts exactly the bytes between neighbouring probes, and each interval shrinks to
the span between the two probes around its target. When all splitters are within tolerance, or no key is
left between two probes, the rows are exchanged once, each straight to its place, and sorted there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import written

#: Share of a shard's size by which its bounds may miss.
TOLERANCE = 0.01
#: Probes in an open interval, each round.
PROBES = 32
#: Bytes that one task sorts, and the most tasks over all shards. Both only set how a shard is divided.
PART_BYTES, MAX_PARTS = 32 << 20, 8192
#: Share of a part's size by which bounds inside a shard may miss.
LOOSE = 0.25

KEY = ["k1", "k2", "k3"]
_HALF = 1 << 63
#: Where the text's hash, and the id's, end within a key of three 64-bit numbers.
EDGES = (1 << 128, 1 << 64, 1)
END = 1 << 192


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64("doc_id"), "k3": F.xxhash64(F.monotonically_increasing_id())}
    )


def packed_keys(*columns: np.ndarray) -> np.ndarray:
    """Three columns of signed numbers as byte strings of the same order."""
    rows = np.empty((len(columns[0]), len(columns)), ">u8")
    for i, c in enumerate(columns):
        rows[:, i] = np.asarray(c, np.int64).view(np.uint64) ^ np.uint64(_HALF)
    return np.ascontiguousarray(rows).view("S24").reshape(-1)


def packed_numbers(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(24, "big") for k in keys], "S24")


@dataclass
class Splitter:
    """A bound that should have ``target`` bytes below it, known to lie between two keys."""

    target: float
    slack: float
    low: int = 0
    high: int = END
    #: Bytes and rows below ``low`` and ``high``.
    below: tuple[int, int] = (0, 0)
    above: tuple[int, int] = (0, 0)

    def best(self) -> int:
        return self.low if self.target - self.below[0] <= self.above[0] - self.target else self.high

    def settled(self) -> bool:
        miss = min(self.target - self.below[0], self.above[0] - self.target)
        return miss <= self.slack or self.above[1] - self.below[1] <= 1

    def probes(self) -> list[int]:
        """Keys inside the interval, on bounds between texts, else between ids, else anywhere."""
        for edge in EDGES:
            first, last = self.low // edge + 1, -(-self.high // edge) - 1
            if first <= last:
                step = max(1, -(-(last - first + 1) // PROBES))
                return [k * edge for k in range(first, last + 1, step)]
        return []

    def narrow(self, keys: list[int], below: list[tuple[int, int]], spans: list[tuple[int, int] | None]) -> None:
        """Shrink to the span between the probes around the target: ``keys`` ascend, ``below`` holds bytes and
        rows below each, ``spans`` the least and largest key from each to the next."""
        i = max(k for k in range(len(keys)) if below[k][0] <= self.target)
        if i + 1 < len(keys) and spans[i]:
            self.low, self.high = spans[i][0], spans[i][1] + 1
            self.below, self.above = below[i], below[i + 1]


def _histogram(probes: list[int]):
    """Bytes, rows, least and largest key between neighbouring probes, for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = packed_numbers(probes)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = packed_keys(*(np.array(batch.column(c)) for c in KEY))
            order = np.argsort(keys, kind="stable")
            keys, sizes = keys[order], np.array(batch.column("size"))[order]
            spans = np.searchsorted(bounds, keys, side="right")
            spans, first, rows = np.unique(spans, return_index=True, return_counts=True)
            width = lambda at: pa.array([k.ljust(24, b"\0") for k in keys[at].tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(spans, pa.int64()), pa.array(np.add.reduceat(sizes, first)), pa.array(rows, pa.int64()), width(first), width(first + rows - 1)],
                names=["span", "bytes", "rows", "low", "high"],
            )

    return run


def count_between(keys: DataFrame, probes: list[int], open_: list[Splitter]) -> dict[int, tuple[int, int, int, int]]:
    """By number of probes at or below it: bytes, rows, least and largest key of the rows in the open intervals."""
    inside = F.lit(False)
    for low, high in sorted({((s.low >> 128) - _HALF, ((s.high - 1) >> 128) - _HALF) for s in open_}):
        inside = inside | F.col("k1").between(low, high)
    parts = keys.filter(inside).mapInArrow(_histogram(probes), "span long, bytes long, rows long, low binary, high binary")
    found = parts.groupBy("span").agg(F.sum("bytes"), F.sum("rows"), F.min("low"), F.max("high")).collect()
    return {r[0]: (r[1], r[2], int.from_bytes(r[3], "big"), int.from_bytes(r[4], "big")) for r in found}


def find_splitters(keys: DataFrame, splitters: list[Splitter], total: tuple[int, int]) -> list[int]:
    """Keys that split the rows at the targets.

    The driver holds :data:`PROBES` counts for each open splitter, whatever the number of rows.
    """
    for s in splitters:
        s.above = total
    while open_ := [s for s in splitters if not s.settled()]:
        # Intervals are equal or apart, so each is counted from its own lower end.
        intervals = {(s.low, s.high): s for s in open_}
        laid = {at: [s.low, *s.probes(), s.high] for at, s in intervals.items()}
        probes = sorted({k for ks in laid.values() for k in ks} - {END})
        index = {k: i + 1 for i, k in enumerate(probes)}
        counts = count_between(keys, probes, list(intervals.values()))
        for s in open_:
            ks = laid[s.low, s.high]
            below, spans = [s.below], []
            for k in ks[:-1]:
                size, rows, low, high = counts.get(index[k], (0, 0, 0, 0))
                below.append((below[-1][0] + size, below[-1][1] + rows))
                spans.append((low, high) if rows else None)
            s.narrow(ks, below, [*spans, None])
    return [s.best() for s in splitters]


def shard(docs: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``docs``, all columns, with ``shard`` (from 0) and ``slot`` (place in the shard, gapless from 0).

    A row's size is the UTF-8 bytes of ``text`` and one more. Shards miss equal size by ``tolerance`` on each
    side or by half of a row. Null texts are copies of each other, as are empty ones; rows without an id and
    repeated rows are told apart by their number in the input. Columns named like the operator's own are
    kept as they are. An empty table gives no rows.

    The result is a written table whose files are the shards' parts.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    plain = docs.select(own, F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    keys = written(with_key(plain).select(size_of(F.col("text")).alias("size"), *KEY), "shard-keys")
    size, rows = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not rows:
        return docs.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    each = min(max(1, -(-size // (shards * PART_BYTES))), max(1, MAX_PARTS // shards))
    parts = shards * each
    wanted = [Splitter(size * p / parts, tolerance * size / shards if p % each == 0 else LOOSE * size / parts) for p in range(1, parts)]
    bounds = sorted(k for k in find_splitters(keys, wanted, (size, rows)) if k < END)

    @F.pandas_udf("int")
    def part_of(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(packed_numbers(bounds), packed_keys(k1, k2, k3), side="right").astype(np.int32))

    placed = with_key(plain).select("row", *KEY).withColumn("part", part_of(*KEY))
    moved = placed.repartitionById(parts, F.col("part")).sortWithinPartitions(*KEY)
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    moved = written(moved.select("row", "part", at.alias("at")), "shards")
    held = moved.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    held = held.select("part", F.expr(f"part div {each}").cast("int").alias("shard"), "rows")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("part", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return moved.join(held, "part").select("row.*", "shard", (F.col("before") + F.col("at")).alias("slot"))


def places(sharded: DataFrame) -> DataFrame:
    """Where each row lies: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    return sharded.select(
        "doc_id", size_of(F.col("text")).alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
