"""Nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Equal vectors are one point of a graph, with the few smallest ids that could ever be returned; copies
meet within tasks before they are shuffled. Points are dealt to shards by a hash. A shard's index is
one row: its vectors and, for each level of the graph, one flat array of neighbours. Every block of
queries meets every shard; a query's results from all shards are merged by distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import written

#: Distinct vectors of a shard, and queries of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 2048, 1024
#: Links of a point (twice as many on the lowest level); how widely to search when building and asking.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 10, 40, 80
K = 10


def distances(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = points - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Graph:
    """``links[level]`` is a flat array of ``width`` neighbours for each point, -1 where there is none."""

    def __init__(self, points: np.ndarray, links: list[np.ndarray], entry: int):
        self.points, self.links, self.entry = points, links, entry

    def around(self, q: np.ndarray, starts: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest points found from ``starts``, nearest first."""
        seen = np.zeros(len(self.points), bool)
        seen[[i for _, i in starts]] = True
        todo = list(starts)
        heapq.heapify(todo)
        best = [(-d, i) for d, i in starts]
        heapq.heapify(best)
        links = self.links[level]
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            near = links[i]
            near = near[near >= 0]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            for e, j in zip(distances(self.points[near], q).tolist(), near.tolist()):
                if len(best) < width or e < -best[0][0]:
                    heapq.heappush(todo, (e, j))
                    heapq.heappush(best, (-e, j))
                    if len(best) > width:
                        heapq.heappop(best)
        return sorted((-d, i) for d, i in best)

    def nearest(self, q: np.ndarray, width: int, k: int) -> list[tuple[float, int]]:
        at = [(float(distances(self.points[[self.entry]], q)[0]), self.entry)]
        for level in range(len(self.links) - 1, 0, -1):
            at = self.around(q, at[:1], 1, level)
        return self.around(q, at, max(width, k), 0)[:k]


def spread_out(points: np.ndarray, candidates: list[tuple[float, int]], most: int) -> list[int]:
    """Near candidates that are nearer to the point than to each other, filled up with the nearest."""
    ids = np.array([i for _, i in candidates])
    if len(ids) <= most:
        return ids.tolist()
    own = np.array([d for d, _ in candidates])
    squares = np.einsum("ij,ij->i", points[ids], points[ids])
    between = squares[:, None] + squares - 2 * points[ids] @ points[ids].T
    alive, chosen = np.ones(len(ids), bool), []
    for k in range(len(ids)):
        if alive[k]:
            chosen.append(k)
            if len(chosen) == most:
                break
            alive &= between[k] >= own**2
    for k in range(len(ids)):
        if len(chosen) >= most:
            break
        if k not in chosen:
            chosen.append(k)
    return ids[chosen].tolist()


def build(points: np.ndarray, seed: int = 8) -> Graph:
    n = len(points)
    height = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int), 8)
    links = [np.full((n, 2 * LINKS if level == 0 else LINKS), -1, np.int32) for level in range(int(height.max()) + 1)]
    graph = Graph(points, links, 0)
    top = int(height[0])
    for i in range(1, n):
        q = points[i]
        at = [(float(distances(points[[graph.entry]], q)[0]), graph.entry)]
        for level in range(top, int(height[i]), -1):
            at = graph.around(q, at[:1], 1, level)
        for level in range(min(top, int(height[i])), -1, -1):
            at = graph.around(q, at, BUILD_WIDTH, level)
            own = spread_out(points, at, LINKS)
            links[level][i, : len(own)] = own
            for j in own:
                row = links[level][j]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = i
                else:
                    known = np.append(row, i)
                    d = distances(points[known], points[j])
                    order = np.argsort(d, kind="stable")
                    kept = spread_out(points, [(d[k], int(known[k])) for k in order], len(row))
                    row[:] = -1
                    row[: len(kept)] = kept
        if height[i] > top:
            top, graph.entry = int(height[i]), i
    return graph


def clean(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``v`` (doubles, -0 as 0), ``dim`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = embeddings.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", v.alias("v")).filter(usable)
    return rows.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"), F.size("v").alias("dim"))


def _few_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector of a batch once, as bytes, with its K + 1 smallest ids: a query's own id may be among them."""
    for batch in batches:
        ids: dict[bytes, list[int]] = {}
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v")):
            ids.setdefault(np.asarray(v.values, "<f8").tobytes(), []).append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(ids), pa.binary()), pa.array([sorted(set(x))[: K + 1] for x in ids.values()], pa.list_(pa.int64()))],
            names=["vector", "ids"],
        )


INDEX = "shard long, dim int, vectors binary, ids array<array<bigint>>, entry int, widths array<int>, links binary"


def _index(key: tuple, table: pa.Table) -> pa.Table:
    known: dict[bytes, set] = {}
    for v, ids in zip(table.column("vector").to_pylist(), table.column("ids").to_pylist()):
        known.setdefault(v, set()).update(ids)
    vectors = sorted(known)
    points = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    graph = build(points)
    row = {
        "shard": key[0].as_py(), "dim": points.shape[1], "vectors": points.tobytes(), "ids": [sorted(known[v])[: K + 1] for v in vectors],
        "entry": graph.entry, "widths": [x.shape[1] for x in graph.links], "links": b"".join(x.tobytes() for x in graph.links),
    }
    return pa.Table.from_pylist([row], pa.schema([
        ("shard", pa.int64()), ("dim", pa.int32()), ("vectors", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64()))),
        ("entry", pa.int32()), ("widths", pa.list_(pa.int32())), ("links", pa.binary()),
    ]))


def stored_graph(row: dict) -> Graph:
    points = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
    flat, links, at = np.frombuffer(row["links"], np.int32), [], 0
    for width in row["widths"]:
        links.append(flat[at : at + len(points) * width].reshape(-1, width))
        at += len(points) * width
    return Graph(points, links, row["entry"])


FOUND = "query_id long, vector binary, vec_id long, score double"


def _search(queries: pa.Table, index: pa.Table) -> pa.Table:
    out = []
    if queries.num_rows and index.num_rows:
        row = index.to_pylist()[0]
        graph = stored_graph(row)
        for q in queries.select(["query_id", "vector"]).to_pylist():
            found = graph.nearest(np.frombuffer(q["vector"], "<f8"), SEARCH_WIDTH, K + 1)
            rows = [(d, i) for d, point in found for i in row["ids"][point] if i != q["query_id"]]
            out += [{**q, "vec_id": i, "score": d} for d, i in sorted(rows)[:K]]
    return pa.Table.from_pylist(out, pa.schema([("query_id", pa.int64()), ("vector", pa.binary()), ("vec_id", pa.int64()), ("score", pa.float64())]))


def index_shards(rows: DataFrame, shards: int) -> DataFrame:
    """A row per shard with its graph (:data:`INDEX`). ``rows`` are those of :func:`clean`."""
    distinct = rows.mapInArrow(_few_ids, "vector binary, ids array<bigint>")
    shard = F.pmod(F.xxhash64("vector"), F.lit(shards)) + F.octet_length("vector").cast("bigint") * shards
    return written(distinct.withColumn("shard", shard).groupBy("shard").applyInArrow(_index, INDEX), "neighbours-index")


def search(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """The :data:`K` nearest vectors of each query: rows whose ``vec_id`` is divisible by ``every``.

    Returns ``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance in double precision),
    ties to the smaller id. Vectors that are null, empty, zero or hold null or non-finite numbers take
    no part, nor do rows without an id; vectors are only compared with those of their length. A row
    that repeats an id counts as the same vector of that id, or as another; it is no neighbour of its
    own id. Further columns are ignored; an empty table gives an empty result.
    """
    rows = clean(embeddings)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    index = index_shards(rows, shards)
    queries = written(
        rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "dim", "v").distinct().mapInArrow(_as_bytes, "query_id long, dim int, vector binary"),
        "neighbours-queries",
    )
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    # Every block of queries with every shard of its length of vectors, one pair at a time.
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    asked = numbered.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        "query_id", "vector", "block", (F.col("n") + F.col("dim").cast("bigint") * 8 * shards).alias("shard")
    )
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    found = asked.groupBy("shard", "block").cogroup(offered.groupBy("shard", "block")).applyInArrow(_search, FOUND)
    best = F.slice(F.array_sort(F.collect_set(F.struct("score", "vec_id"))), 1, K)
    merged = found.groupBy("query_id", "vector").agg(best.alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), "b.vec_id", "b.score"
    )


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.asarray(v.values, "<f8").tobytes() for v in batch.column("v")]
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("dim"), pa.array(vectors, pa.binary())], names=["query_id", "dim", "vector"])
