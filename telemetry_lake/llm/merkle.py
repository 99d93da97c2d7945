"""Merkle manifest of a dataset: a tree of hashes per group, proofs by octopus multiproofs.

Every row is a leaf. The leaves of a group ascend by id; every eight consecutive nodes (the last run
may be shorter, even a single one) become their hash until one node is left, the group's *subroot*.
The subroots in order of their groups are the leaves of one more tree, whose top is the root.

Spark numbers the leaves by one range sort; the numbers in a task and one count per task and group
give every leaf its place. A leaf partition is an aligned run of ``8 ** span`` places of a group. One
pass over leaf partitions makes their interior nodes and hands their tops on to the next pass, so the
number of passes is the logarithm of the rows to that base.

Proofs are an octopus multiproof for each leaf partition: it names the nodes that its leaves need and
that do not follow from its leaves, each once however many of its leaves need them; one join fetches
them; interiors that leaves share are derived once; then each leaf's own proof is read off locally.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import written

#: Nodes of a run, and the levels a leaf partition holds.
ARITY, SPAN = 8, 4
#: The tree over the subroots.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Manifest(NamedTuple):
    """``leaves``: a row each with ``tree``, ``pos`` and the number ``n`` of leaves of its tree; ``nodes``:
    every node of every tree; ``trees``: ``tree``, its ``subroot``, the ``root`` and the number of trees."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    #: Levels a leaf partition holds.
    span: int = SPAN


def h(parts: Iterable[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(fields[c]) for c in FIELDS]), 256))


def numbered(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos`` (place in its group, from 0, by ``order``) and ``n`` (rows of the group).

    One range shuffle by group and order. The window sees one row per task and group.
    """
    sort = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    place = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("at", place)
    placed = written(placed.withColumns({"task": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)}), label)
    keys = ["task", *group]
    runs = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    of_group = Window.partitionBy(*(group or [F.lit(0)]))
    before = F.coalesce(F.sum("rows").over(of_group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*[F.col(k).alias(f"run_{k}") for k in keys], (before - F.col("first")).alias("shift"), F.sum("rows").over(of_group).alias("n"))
    same = [F.col(k).eqNullSafe(F.col(f"run_{k}")) for k in keys]
    joined = placed.join(runs, same).withColumn("pos", F.col("at") + F.col("shift"))
    return joined.drop("at", "task", "shift", *[f"run_{k}" for k in keys])


def depth(n: int) -> int:
    """Level of the top of a tree of ``n`` leaves."""
    level = 0
    while n > 1:
        n, level = -(-n // ARITY), level + 1
    return level


def _interiors(span: int):
    """The nodes above one aligned run of nodes, up to ``span`` levels or the tree's top."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, level, n, first = (table.column(c)[0].as_py() for c in ("tree", "level", "n", "idx"))
        nodes = table.column("hash").to_pylist()
        levels, places, sizes, hashes = [], [], [], []
        for step in range(1, span + 1):
            if n == 1:
                break
            first, n = first // ARITY, -(-n // ARITY)
            nodes = [h(x.hex().encode() for x in nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            levels += [level + step] * len(nodes)
            places += range(first, first + len(nodes))
            sizes += [n] * len(nodes)
            hashes += nodes
        return pa.table(
            {"tree": pa.array([tree] * len(levels), pa.int64()), "level": pa.array(levels, pa.int32()), "idx": pa.array(places, pa.int64()), "n": pa.array(sizes, pa.int64()), "hash": pa.array(hashes, pa.binary())}
        )

    return run


def all_nodes(leaves: DataFrame, span: int) -> DataFrame:
    """Every node of every tree over ``tree``, ``pos``, ``n``, ``leaf``: ``tree``, ``level``, ``idx``, ``n``
    (nodes of that level), ``hash``; leaves included."""
    floor = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "n", F.col("leaf").alias("hash"))
    nodes, open_ = floor, floor.filter("n > 1")
    largest = leaves.agg(F.max("n")).first()[0] or 0
    for done in range(0, depth(largest), span):
        part = F.expr(f"idx div {ARITY**span}")
        made = open_.groupBy("tree", part.alias("part")).applyInArrow(_interiors(span), "tree long, level int, idx long, n long, hash binary")
        made = written(made, "merkle-nodes")
        nodes = nodes.unionByName(made)
        open_ = made.filter((F.col("level") == done + span) & (F.col("n") > 1))
    return nodes


def top_of_each(nodes: DataFrame) -> DataFrame:
    """``tree``, ``top``: the node that is alone on its level, lowest such level first."""
    return nodes.filter("n = 1").groupBy("tree").agg(F.min_by("hash", "level").alias("top"))


def manifest(docs: DataFrame, span: int = SPAN) -> Manifest:
    """Trees of the rows of ``docs`` per ``lang``.

    ``leaves`` keeps ``doc_id`` and has ``leaf`` and ``changed``, the hash of the row whose text had its
    letters A-Z lowered (null unless 3 divides the id's crc32). Missing values are part of the hash;
    a missing ``lang`` is a group of its own and comes first. Rows of one id, and rows without one (they
    come first), are in order of their hashes, so repeated rows are leaves side by side. Further columns
    are ignored. An empty table has no trees.
    """
    plain = {c: F.col(c) for c in FIELDS}
    altered = leaf_hash({**plain, "text": F.translate("text", CAPITALS, SMALL)})
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select("doc_id", "lang", leaf_hash(plain).alias("leaf"), F.when(hit, altered).alias("changed"))
    # Texts are read once; the number parts equal rows, of which one task might otherwise get very many.
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    leaves = numbered(rows, ["lang"], ["doc_id", "leaf", "row"], "merkle-leaves").drop("row")
    langs = leaves.groupBy("lang").agg(F.first("n").alias("leaves"))
    trees = written(numbered(langs, [], ["lang"], "merkle-groups").select("lang", F.col("pos").alias("tree"), F.col("n").alias("trees")), "merkle-trees")
    named = trees.select(F.col("lang").alias("name"), "tree")
    leaves = leaves.join(named, F.col("lang").eqNullSafe(F.col("name"))).drop("name")
    leaves = written(leaves, "merkle-placed")
    nodes = all_nodes(leaves.select("tree", "pos", "n", "leaf"), span)
    subroots = written(trees.join(top_of_each(nodes), "tree").withColumnRenamed("top", "subroot"), "merkle-subroots")
    above = all_nodes(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("n"), F.col("subroot").alias("leaf")), span)
    root = top_of_each(above).select(F.col("top").alias("root"))
    return Manifest(leaves, nodes.unionByName(above).drop("n"), written(subroots.join(root), "merkle-roots"), span)


# -- multiproofs ------------------------------------------------------------------------------


def missing(known: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The fewest coordinates (level, place) that prove the leaves at ``known`` of a tree of ``n`` leaves:
    the others of each run that holds a known node; what a run makes is known one level up."""
    out, level = [], 0
    here = np.unique(np.fromiter(known, np.int64))
    while n > 1:
        runs = np.unique(here // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).reshape(-1)
        out += [(level, int(i)) for i in np.setdiff1d(members[members < n], here, assume_unique=True)]
        here, n, level = runs, -(-n // ARITY), level + 1
    return out


def _needs(table: pa.Table) -> pa.Table:
    """Coordinates that one leaf partition misses: those of its own tree, and of the tree of subroots."""
    tree, part, n, trees = (table.column(c)[0].as_py() for c in ("tree", "part", "n", "trees"))
    own = [(tree, *at) for at in missing(table.column("pos").to_pylist(), n)]
    own += [(TOP, *at) for at in missing([tree], trees)]
    of, levels, idx = map(list, zip(*own)) if own else ([], [], [])
    return pa.table(
        {"for_tree": pa.array([tree] * len(own), pa.int64()), "part": pa.array([part] * len(own), pa.int64()), "tree": pa.array(of, pa.int64()), "level": pa.array(levels, pa.int32()), "idx": pa.array(idx, pa.int64())}
    )


class Known:
    """Nodes of one tree that a leaf partition knows, as hexadecimal text, by level and place."""

    def __init__(self, n: int, given: Iterable[tuple[int, int, bytes]]):
        self.levels: dict[int, dict[int, bytes]] = defaultdict(dict)
        self.kept: dict[tuple[int, int], tuple[bytes, bytes]] = {}
        for level, idx, node in given:
            self.levels[level][idx] = node.hex().encode()
        self.steps, self.sizes = depth(n), [n]
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // ARITY))

    def derive(self) -> None:
        """Interiors of the runs that hold a node, level by level."""
        for level in range(self.steps):
            nodes, up = self.levels[level], self.levels[level + 1]
            for run in {i // ARITY for i in nodes}:
                if run not in up:
                    up[run] = h(nodes[i] for i in self.run(level, run)).hex().encode()

    def run(self, level: int, run: int) -> range:
        return range(run * ARITY, min(run * ARITY + ARITY, self.sizes[level]))

    def sides(self, level: int, idx: int) -> tuple[bytes, bytes]:
        """The run's nodes before and after a node."""
        if (level, idx) not in self.kept:
            nodes, members = self.levels[level], self.run(level, idx // ARITY)
            self.kept[level, idx] = b"".join([nodes[i] for i in members if i < idx]), b"".join([nodes[i] for i in members if i > idx])
        return self.kept[level, idx]

    def siblings(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """On each level: the run's nodes before and after the one above ``leaf``."""
        return [self.sides(level, leaf // ARITY**level) for level in range(self.steps)]

    def top(self) -> bytes:
        return self.levels[self.steps][0]


def fold(node: bytes, siblings: Iterable[tuple[bytes, bytes]]) -> bytes:
    """The top that ``node`` and its siblings give; hexadecimal text."""
    for before, after in siblings:
        node = h((before, node, after)).hex().encode()
    return node


PROVEN = "tree long, doc_id long, leaf string, proof_sha256 string, folded_root string"


def _expand(whole: bool):
    """Each leaf's proof, and the root that follows from the leaf as it is now."""

    def run(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        tree, n, trees = (leaves.column(c)[0].as_py() for c in ("tree", "n", "trees"))
        pos, leaf, now = (leaves.column(c).to_pylist() for c in ("pos", "leaf", "now"))
        given: dict[int, list] = {tree: [], TOP: []}
        for of, *node in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx", "hash"))):
            given[of].append(node)
        own = Known(n, [*given[tree], *((0, p, x) for p, x in zip(pos, leaf))])
        own.derive()
        above = Known(trees, [*given[TOP], (0, tree, bytes.fromhex(own.top().decode()))])
        above.derive()
        shared = above.siblings(tree)
        siblings, digests, folded = [], [], []
        for p, new in zip(pos, now):
            way = own.siblings(p) + shared
            digests.append(h(x for pair in way for x in pair).hex())
            folded.append(fold(new.hex().encode(), way).decode())
            if whole:
                siblings.append([x.decode() for pair in way for x in pair])
        columns = {"tree": leaves.column("tree"), "doc_id": leaves.column("doc_id"), "leaf": [x.hex() for x in leaf], "proof_sha256": digests, "folded_root": folded}
        return pa.table(columns | ({"siblings": pa.array(siblings, pa.list_(pa.string()))} if whole else {}))

    return run


def prove(of: Manifest, chosen: DataFrame | None = None, whole: bool = True) -> DataFrame:
    """Proofs of leaves: ``tree``, ``doc_id``, ``leaf``, ``proof_sha256``, ``folded_root`` and, if ``whole``, ``siblings``
    (from the leaf to the root two texts per level: the run's hashes before and after).

    ``chosen`` are the rows of ``of.leaves`` to prove, all by default; with a column ``now`` the fold begins
    at that hash instead of the leaf's own.
    """
    leaves = of.leaves if chosen is None else chosen
    if "now" not in leaves.columns:
        leaves = leaves.withColumn("now", F.col("leaf"))
    count = of.trees.select("tree", "trees")
    leaves = leaves.join(count, "tree").withColumn("part", F.expr(f"pos div {ARITY**of.span}"))
    needs = leaves.select("tree", "part", "pos", "n", "trees").groupBy("tree", "part").applyInArrow(_needs, "for_tree long, part long, tree long, level int, idx long")
    fetched = needs.join(of.nodes, ["tree", "level", "idx"])
    left = leaves.select("tree", "part", "pos", "n", "trees", "doc_id", "leaf", "now").groupBy("tree", "part")
    return left.cogroup(fetched.groupBy("for_tree", "part")).applyInArrow(_expand(whole), PROVEN + (", siblings array<string>" if whole else ""))


def audit(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Proof of every row, checked against the root after the rows of every third id (by crc32) had their
    letters lowered. Columns ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    Rows without an id are leaves and are never altered. For odd rows see :func:`manifest`.
    """
    made = manifest(docs, span)
    proven = prove(made, made.leaves.withColumn("now", F.coalesce("changed", "leaf")), whole=False)
    tops = made.trees.select("tree", F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex("root")).alias("root"))
    checked = proven.join(tops, "tree").withColumn("verified", F.col("folded_root") == F.col("root"))
    return checked.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
