"""Merkle manifest against a plain tree, and multiproofs of any set of leaves."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from telemetry_lake.llm import merkle

LOWER = {c: c + 32 for c in range(65, 91)}


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str], at: int) -> tuple[str, list[str], list[tuple[int, list[str]]]]:
    """Top of a tree, siblings of one leaf, and on each level its place in its run and the run."""
    siblings, way = [], []
    while len(nodes) > 1:
        first = at // 8 * 8
        run = nodes[first : first + 8]
        way.append((at - first, run))
        siblings += [x for i, x in enumerate(run) if i != at - first]
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], siblings, way


def expected(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
    subroots = [climb([x[2] for x in groups[g]], 0)[0] for g in order]
    out = []
    for t, g in enumerate(order):
        root, above, way_above = climb(subroots, t)
        for p, (_, _, own, row) in enumerate(groups[g]):
            sub, siblings, way = climb([x[2] for x in groups[g]], p)
            text, i = row["text"], row["doc_id"]
            if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0:
                text = text.translate(LOWER)
            node = leaf(row, text)
            for at, run in way + way_above:
                node = h(*run[:at], node, *run[at + 1 :])
            out.append((str(i), own, sub, root, h(*siblings, *above), node, node == root))
    return sorted(out)


def got(df) -> list[tuple]:
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_audit_matches_a_plain_tree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    found = got(merkle.audit(docs))
    assert found == expected(rows)
    assert 0 < sum(not r[-1] for r in found) < len(found) / 2


def test_odd_rows(spark):
    rows = [
        (1, "Ein Text", "web", "de", 8), (2, None, None, None, None), (3, "", "web", None, 0), (None, "Ohne", "web", "de", 4), (None, "Ohne", "web", "de", 4),
        (4, "Ä" * 70_000 + "B", "web", "ä", 70_001), (5, "Zwei", "x", "de", 4), (5, "Zwei", "x", "de", 4), (5, "zwei", "x", "de", 4), (6, "A:1", "", "", 3),
    ]
    rows += [(100 + i, f"Text {i % 3}", None, f"l{i % 20}", i) for i in range(70)]
    docs = spark.createDataFrame([(*r, 1, "r") for r in rows], "doc_id long, text string, source string, lang string, n_chars long, tree int, leaf string")
    assert got(merkle.audit(docs)) == expected(docs.collect())
    one = docs.filter("doc_id = 4")
    assert got(merkle.audit(one)) == expected(one.collect())
    assert merkle.audit(docs.limit(0)).count() == 0


def test_several_passes_over_small_leaf_partitions(spark):
    """With leaf partitions of 8 leaves a tree takes a pass per level, and proofs fetch nodes of all levels."""
    docs = spark.range(700).selectExpr("id AS doc_id", "concat('T', id) AS text", "'s' AS source", "if(id % 9 = 0, null, if(id % 3 = 0, 'en', 'de')) AS lang", "id AS n_chars")
    assert got(merkle.audit(docs, span=1)) == expected(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 513, 1000])
def test_multiproofs_fetch_the_fewest_nodes(n):
    chance = random.Random(n)
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([merkle.h(x.hex().encode() for x in below[i : i + 8]) for i in range(0, len(below), 8)])
    for some in ([0], [n - 1], list(range(n)), sorted(chance.sample(range(n), min(n, 5)))):
        wanted = merkle.missing(some, n)
        assert len(wanted) == len(set(wanted))
        known = merkle.Known(n, [*((lv, i, levels[lv][i]) for lv, i in wanted), *((0, i, leaves[i]) for i in some)])
        known.derive()
        assert known.top() == levels[-1][0].hex().encode()
        for i in some:
            assert merkle.fold(leaves[i].hex().encode(), known.siblings(i)) == known.top()
        # Nothing fetched is a leaf's own ancestor: those follow from the leaves.
        own = {(lv, i // 8**lv) for i in some for lv in range(len(levels))}
        assert not own & set(wanted)


def test_proofs_of_chosen_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = merkle.manifest(docs)
    some = made.leaves.filter("doc_id % 17 = 0")
    proven = merkle.prove(made, some).collect()
    root = made.trees.first()["root"].hex()
    assert len(proven) == some.count() > 0 and {r["folded_root"] for r in proven} == {root}
    for r in proven:
        node, way = r["leaf"], r["siblings"]
        for before, after in zip(way[::2], way[1::2]):
            node = h(before, node, after)
        assert node == root and r["proof_sha256"] == h(*way)
