"""Near-duplicate detection against all pairs."""

from __future__ import annotations

import re
import tracemalloc

import pyarrow as pa

import corpus_pipeline
from telemetry_lake.llm import near_dedup

from . import brute


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in brute.words(text)]
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set()


def expected(rows):
    sets = [shingles(t) if i is not None else set() for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_set: dict = {}
    for (i, _), s in zip(rows, sets):
        if s:
            by_set.setdefault(frozenset(s), []).append(i)
    keys = list(by_set)
    for ids in by_set.values():
        for other in ids[1:]:
            a, b = sorted((find(ids[0]), find(other)))
            parent[b] = a
    for x in range(len(keys)):
        for y in range(x):
            small, large = sorted((len(keys[x]), len(keys[y])))
            if 100 * small >= 80 * large:
                n = len(keys[x] & keys[y])
                if 100 * n >= 80 * (len(keys[x]) + len(keys[y]) - n):
                    a, b = sorted((find(by_set[keys[x]][0]), find(by_set[keys[y]][0])))
                    parent[b] = a
    return sorted(
        (str(i), len(shingles(t)), str(None if i is None else find(i)), i is None or find(i) == i) for i, t in rows
    )


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in df.collect())


def test_components_match_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(near_dedup.group(docs)) == expected(rows)
    kept = near_dedup.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r[3] for r in expected(rows))


def test_odd_rows_and_large_groups(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one "), (6, "b a"), (7, "A b"), (8, "a B"), (None, "a b"), (None, None), (9, "a b c"), (9, "x y z"), (10, "X y z")]
    # Chains of near copies, each like the next but not like the last.
    for i in range(150):
        w = base.split()
        w[i % 60] = f"x{i}"
        w[(7 * i) % 60] = f"y{i % 9}"
        rows.append((100 + i, " ".join(w)))
    for i in range(40):
        rows.append((1000 + i, " ".join(f"c{k}" for k in range(i, i + 40))))
    rows.append((5000, "long " * 40_000 + "tail"))
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, component_id string")
    assert got(near_dedup.group(docs)) == expected(rows)
    assert near_dedup.group(docs.limit(0)).count() == 0


def test_bounds_of_the_sequential_test():
    least = near_dedup.least_agreement(0.8, 1e-6)
    assert list(least) == [32, 64, 96, 128]
    assert all(0 < m < 0.8 * n for n, m in least.items())
    assert least[128] / 128 > least[32] / 32


def test_pipeline_stage_takes_five_words(spark):
    """Eight edits in 200 words: 0.85 of the two-word shingles agree, 0.66 of the five-word ones."""
    words = [f"w{i}" for i in range(200)]
    edited, once = list(words), list(words)
    for i in range(8):
        edited[12 + 25 * i] = f"x{i}"
    once[100] = "y"
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(once)), (4, "a b c d"), (5, "A b c d"), (6, "a b c"), (7, "a"), (8, ""), (9, None), (None, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = lambda df: sorted(str(r["doc_id"]) for r in df.collect())
    assert left(corpus_pipeline.one_of_each(spark, docs, "")) == sorted(str(i) for i in (1, 2, 4, 6, 7, 8, 9, None))
    assert left(near_dedup.representatives(docs, 2)) == sorted(str(i) for i in (1, 4, 6, 7, 8, 9, None))
    sets = near_dedup.shingle_sets([words_.encode() for _, words_ in rows[:2]], 5)
    assert [len(s) for s in sets] == [196, 196] and len(set(sets[0].tolist()) & set(sets[1].tolist())) == 156


def test_signing_holds_little_beside_the_texts():
    """A worker's own arrays stay small however many texts a batch has."""
    texts = [" ".join(f"w{(i * 7919 + k * k) % 50000}" for k in range(400)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    want = [near_dedup.digest_of(s) for s in near_dedup.shingle_sets([t.encode() for t in texts[:20]])]
    tracemalloc.start()
    digests, peak = [], 0
    for out in near_dedup._sign(2)(iter([batch])):
        digests += out.column("digest").to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(digests) == 2000 and digests[:20] == want
    assert peak < 32 << 20
