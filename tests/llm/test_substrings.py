"""Repeated passages against all windows."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from telemetry_lake.llm import substrings

from . import brute


def expected(rows):
    """By id order; ids are unique or rows equal."""
    first, out = {}, []
    for i, t in sorted({(2**63 - 1 if i is None else i, t) for i, t in rows}, key=lambda x: x[0]):
        w = brute.words(t)
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (i, s))
    for i, t in rows:
        w = brute.words(t)
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (2**63 - 1 if i is None else i, s):
                gone.update(range(s, s + 20))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def test_equal_windows_have_equal_symbols():
    rng = random.Random(1)
    passage = " ".join(rng.choice("a b c d e f".split()) for _ in range(400))
    texts = [f"{' '.join(str(rng.random()) for _ in range(k))} {passage} x{k}".encode() for k in range(12)] + [b"la " * 300]
    w = substrings.Windows(texts)
    by: dict = {}
    for h, s in zip(w.w1.tolist(), w.symbol.tolist()):
        by.setdefault(h, set()).add(s)
    assert all(len(s) == 1 for s in by.values())
    assert len(set(w.symbol[w.doc == 0].tolist())) > 30


def test_matches_all_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = expected(rows)
    assert got(substrings.dedup(docs)) == want
    # The same with the texts spread over tasks, so that repeats have to be found across them.
    assert got(substrings.dedup(docs.repartition(40, "doc_id"))) == want
    assert sum(r[2] for r in want) > 1000


def test_odd_rows(spark):
    rng = random.Random(2)
    w = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    p, q = w(25), w(60)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "la " * 5000), (5, "la " * 19), (6, f"{w(9)} {p}\n{w(30)}"), (7, f"{p} {w(5)}"), (7, f"{p} {w(5)}")]
    rows[-1] = rows[-2]
    rows += [(8, f"{q} {q} {w(3)} {q}"), (None, f"x {q}"), (9, "la lo " * 100), (10, "ti " * 19 + w(1)), (0, f"{w(4)}  {q[:200]}")]
    rows += [(100 + k, f"{w(rng.randrange(30))} {p} {w(rng.randrange(30))} {q} {w(2)}") for k in range(60)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int").repartition(7)
    assert got(substrings.dedup(docs)) == expected(rows)
    assert substrings.dedup(docs.limit(0)).count() == 0
    cut = substrings.without_repeats(docs)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[6] == rows[5][1]
    assert texts[7] == rows[6][1][len(p) + 1 :]
    assert 5 in texts and 1 not in texts and 3 not in texts


def test_tables_and_partitions_without_words(spark):
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.dedup(blank).collect()) == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]
    assert substrings.without_repeats(blank).count() == 0
    passage = " ".join(f"w{i}" for i in range(30))
    good = spark.createDataFrame([(4, passage), (5, passage + " more")], "doc_id long, text string")
    both = blank.coalesce(1).union(good.coalesce(1))
    assert sorted((r["doc_id"], r["n_removed"]) for r in substrings.dedup(both).collect()) == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 30)]
    assert [(r["doc_id"], r["text"]) for r in substrings.without_repeats(both).orderBy("doc_id").collect()] == [(4, passage), (5, "more")]


def test_workers_hold_little_beside_the_texts():
    """A worker's own arrays stay small however many texts a batch has; so do the batches it returns."""
    words = [f"w{k}" for k in range(100_000)]
    rng = random.Random(5)
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(1000)]
    texts[700] = " ".join(texts[3].split()[:25]) + " and more"
    texts[701] = "too short"
    texts[999] = texts[998]
    ids = pa.array(range(1000), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["o", "r", "text"])
    seen = np.unique(substrings.Windows([t.encode() for t in texts[:10]]).symbol).view(np.int64)
    listed = batch.append_column("symbols", pa.array([seen] * 1000, pa.list_(pa.int64())))
    whole = [[599 - 19]] + [None] * 999
    ranged = pa.RecordBatch.from_arrays(
        [pa.StructArray.from_arrays([ids], ["doc_id"]), pa.array(texts), pa.array(whole, pa.list_(pa.int64()))], names=["row", "text", "ranges"]
    )

    def traced(step, rows):
        tracemalloc.start()
        out = list(step(iter([rows])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, peak

    local, peak = traced(substrings._local, batch)
    assert peak < 64 << 20
    rows = [r for b in local for r in b.to_pylist()]
    assert sorted((r["o"], r["lo"], r["hi"]) for r in rows if r["symbol"] is None) == [(700, 0, 5), (999, 0, 580)]
    # A text none of whose windows are first has no symbols; nor has one without windows.
    assert {r["r"] for r in rows if r["symbol"] is not None} == set(range(999)) - {701}
    found, peak = traced(substrings._candidates, listed)
    assert peak < 64 << 20
    assert {r for b in found for r in b.column("r").to_pylist()} >= set(range(10))
    cut, peak = traced(substrings._cut, ranged)
    assert max(b.nbytes for b in cut) < 1 << 20 and peak < 64 << 20
    left = [t for b in cut for t in b.column("text").to_pylist()]
    assert left[0] == "" and left[1:] == texts[1:]
