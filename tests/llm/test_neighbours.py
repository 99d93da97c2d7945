"""Approximate nearest neighbours against all distances."""

from __future__ import annotations

import numpy as np

from telemetry_lake.llm import neighbours


def expected(rows, every=100, k=10):
    rows = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in rows:
        if q % every == 0:
            near = {(float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v)}
            out[q] = sorted(near)[:k]
    return out


def recall(df, want):
    got: dict = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q, near in want.items():
        rows = sorted(got.get(q, []))
        assert [r[0] for r in rows] == list(range(1, len(near) + 1))
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
        exact = dict((i, d) for d, i in near)
        assert all(abs(s - exact[i]) < 1e-9 for _, i, s in rows if i in exact)
        hits += len({i for _, i, _ in rows} & set(exact))
        total += len(near)
    assert set(got) == {q for q, near in want.items() if near}
    return hits / max(total, 1)


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    assert recall(neighbours.search(table), expected(rows)) >= 0.95


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 120)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(200, 260)]  # copies
    rows += [(300, None), (400, []), (500, [0.0] * 4), (600, [1.0, None, 1.0, 1.0]), (700, [float("nan")] * 4), (800, [float("inf")] + [1.0] * 3), (None, [1.0] * 4)]
    rows += [(900, [1.0, 2.0]), (901, [1.0, 3.0]), (1000, [5.0] * 3), (100, rows[99][1]), (200, rows[119 + 0][1])]
    table = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert recall(neighbours.search(table), expected(rows)) >= 0.95
    assert neighbours.search(table.limit(0)).count() == 0
