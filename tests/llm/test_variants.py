"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from telemetry_lake.llm import variants


def counted(rows) -> Counter:
    n: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return Counter({w: c for w, c in n.items() if c >= 3})


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(n: dict[str, int]) -> list[tuple]:
    form = {}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w] or "", root, n[w], len(near[w]), n[form[w]] if form[w] else 0))
    return sorted(out)


def got(df) -> list[tuple]:
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_words_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = got(variants.group(docs))
    assert found == expected(counted(rows))
    assert any(r[1] for r in found)


def test_odd_rows_doubled_letters_and_ties(spark):
    chance = random.Random(5)
    stems = ["aaaaa", "aaaaaa", "aaaabaa", "aabaa", "letter", "leter", "lettter", "lettes", "better", "bettér", "÷×÷×÷", "ÀÉÎÕÜ", "àéîõü"]
    words = list(stems)
    for w in stems * 6:
        i = chance.randrange(len(w))
        words += [w[:i] + w[i + 1 :], w[:i] + chance.choice("abéÿz") + w[i + 1 :], w[:i] + chance.choice("abéÿz") + w[i:]]
    rows = [(i, " ".join(chance.choices(words, k=300))) for i in range(12)]
    rows += [(50 + k, "chain " * 3 + "chains " * (6 if k else 5) + "chainss " * 14) for k in range(2)]
    rows += [(None, "Letter LETTER letter"), (None, None), (70, ""), (71, "1 2 3"), (71, "abĀcdefg abĀcdefg"), (72, "w" * 30_000), (72, ("x" * 40 + " ") * 5)]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert got(variants.group(docs)) == expected(counted(rows))
    assert variants.group(docs.limit(0)).count() == 0
    assert got(variants.group(docs.filter("text IS NULL OR text = ''"))) == []


def test_chains_of_forms(spark):
    """Each word is a variant of the next, which is twice as frequent."""
    n = {"a" * 5 + "b" * k: 3 * 2**k for k in range(13)}
    forms = {w: x for w, x in zip(n, list(n)[1:])}
    found = variants.roots(spark.createDataFrame(list(forms.items()), "word string, form string"), max(n.values()))
    assert {r["word"]: r["root"] for r in found.collect()} == {w: "a" * 5 + "b" * 12 for w in forms}


def test_gaps_count_each_word_once(spark):
    n = {w: 3 + k for k, w in enumerate(["baaaaad", "baaaad", "baaad", "baaaed", "aaaaa", "aaaaaa", "xaaaaa", "aaaaax"])}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    found = {r["word"]: (r["n_near"], r["near"]) for r in variants.neighbours(words).collect()}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        assert found.get(w, (0, None)) == (len(near), min(near, key=lambda x: (-n[x], x), default=None))
