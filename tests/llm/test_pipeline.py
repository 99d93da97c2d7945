"""The whole pipeline, each stage against a plain version of it on the stage's own input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from telemetry_lake.llm import packing, quality

from . import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def small_folder(spark, path):
    """Documents with noise that labels name, near copies, repeated passages and odd rows; few in some sources."""
    rng = random.Random(4)
    some = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))
    passage, base = some(30), some(200).split()
    rows = [(i, some(rng.randint(30, 120)), "abc"[i % 3 if i % 20 else 0]) for i in range(120)]
    rows += [(200 + i, " ".join(f"{w}!!" for w in some(rng.randint(30, 60)).split()), "b") for i in range(60)]
    rows += [(300 + i, f"{some(25)} {passage} {some(25)}", "d") for i in range(5)]
    for k, edits in enumerate((0, 1, 8, 0)):
        w = list(base)
        for e in range(edits):
            w[12 + 25 * e] = f"x{k}{e}"
        rows.append((400 + k, " ".join(w), "c"))
    rows += [(500, None, "a"), (501, "", "b"), (502, "too few words", "b"), (503, passage + " " + passage, None), (None, some(40), "a"), (600, some(6_000), "d")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if 200 <= i < 300 else 1, 0) for i, _, _ in rows if i is not None and i < 300]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def key(r):
    return str(r["doc_id"]), r["text"] or ""


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def good(rows, rules):
    out = []
    for r in rows:
        s, w = brute.statistics(r["text"]), brute.words(r["text"])
        s |= {
            "n_lines": len([x for x in (r["text"] or "").split("\n") if brute.words(x)]), "n_upper": len(re.findall("[A-Z]", r["text"] or "")),
            "n_exclaim": (r["text"] or "").count("!"), "n_distinct": len(set(w)),
        }
        s |= {k: s[a] / s[b] if s[b] else 0.0 for k, (a, b) in quality.SHARES.items()}
        hit = any(all(s[t.statistic] > t.cut if t.above else s[t.statistic] <= t.cut for t in rule) for rule in rules)
        if not s["base_failed"] and not hit:
            out.append(r)
    return out


def without_near_copies(rows):
    def shingles(text):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = brute.words(w)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    sets = [(r["doc_id"], shingles(r["text"])) for r in rows if r["doc_id"] is not None]
    label = {i: i for i, _ in sets}
    for _ in range(len(sets)):
        before = dict(label)
        for i, x in sets:
            for j, y in sets:
                if i < j and x and y and 10 * len(x & y) >= 8 * len(x | y):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return [r for r in rows if r["doc_id"] is None or label[r["doc_id"]] == r["doc_id"]]


def kept_words(rows):
    first, out = {}, Counter()
    place = lambda r: 2**63 if r["doc_id"] is None else r["doc_id"]
    for r in sorted(rows, key=place):
        w = brute.words(r["text"])
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (place(r), s))
    for r in rows:
        w = brute.words(r["text"])
        gone = {s + k for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] < (place(r), s) for k in range(20)}
        kept = tuple(x for k, x in enumerate(w) if k not in gone)
        if kept:
            out[str(r["doc_id"]), kept, r["lang"], r["source"]] += 1
    return out


def mixed(rows, weights=(1, 2, 3), epochs=3, seed="mix-1"):
    """Every row as often as water-filling and the seeded sample take it."""
    by: dict = {}
    for r in rows:
        n = len(brute.words(r["text"]))
        digest = hashlib.md5(f"{seed}:{'null' if r['doc_id'] is None else r['doc_id']}:{n}".encode()).hexdigest()
        by.setdefault(r["source"], []).append((digest, n, r))
    order = sorted(s for s in by if s is not None) + [s for s in by if s is None]
    size = {s: sum(n for _, n, _ in by[s]) for s in order}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        level = (total - sum(epochs * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if epochs * size[s] <= weight[s] * level}
        if more == full:
            break
        full = more
    out = []
    for s in order:
        target = min(epochs * size[s], weight[s] * level)
        whole = int(target // size[s])
        rest, got, chosen = target - whole * size[s], 0, set()
        for digest, n, _ in sorted(by[s], key=lambda x: x[0]):
            if got + n > rest:
                break
            chosen.add(digest)
            got += n
        for k in range(4):
            left = [(abs(rest - got - n), n, d) for d, n, _ in by[s] if d not in chosen and n <= (rest - got) * (2 if k == 3 else 1)]
            if left:
                chosen.add(min(left)[2])
                got += min(left)[1]
        for digest, _, r in by[s]:
            out += [r] * (whole + (digest in chosen))
    return out


def check_packed(rows, pieces):
    plain = Tokenizer.from_file(packing.default_tokenizer())
    want = []
    for r in rows:
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(r["doc_id"]), k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    same([(str(p["doc_id"]), p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces], want)
    places: dict = {}
    for p in pieces:
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 4096


def test_all_stages(spark, tmp_path, monkeypatch):
    small_folder(spark, str(tmp_path))
    inputs, stages = {}, corpus_pipeline.STAGES

    def watched(name, stage):
        def run(spark, docs, sf_dir):
            inputs[name] = (docs.columns, docs.collect())
            return stage(spark, docs, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, watched(name, stage)) for name, stage in stages])
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert [name for name, _ in stages] == list(inputs)
    assert all(columns == COLUMNS for columns, _ in inputs.values())
    assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    raw, kept, single, cut, mix = (rows for _, rows in inputs.values())

    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.fit(docs, labels)
    same(kept, good(raw, rules))
    assert rules and len(raw) - len(kept) > 50
    same(single, without_near_copies(kept))
    assert {400, 402} <= {r["doc_id"] for r in single} and not {401, 403} & {r["doc_id"] for r in single}
    assert Counter((str(r["doc_id"]), tuple(brute.words(r["text"])), r["lang"], r["source"]) for r in cut) == kept_words(single)
    assert all(r["n_chars"] == len(r["text"]) for r in cut) and sum(r["n_chars"] for r in cut) < sum(r["n_chars"] for r in single)
    same(mix, mixed(cut))
    assert len(mix) > len({key(r) for r in mix})
    check_packed(mix, result.collect())


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the operators' own pass through each stage."""
    names = ["r", "o", "ranges", "row", "__w", "__stats", "__plan", "__key", "__size", "__copy", "size", "key", "a", "x.y"]
    words = [" ".join(f"w{i}x{k}" for i in range(40 + k)) for k in range(12)]
    rows = [(k, t, "en", "s", len(t), *[f"{n}{k}" for n in names]) for k, t in enumerate(words)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    kept = quality.kept_documents(docs, [])
    for stage in (lambda d: quality.kept_documents(d, []), corpus_pipeline.one_of_each, corpus_pipeline.cut_repeats, corpus_pipeline.mix_sources):
        kept = stage(spark, docs, "") if stage.__module__ == corpus_pipeline.__name__ else stage(docs)
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.collect()} == set(rows)
    places = packing.pack(docs, packing.default_tokenizer())
    assert places.select("doc_id").distinct().count() == len(rows)
