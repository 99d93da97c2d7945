"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

Documents with the same set of shingles are one class from the start; classes, not copies, are
compared. Classes that agree on a band of their signatures share a bucket, and a bucket is never
expanded into pairs. First all its members are compared with one pivot, and links give labels. In a
bucket that still holds several labels most members have the same, the *main* one; members of one
label need no comparison, so only the *others* are left to compare, with the main ones and among
themselves. That is done inside a task, which holds the signatures and texts of a slice of others and a
slice of main ones and returns at most one link between any two labels. What is moved grows with the
members, not with their pairs, and a hot bucket is spread over slices.

A candidate pair is judged by its signatures batch by batch. After ``m`` of ``n`` agreements the
posterior chance of a similarity of at least the threshold follows from a uniform prior; below
:data:`MISS` the pair is dropped. Survivors are confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import Words, mix64, text_blocks
from .store import written

#: Similarity of a link, per cent.
THRESHOLD = 80
#: Words of a shingle, unless the caller names another width.
WIDTH = 2
HASHES, ROWS, BANDS = 128, 5, 25
#: Agreements are counted in batches of this size.
BATCH = 32
#: Chance of dropping a pair that is similar enough, at each batch.
MISS = 1e-6
#: Members of a bucket, and shingles of them, that make a slice.
SLICE_ROWS, SLICE_SHINGLES = 2048, 1 << 20
#: Bytes of text handled at once: a worker needs about 30 bytes for each, beside the JVM of its executor.
BLOCK = 1 << 17
#: Survivors confirmed at once, the most alike first.
CONFIRMED = 32

_random = np.random.default_rng(3)
_TIMES = _random.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_PLUS = _random.integers(0, 2**64, HASHES, dtype=np.uint64)
_BAND_SEEDS = _random.integers(0, 2**64, BANDS, dtype=np.uint64)


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of ``width`` words of each text, A-Z in lower case; of a
    shorter text the hash of all its words; empty without words."""
    words = Words(texts, lower=True)
    h = words.hashes()

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        out = parts[0]
        for part in parts[1:]:
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + part)
        return out

    runs = joined([h[k : len(h) - width + 1 + k] for k in range(width)]) if len(h) >= width else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(words.firsts[:-1], words.firsts[1:]):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        else:
            out.append(mix64(joined([h[k : k + 1] for k in range(a, b)]) ^ np.uint64(0xD1B54A32D192ED03)) if b > a else np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 512):
        hashed = shingles[at : at + 512, None] * _TIMES
        hashed += _PLUS
        np.minimum(low, (hashed.min(axis=0) >> np.uint64(32)).astype(np.uint32), out=low)
    return low


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in text_blocks(batches, block=BLOCK):
            sets = shingle_sets(texts, width)
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest_of(s) if f else None for s, f in zip(sets, full)], pa.binary()),
                    pa.array([signature(s).tobytes() if f else None for s, f in zip(sets, full)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES).astype(np.uint64)
        keys = np.empty((len(rows), BANDS), np.uint64)
        for b in range(BANDS):
            key = np.full(len(rows), _BAND_SEEDS[b])
            for k in range(ROWS):
                key = mix64(key ^ rows[:, b * ROWS + k])
            keys[:, b] = key
        v = np.repeat(np.array(batch.column("v")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(v)], names=["key", "v"])


def least_agreement(threshold: float = THRESHOLD / 100, miss: float = MISS) -> dict[int, int]:
    """For each number of hashes seen: the fewest agreements that keep a pair.

    With a uniform prior the posterior chance of a similarity of at least t after m of n agreements
    is the chance of at most m successes in n + 1 trials of chance t.
    """
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, 0
        while True:
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out[n] = m
    return out


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least = least_agreement()
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
        alive, seen = np.arange(len(a)), np.zeros(len(a), np.int64)
        for n, m in least.items():
            seen[alive] += (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(axis=1)
            alive = alive[seen[alive] >= m]
        yield batch.select(["a", "b"]).take(pa.array(alive))


def _verify(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, first in text_blocks(iter([batch]), "ta", BLOCK):
                second = [b"" if t is None else t for t in piece.column("tb").cast(pa.binary()).to_pylist()]
                kept = []
                for k, (x, y) in enumerate(zip(shingle_sets(first, width), shingle_sets(second, width))):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    kept.append(100 * both >= THRESHOLD * (len(x) + len(y) - both) and both > 0)
                yield piece.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of the documents named in ``ids``.

    Written first, the ids have a known size: where they are few Spark sends them to the texts, instead of
    moving all texts.
    """
    wanted = written(ids.distinct(), "near-wanted")
    return docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")


def links_among(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar enough, by signatures and then by their full sets."""
    c = classes.select("v", "n_shingles", "signature")
    x = c.select(F.col("v").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    y = c.select(F.col("v").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    sized = pairs.join(x, "a").join(y, "b").filter(100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))
    likely = written(sized.select("a", "b", "sa", "sb").mapInArrow(_prune, "a long, b long"), "near-likely")
    texts = texts_of(likely.select(F.explode(F.array("a", "b")).alias("doc_id")), docs)
    both = likely.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"
    )
    return written(both.select("a", "b", "ta", "tb").mapInArrow(_verify(width), "a long, b long").distinct(), "near-links")


def spread(both: DataFrame, labels: DataFrame | None) -> DataFrame:
    """One step towards components: ``v``, ``old``, ``label``.

    A vertex takes the smallest of its own label and its neighbours', and then that label's own.
    ``both`` has each link in both directions. A label is always a vertex of the same component.
    """
    if labels is None:
        first = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n"))
        labels = written(first.select("v", F.least("v", "n").alias("label")), "near-labels")
        step = labels.withColumn("old", F.lit(None).cast("bigint"))
    else:
        known = labels.select(F.col("v").alias("b"), "label")
        told = both.join(known, "b", "left").select(F.col("a").alias("v"), F.lit(None).cast("bigint").alias("old"), F.coalesce("label", "b").alias("label"))
        own = labels.select("v", F.col("label").alias("old"), "label")
        step = told.unionByName(own).groupBy("v").agg(F.max("old").alias("old"), F.min("label").alias("label"))
        step = step.withColumn("label", F.least("v", "label"))
    root = labels.select(F.col("v").alias("label"), F.col("label").alias("root"))
    return written(step.join(root, "label", "left").select("v", "old", F.coalesce("root", "label").alias("label")), "near-labels")


def in_both_directions(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``v``, ``label``: the smallest vertex reachable from each vertex of ``links`` (``a``, ``b``).

    ``labels`` come from :func:`spread` over some of the same links, and shorten the way.
    """
    both = in_both_directions(links)
    while True:
        step = spread(both, labels)
        labels = step.select("v", "label")
        if step.filter("NOT (old <=> label)").isEmpty():
            return labels


class _Side:
    """Members of a slice: ids, labels (as numbers of the block), signatures and shingle sets."""

    def __init__(self, at: list[int], v: list[int], labels: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray]):
        self.v = [v[i] for i in at]
        self.labels = labels[at]
        self.signatures = signatures[at]
        self.sets = [sets[i] for i in at]
        self.sizes = np.array([len(x) for x in self.sets], np.int64)

    def alike(self, signature: np.ndarray, size: int, at: np.ndarray, least: dict[int, int]) -> np.ndarray:
        """Those of the members ``at`` that may be similar enough, the most alike first."""
        fits = 100 * np.minimum(self.sizes[at], size) >= THRESHOLD * np.maximum(self.sizes[at], size)
        at = at[fits]
        seen = np.zeros(len(at), np.int64)
        for n, m in least.items():
            seen = seen + (self.signatures[at, n - BATCH : n] == signature[n - BATCH : n]).sum(axis=1)
            at, seen = at[seen >= m], seen[seen >= m]
        return at[np.argsort(-seen, kind="stable")]

    def similar(self, shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which of the members ``at`` are linked with a set, by the sets themselves."""
        sizes = self.sizes[at]
        joined = np.concatenate([self.sets[i] for i in at])
        place = np.minimum(np.searchsorted(shingles, joined), len(shingles) - 1)
        both = np.add.reduceat(shingles[place] == joined, np.concatenate([[0], np.cumsum(sizes)[:-1]]), dtype=np.int64)
        return 100 * both >= THRESHOLD * (sizes + len(shingles) - both)


def block_links(others: _Side, main: _Side, inner: bool) -> list[tuple[int, int]]:
    """Links that join all labels of a block that can be joined: of ``others`` with ``main`` and, if ``inner``,
    among themselves. A pair is left out only where its labels are joined already."""
    least, out = least_agreement(), []
    sides = [main, others] if inner else [main]
    for k in range(len(others.v)):
        for side in sides:
            at = np.flatnonzero(side.labels != others.labels[k])
            if side is others:
                at = at[at > k]
            at = side.alike(others.signatures[k], others.sizes[k], at, least)
            while len(at):
                now, at = at[:CONFIRMED], at[CONFIRMED:]
                for i in now[side.similar(others.sets[k], now)]:
                    mine, its = others.labels[k], side.labels[i]
                    if mine != its:
                        out.append((others.v[k], side.v[i]))
                        for x in (main, others):
                            x.labels[x.labels == its] = mine
                at = at[side.labels[at] != others.labels[k]]
    return out


def _settle(width: int):
    """The links of one block of a bucket: rows of the slices ``a`` (others) and ``b``."""

    def run(table: pa.Table) -> pa.Table:
        a, b, first = (table.column(c)[0].as_py() for c in ("a", "b", "first_main"))
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        sets, at = [], 0
        while at < len(texts):
            n, held = 0, 0
            while at + n < len(texts) and (not n or held + len(texts[at + n]) <= BLOCK):
                held += len(texts[at + n])
                n += 1
            sets += shingle_sets(texts[at : at + n], width)
            at += n
        # Of rows that share an id, those of this class.
        own = [i for i, d in enumerate(table.column("digest").to_pylist()) if digest_of(sets[i]) == d]
        place = table.column("at").to_pylist()
        v, labels = table.column("v").to_pylist(), np.unique(np.array(table.column("label")), return_inverse=True)[1]
        signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
        side = lambda s: _Side([i for i in own if place[i] == s], v, labels, signatures, sets)
        found = block_links(side(a), side(b), b == first)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def blocks_of(open_: DataFrame) -> DataFrame:
    """Where each member of an open bucket is compared: ``key``, ``a``, ``b`` (slices that meet), ``at`` (its own),
    ``first_main``, ``v``, ``label``, ``digest``.

    Slices of others come first, then those of the main label. ``open_`` has ``key``, ``v``, ``label``, ``digest``,
    ``n_shingles``. Each slice of others meets every other slice once, so a member is sent as often as
    there are slices of others (most often one), and an other once more for each slice of main ones.
    """
    of_label = open_.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("s"))
    largest = F.max(F.struct("m", "label", "s"))
    of_key = of_label.groupBy("key").agg(F.count(F.lit(1)).alias("labels"), F.sum("m").alias("m"), F.sum("s").alias("s"), largest.alias("main"))
    slices = lambda m, s: F.greatest(F.lit(1), F.ceil(m / SLICE_ROWS), F.ceil(s / SLICE_SHINGLES)).cast("int")
    of_key = of_key.filter("labels > 1").select(
        F.col("key").alias("k"), F.col("main.label").alias("main"),
        slices(F.col("m") - F.col("main.m"), F.col("s") - F.col("main.s")).alias("others"), slices(F.col("main.m"), F.col("main.s")).alias("mains"),
    )
    rows = open_.join(of_key, F.col("key") == F.col("k")).withColumn("is_main", F.col("label") == F.col("main"))
    hashed = F.xxhash64("digest", "v")
    rows = rows.withColumn("at", F.when(F.col("is_main"), F.col("others") + F.pmod(hashed, "mains")).otherwise(F.pmod(hashed, "others")).cast("int"))
    pair = lambda x, y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    of_others = F.sequence(F.lit(0), F.col("others") - 1)
    meets = F.when(F.col("is_main"), of_others).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("others") + F.col("mains") - 1), lambda x: x != F.col("at"))
    )
    met = rows.withColumn("meets", F.explode(F.transform(meets, lambda x: pair(F.col("at"), x))))
    return met.select("key", "meets.a", "meets.b", "at", F.col("others").alias("first_main"), "v", "label", "digest")


def link_classes(classes: DataFrame, docs: DataFrame, width: int = WIDTH) -> DataFrame | None:
    """``v``, ``label`` of the classes that are linked with others; None if there are none."""
    keys = classes.select("v", "signature").mapInArrow(_bands, "key long, v long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("pivot")).filter("m > 1")
    members = written(keys.join(shared.select("key", "m", "pivot"), "key"), "near-buckets")
    pairs = members.filter("v <> pivot").select(F.col("pivot").alias("a"), F.col("v").alias("b")).distinct()
    links = links_among(pairs, classes, docs, width)
    labels = None if links.isEmpty() else components(links)
    # Buckets of which more than the pivot is left to compare.
    left = members.filter("m > 2 AND v <> pivot").select("key", "v")
    if labels is not None:
        left = left.join(labels, "v", "left")
    label = F.col("v") if labels is None else F.coalesce("label", "v")
    of_class = classes.select("v", "digest", "n_shingles")
    met = written(blocks_of(left.withColumn("label", label).join(of_class, "v")), "near-blocks")
    texts = texts_of(met.select(F.col("v").alias("doc_id")), docs).withColumnRenamed("doc_id", "v")
    held = met.join(classes.select("digest", "signature"), "digest").join(texts, "v")
    more = held.groupBy("key", "a", "b").applyInArrow(_settle(width), "a long, b long")
    more = written(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-links")
    if more.isEmpty():
        return labels
    return components(links.unionByName(more), labels)


def group(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Components of near-duplicate documents, by shingles of ``width`` words.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``
    (whether that is its own) per row. Null and blank texts have no shingles and are linked with
    nothing. Rows without an id are linked with nothing either: ``component_id`` null, ``kept`` true.
    Rows that repeat an id are one document with the links of all of them. Further columns are
    ignored; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    signed = written(docs.mapInArrow(_sign(width), "doc_id long, n_shingles long, digest binary, signature binary"), "near-signed")
    linked = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = linked.groupBy("digest").agg(F.min("doc_id").alias("v"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = written(classes, "near-classes")
    labels = link_classes(classes, docs, width)
    of_class = classes.select("digest", "v")
    if labels is None:
        of_class = of_class.select("digest", F.col("v").alias("component"))
    else:
        of_class = of_class.join(labels, "v", "left").select("digest", F.coalesce("label", "v").alias("component"))
    # A class without others is its own component; repeated ids may hold several classes.
    rows = signed.drop("signature").join(of_class, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumns(
        {
            "component_id": F.when(F.col("doc_id").isNotNull(), F.col("component_id")),
            "kept": F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)),
        }
    )


def representatives(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, all columns."""
    dropped = group(docs, width).filter("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
