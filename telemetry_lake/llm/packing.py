"""Packing tokenized documents into sequences: a configuration linear program, rounded.

Tasks cut each document into pieces of at most ``CAPACITY`` tokens. How many pieces there are of
each length is a histogram of at most ``CAPACITY`` numbers, however large the corpus; on it the driver
solves the configuration linear program (which combinations of lengths to use how often, so that every
piece is covered). Multiplicative weights give each length a price; the best combination for these
prices is a knapsack, solved by dynamic programming over the capacity; prices of the lengths it
contains then fall. The averaged solution is rounded down to whole sequences, and best fit on the
histogram places what is left. The result says which ranks of each length go where; every piece finds
its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from .store import written

CAPACITY = 4096
END_OF_TEXT = 1
#: Rounds of multiplicative weights, and how strongly a round moves a price.
ROUNDS, RATE, LONG = 120, 0.5, 2.0
#: Words whose ids a task remembers.
CACHED_WORDS = 1_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


class WordTokenizer:
    """Ids of whole texts, word by word.

    The tokenizer's own rules never look across white space, so a text's ids are those of its words
    in a row. Words recur, so most of them come from a bounded memory; the others are given to the
    tokenizer together, with a word between them that none of them contains.
    """

    MARK = "\x01"
    CHUNK = 200

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        (self.mark,) = self._ids(self.MARK)
        self.marks = {ord(c): np.array(self._ids(c), "<u4").tobytes() for c in ".,"}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        out = []
        for at in range(0, len(words), self.CHUNK):
            some = [w.decode() for w in words[at : at + self.CHUNK]]
            if any(self.MARK in w for w in some):
                out += [np.array(self._ids(w), "<u4").tobytes() for w in some]
                continue
            ids = np.array(self._ids(f" {self.MARK} ".join(some)), "<u4")
            edges = [0, *np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            raw = ids.tobytes()
            out += [raw[4 * a + 4 * (k > 0) : 4 * b] for k, (a, b) in enumerate(zip(edges, edges[1:]))]
        return out

    def _new_words(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of unknown words. A full stop or comma after a letter is a token of its own."""
        stems = {w: w[:-1] if w[-1] in b".," and w[-2:-1].isalpha() else w for w in words}
        wanted = list(set(stems.values()).difference(self.known))
        found = dict(zip(wanted, self._encode_words(wanted)))
        for w, stem in stems.items():
            if stem is not w:
                found[w] = (found[stem] if stem in found else self.known[stem]) + self.marks[w[-1]]
        return found

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if b"<|" not in text:  # else lower case might make a special token of ordinary text
            text = text.lower()
        words, known = text.split(), self.known
        new = set(words).difference(known)
        if new:
            fresh = self._new_words(new)
            if len(known) + len(fresh) > CACHED_WORDS:
                return b"".join([known[w] if w in known else fresh[w] for w in words])
            known.update(fresh)
        return b"".join(map(known.__getitem__, words))


#: One per worker process and vocabulary, as a worker runs many tasks.
_TOKENIZERS: dict[str, WordTokenizer] = {}


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, WordTokenizer(path))
        part, seen = TaskContext.get().partitionId(), Counter()
        end = np.array([END_OF_TEXT], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                ids = tokenizer.encode(text.as_py() or b"") + end
                for k, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    piece = ids[at : at + 4 * CAPACITY]
                    n = len(piece) // 4
                    out.append((doc_id, k, at // 4, n, zlib.crc32(piece), part, seen[n]))
                    seen[n] += 1
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def knapsack(price: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Lengths (with their numbers, at most ``most``) of the highest total price that fit.

    ``price[i]`` is the price of length ``i + 1``. Dynamic programming over the room used; a length
    that the program would take more often than it exists is cut back afterwards.
    """
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero((most > 0) & (price > 0)) + 1
    if not len(lengths):
        return {}
    value = price[lengths - 1]
    for c in range(int(lengths[0]), capacity + 1):
        k = int(np.searchsorted(lengths, c, side="right"))
        total = best[c - lengths[:k]] + value[:k]
        i = int(np.argmax(total))
        if total[i] > best[c - 1]:
            best[c], last[c] = total[i], lengths[i]
        else:
            best[c] = best[c - 1]
    chosen: Counter = Counter()
    c = capacity
    while c > 0:
        if last[c]:
            chosen[int(last[c])] += 1
            c -= int(last[c])
        else:
            c -= 1
    return {n: int(min(k, most[n - 1])) for n, k in chosen.items()}


def best_fit_row(left: np.ndarray, row: dict[int, int], capacity: int) -> dict[int, int]:
    """Fill a sequence from what is left: always the longest piece that still fits."""
    room = capacity - sum(n * k for n, k in row.items())
    row = dict(row)
    have = np.flatnonzero(left > 0) + 1
    while room > 0 and len(have):
        k = int(np.searchsorted(have, room, side="right"))
        if not k:
            break
        n = int(have[k - 1])
        free = int(left[n - 1]) - row.get(n, 0)
        if free <= 0:
            have = np.delete(have, k - 1)
            continue
        take = min(free, room // n)
        row[n] = row.get(n, 0) + take
        room -= take * n
    return row


def configurations(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """``(times, {length: number})`` that use up the histogram exactly; times add up to the sequences."""
    left = histogram.astype(np.int64).copy()
    used: list[tuple[int, dict[int, int]]] = []
    if left[capacity - 1]:
        used.append((int(left[capacity - 1]), {capacity: 1}))
        left[capacity - 1] = 0
    demand = left.astype(float)
    if demand.sum():
        # Prices start at a piece's share of a sequence. They follow how far each length's demand
        # is from being covered by the combinations chosen so far.
        lengths = np.arange(1, capacity + 1)
        bound = max(1.0, float(lengths @ demand) / capacity)
        covered, chosen = np.zeros(capacity), []
        # Slightly dearer by the token for long pieces, which fit into fewer combinations.
        share = lengths / capacity * (1 + LONG * lengths / capacity)
        price = np.where(demand > 0, share, 0.0)
        for _ in range(ROUNDS):
            row = knapsack(price, left, capacity)
            if not row:
                break
            each = np.array([demand[n - 1] / k for n, k in row.items()])
            step = min(bound / ROUNDS * 2, float(each.min()))
            chosen.append((step, row))
            for n, k in row.items():
                covered[n - 1] += step * k
            with np.errstate(divide="ignore", invalid="ignore"):
                done = np.where(demand > 0, covered / demand, 1.0)
            price = np.where((demand > 0) & (done < 1), share * np.exp(-RATE * done), 0.0)
        for step, row in chosen:
            times = min([int(step), *(int(left[n - 1]) // k for n, k in row.items())])
            if times > 0 and sum(n * k for n, k in row.items()) >= 0.98 * capacity:
                used.append((times, row))
                for n, k in row.items():
                    left[n - 1] -= times * k
    # Best fit for the rest: each row is used as often as what is left allows.
    while left.any():
        row = best_fit_row(left, {int(np.flatnonzero(left)[-1]) + 1: 1}, capacity)
        times = min(int(left[n - 1]) // k for n, k in row.items())
        used.append((times, row))
        for n, k in row.items():
            left[n - 1] -= times * k
    return used


def placements(used: list[tuple[int, dict[int, int]]]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """For each length its blocks ``(first rank, number in a sequence, first sequence, offset)``."""
    blocks: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for times, row in used:
        offset = 0
        for n in sorted(row, reverse=True):
            blocks.setdefault(n, []).append((ranks[n], row[n], sequence, offset))
            ranks[n] += times * row[n]
            offset += n * row[n]
        sequence += times
    return sorted(blocks.items())


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most :data:`CAPACITY` tokens.

    A document is its ids and one :data:`END_OF_TEXT`; null texts count as empty and give one token.
    Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.
    Repeated rows and rows without an id are packed like any other; further columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = written(docs.select("doc_id", "text").mapInArrow(_cut(tokenizer), PIECES), "packing-pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # A row for each task and length; at most one row per task meets in a group of the window.
    before = Window.partitionBy("length").orderBy("part")
    counts = written(counts.withColumn("base", F.sum("n").over(before) - F.col("n")), "packing-counts")
    histogram = np.zeros(CAPACITY, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most CAPACITY rows
        histogram[r["length"] - 1] = r["n"]
    blocks = [
        (n, [dict(zip(("first", "number", "sequence", "offset"), b)) for b in rows]) for n, rows in placements(configurations(histogram))
    ]
    kind = "length long, blocks array<struct<first:long,number:long,sequence:long,offset:long>>"
    bases = counts.join(F.broadcast(spark.createDataFrame(blocks, kind)), "length").select("part", "length", "base", "blocks")
    # Blocks of one length are ordered by their first rank: those at or before the piece's rank lead to its own.
    placed = pieces.join(bases.select("part", "length", "base"), ["part", "length"])
    placed = placed.join(F.broadcast(spark.createDataFrame(blocks, kind)), "length").withColumn("r", F.col("rank") + F.col("base"))
    mine = F.element_at(F.filter("blocks", lambda b: b["first"] <= F.col("r")), -1)
    at = F.col("r") - F.col("b.first")
    return placed.withColumn("b", mine).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("b.sequence") + F.floor(at / F.col("b.number"))).alias("sequence_id"),
        (F.col("b.offset") + at % F.col("b.number") * F.col("length")).alias("offset"),
    )


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")
