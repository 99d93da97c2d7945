"""Repeated passages, found by recompression.

A text is a sequence of words, named by hashes of their bytes. Each round names runs of equal symbols
and then pairs of neighbours, of which one is on the left and the other on the right side by a bit of
their names. A symbol's new name depends on its own content and a few neighbours only, and the round
keeps track of how far it looked; so two copies of a passage have the same symbols but for some at
their ends. As names are 64-bit hashes of what they stand for, they are the same in all tasks, and no
round has to gather symbols to number them.

Of the symbols whose whole range of sight lies within a window of :data:`WINDOW` words, the highest
and then smallest stands for the window, so equal windows have equal symbols. Only symbols that occur
in several places lead on to the windows themselves, which are compared by 96-bit hashes. What
repeats within a task is settled there and does not travel: a passage with very many copies arrives
in the shuffles once for each block of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .arrays import Words, mix64, powers, text_blocks
from .store import written

#: Words of a window.
WINDOW = 20
ROUNDS = 2
#: Bytes of text whose windows one task compares at once.
LOCAL_BYTES = 12 << 20
#: Bytes of text whose words are named at once: a worker needs about 70 bytes for each, beside the JVM of its executor.
BLOCK = 1 << 18
FAR = 1 << 40
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_P_BACK, _Q_BACK = pow(_P, -1, 2**64), pow(_Q, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``powers(base, n)``, kept for the next block unless a text is longer than one."""
    if n > BLOCK:
        return powers(base, n)
    if base not in _POWERS:
        _POWERS[base] = powers(base, BLOCK)
    return _POWERS[base][:n]


def _sums(h: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(base, len(h)), dtype=np.uint64, out=out[1:])
    return out


class Symbols:
    """Symbols of one level: ``name``; words ``s`` to ``e``; seen words ``ds`` to ``de``; ``doc``."""

    def __init__(self, name, s, e, ds, de, doc):
        self.name, self.s, self.e, self.ds, self.de, self.doc = name, s, e, ds, de, doc

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """How far the sight of each symbol's left and right neighbour reaches; without one, far."""
        left, right = np.full(len(self.s), -FAR), np.full(len(self.s), FAR)
        same = self.doc[1:] == self.doc[:-1]
        left[1:] = np.where(same, self.ds[:-1], -FAR)
        right[:-1] = np.where(same, self.de[1:], FAR)
        return left, right

    def runs(self, seed: int) -> "Symbols":
        """Runs of equal symbols become one. Whether a symbol is in a run depends on both neighbours."""
        if not len(self.s):
            return self
        left, right = self._neighbours()
        first = np.ones(len(self.s), bool)
        first[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        at = np.flatnonzero(first)
        last = np.append(at[1:], len(self.s)) - 1
        n = last - at + 1
        name = np.where(n > 1, mix64(self.name[at] * np.uint64(_Q) + n.astype(np.uint64) + np.uint64(seed)), self.name[at])
        return Symbols(name, self.s[at], self.e[last], np.minimum(left[at], self.ds[at]), np.maximum(right[last], self.de[last]), self.doc[at])

    def pairs(self, seed: int) -> "Symbols":
        """A symbol of the left side and a following one of the right side become one."""
        if not len(self.s):
            return self
        left, right = self._neighbours()
        is_right = (mix64(self.name ^ np.uint64(seed)) & np.uint64(1)).astype(bool)
        joined = np.zeros(len(self.s), bool)  # with the next one
        joined[:-1] = ~is_right[:-1] & is_right[1:] & (self.doc[1:] == self.doc[:-1])
        second = np.zeros(len(self.s), bool)
        second[1:] = joined[:-1]
        at = np.flatnonzero(~second)
        end = at + joined[at]
        # A symbol that stays alone has looked at the one neighbour it could have joined.
        alone = ~joined[at]
        ds = np.where(alone & is_right[at], np.minimum(left[at], self.ds[at]), self.ds[at])
        de = np.where(alone & ~is_right[at], np.maximum(right[at], self.de[at]), self.de[end])
        name = np.where(alone, self.name[at], mix64(self.name[at] * np.uint64(_P) + mix64(self.name[end] + np.uint64(seed))))
        return Symbols(name, self.s[at], self.e[end], np.minimum(ds, self.ds[at]), np.maximum(de, self.de[end]), self.doc[at])


class Windows:
    """All windows of some texts: ``doc``, ``start`` (word in the text), ``symbol``, ``w1``, ``w2``."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts)
        h, n = words.hashes(), len(words)
        one, two = _sums(h, _P), _sums(mix64(h ^ np.uint64(_Q)), _Q)
        down, down2 = _powers(_P_BACK, n + 1), _powers(_Q_BACK, n + 1)
        ends = words.firsts[1:][words.docs] if n else np.zeros(0, np.int64)
        firsts = words.firsts[:-1][words.docs] if n else np.zeros(0, np.int64)
        best = np.full(n, NONE)
        level = Symbols(h, np.arange(n), np.arange(n) + 1, np.arange(n), np.arange(n) + 1, words.docs)
        self._cover(best, level, 0, one, down, firsts, ends)
        for k in range(ROUNDS):
            level = level.runs(2 * k + 1).pairs(2 * k + 2)
            self._cover(best, level, k + 1, one, down, firsts, ends)
        at = np.flatnonzero(np.arange(n) + WINDOW <= ends)
        self.doc, self.start, self.symbol = words.docs[at], at - firsts[at], best[at]
        self.w1 = mix64((one[at + WINDOW] - one[at]) * down[at])
        self.w2 = (mix64((two[at + WINDOW] - two[at]) * down2[at]) >> np.uint64(32)).astype(np.uint32)

    @staticmethod
    def _cover(best, level, number, sums, down, firsts, ends) -> None:
        """Offer the symbols of a level to all windows that hold what they have seen; the smallest wins.

        A symbol is told from others by its level and the words it has seen. Its windows are a range,
        covered by two ranges of a power of two; halving these in turn reaches single windows.
        """
        ok = np.flatnonzero((level.ds >= 0) & (level.de - level.ds <= WINDOW))
        ds, de = level.ds[ok], level.de[ok]
        seen = mix64((sums[de] - sums[ds]) * down[ds] + mix64((level.s[ok] - ds + WINDOW * (de - ds)).astype(np.uint64)))
        key = (seen >> np.uint64(2)) | np.uint64(ROUNDS - number << 62)
        lo = np.maximum(de - WINDOW, firsts[ds])
        hi = np.minimum(ds, ends[ds] - WINDOW)
        fits = lo <= hi
        lo, hi, key = lo[fits], hi[fits], key[fits]
        power = np.frexp(hi - lo + 1)[1] - 1
        top = int(power.max(initial=0))
        wide = [best, *[np.full(len(best), NONE) for _ in range(top)]]
        for k in range(top + 1):
            of = power == k
            np.minimum.at(wide[k], lo[of], key[of])
            np.minimum.at(wide[k], hi[of] - (1 << k) + 1, key[of])
        for k in range(top, 0, -1):
            half = 1 << k - 1
            np.minimum(wide[k - 1], wide[k], out=wide[k - 1])
            np.minimum(wide[k - 1][half:], wide[k][:-half], out=wide[k - 1][half:])


def _later(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """Which windows have an equal one before them. They are sorted in eight parts by their hashes."""
    later = np.zeros(len(w1), bool)
    part = (w1 >> np.uint64(61)).astype(np.uint8)
    for k in range(8):
        at = np.flatnonzero(part == k)
        at = at[np.argsort(w1[at], kind="stable")]
        x, y = w1[at], w2[at]
        later[at[1:][(x[1:] == x[:-1]) & (y[1:] == y[:-1])]] = True
    return later


def _ranges(chosen: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen windows as ranges of consecutive ones: text, first, last. ``firsts`` has each text's first window."""
    new = np.zeros(len(chosen) + 1, bool)
    new[firsts] = True
    begins, ends = chosen.copy(), chosen.copy()
    begins[1:] &= ~chosen[:-1] | new[1:-1]
    ends[:-1] &= ~chosen[1:] | new[1:-1]
    lo, hi = np.flatnonzero(begins), np.flatnonzero(ends)
    d = np.searchsorted(firsts, lo, side="right") - 1
    return d, lo - firsts[d], hi - firsts[d]


LOCAL = "symbol long, once int, r long, o long, lo int, hi int"


def _settle(held: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Symbols of windows that are first among ``held`` texts, and ranges of those that are not."""
    held = sorted({(o, r): t for o, r, t in held}.items())
    one, two, runs, at, total = [], [], [], 0, 0
    firsts = np.zeros(len(held), np.int64)
    while at < len(held):
        n, size = at, 0
        while n < len(held) and (n == at or size + len(held[n][1]) <= BLOCK):
            size += len(held[n][1])
            n += 1
        w = Windows([t for _, t in held[at:n]])
        one.append(w.w1)
        two.append(w.w2)
        firsts[at:n] = total + np.searchsorted(w.doc, np.arange(n - at))
        # Neighbours mostly have the same symbol: it is held once for them.
        new = np.ones(len(w.doc), bool)
        new[1:] = (w.doc[1:] != w.doc[:-1]) | (w.symbol[1:] != w.symbol[:-1])
        runs.append((np.flatnonzero(new) + total, (w.doc[new] + at).astype(np.int32), w.symbol[new]))
        total += len(w.doc)
        at = n
    if not total:
        return
    later = _later(np.concatenate(one), np.concatenate(two))
    one.clear()
    two.clear()
    o, r = (np.array([key[k] for key, _ in held], np.int64) for k in (0, 1))
    d, lo, hi = _ranges(later, firsts)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(d), pa.int64()), pa.nulls(len(d), pa.int32()), pa.array(r[d]), pa.array(o[d]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
        names=["symbol", "once", "r", "o", "lo", "hi"],
    )
    # Each symbol once for each text, if one of its windows there is first.
    begins, d, s = (np.concatenate(c) for c in zip(*runs))
    runs.clear()
    first = ~np.logical_and.reduceat(later, begins)
    d, s = d[first], s[first]
    by = np.lexsort((d, s))
    d, s = d[by], s[by]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    d, s = d[new], s[new]
    # It counts once for all texts: what they share was settled above.
    once = np.ones(len(d), np.int32)
    once[1:] = s[1:] != s[:-1]
    none = pa.nulls(len(d), pa.int32())
    yield pa.RecordBatch.from_arrays(
        [pa.array(s.view(np.int64)), pa.array(once), pa.array(r[d]), pa.nulls(len(d), pa.int64()), none, none],
        names=["symbol", "once", "r", "o", "lo", "hi"],
    )


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for piece, texts in text_blocks(batches):
        held += zip(piece.column("o").to_pylist(), piece.column("r").to_pylist(), texts)
        size += sum(map(len, texts))
        if size >= LOCAL_BYTES:
            yield from _settle(held)
            held, size = [], 0
    yield from _settle(held)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows under the symbols listed with each text."""
    for piece, texts in text_blocks(batches, block=BLOCK):
        w = Windows(texts)
        lists = piece.column("symbols")
        keep = np.zeros(len(w.doc), bool)
        edges = np.searchsorted(w.doc, np.arange(len(texts) + 1))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            keep[a:b] = np.isin(w.symbol[a:b], np.array(lists[k].values).view(np.uint64))
        # What repeats within one text was settled with it.
        by = np.flatnonzero(keep)
        by = by[np.lexsort((w.w2[by], w.w1[by], w.doc[by]))]
        again = (w.doc[by][1:] == w.doc[by][:-1]) & (w.w1[by][1:] == w.w1[by][:-1]) & (w.w2[by][1:] == w.w2[by][:-1])
        keep[by[1:][again]] = False
        d = w.doc[keep]
        o, r = np.array(piece.column("o")), np.array(piece.column("r"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (w.w1[keep].view(np.int64), w.w2[keep].view(np.int32), o[d], r[d], w.start[keep].astype(np.int32))],
            names=["w1", "w2", "o", "r", "start"],
        )


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``o``, the order of documents, and ``r``, which tells rows apart."""
    return docs.withColumns({
        "o": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)),
        "r": F.xxhash64("doc_id", F.coalesce("text", F.lit(""))),
    })


def repeats(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``r``, ``o``, ``ranges`` of the windows that also start earlier: a list of first starts, shifted
    by 32 bits, plus last starts.

    ``docs`` has ``o``, ``r`` and ``text``, ``texts`` the same rows partitioned by ``r``. All its columns are
    read, for the sake of one shuffle that the caller uses again.
    """
    local = written(docs.select("o", "r", "text").mapInArrow(_local, LOCAL), "substring-symbols")
    # A symbol has a few rows for each block of texts at most, so its group stays small.
    blocks = F.sum("once").over(Window.partitionBy("symbol"))
    shared = local.filter("symbol IS NOT NULL").select("symbol", "r", blocks.alias("blocks")).filter("blocks > 1")
    wanted = shared.groupBy("r").agg(F.collect_set("symbol").alias("symbols"))
    windows = texts.join(wanted, "r").mapInArrow(_candidates, "w1 long, w2 int, o long, r long, start int")
    # Equal rows of one text tie and are no repeats of each other.
    place = F.rank().over(Window.partitionBy("w1", "w2").orderBy("o", "r", "start"))
    later = windows.withColumn("place", place).filter("place > 1").select("r", "o", F.col("start").alias("lo"), F.col("start").alias("hi"))
    found = local.filter("symbol IS NULL").select("r", "o", "lo", "hi").unionByName(later)
    both = F.shiftleft(F.col("lo").cast("long"), 32) + F.col("hi")
    found = found.select("r", "o", both.alias("both")).repartition("r")
    return found.groupBy("r", "o").agg(F.collect_list("both").alias("ranges"))


def _covered(n: int, ranges: list[int] | None) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    both = np.array(ranges or [], np.int64)
    np.add.at(step, both >> 32, 1)
    np.add.at(step, (both & 0xFFFFFFFF) + WINDOW, -1)
    return np.cumsum(step[:-1]) > 0


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in text_blocks(batches, block=BLOCK):
        rows = []
        for k, text in enumerate(texts):
            words = text.split()
            gone = _covered(len(words), piece.column("ranges")[k].as_py())
            kept = [w for w, x in zip(words, gone.tolist()) if not x] if gone.any() else words
            rows.append((len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
        n, removed, sha = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their repeated words: each goes with the white space after it. Null becomes empty."""
    for piece, texts in text_blocks(batches, block=BLOCK):
        out = []
        for k, text in enumerate(texts):
            ranges = piece.column("ranges")[k].as_py()
            if ranges:
                w = Words([text])
                ends = np.append(w.starts[1:], len(text))
                gone = _covered(len(w), ranges)
                drop = np.zeros(len(text) + 1, np.int64)
                np.add.at(drop, w.starts[gone], 1)
                np.add.at(drop, ends[gone], -1)
                text = np.frombuffer(text, np.uint8)[np.cumsum(drop[:-1]) == 0].tobytes()
            out.append(text)
        yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(out, pa.binary()).cast(pa.string())], names=["row", "text"])


def _with_ranges(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with ``o``, ``r`` and ``ranges``. Texts are shuffled once, for both joins."""
    rows = keyed(docs)
    spread = rows.repartition("r")
    found = repeats(rows, spread).withColumnsRenamed({"r": "r_", "o": "o_"})
    # o only guards against equal hashes. As a second key it would ask for another shuffle.
    same_o = ~((spread["o"] < found["o_"]) | (spread["o"] > found["o_"]))
    return spread.join(found, (spread["r"] == found["r_"]) & same_o, "left").drop("r_", "o_")


def dedup(docs: DataFrame) -> DataFrame:
    """What is left of each text without passages that start earlier.

    A word goes if a window of :data:`WINDOW` words over it also starts in a document of a smaller
    id or earlier in the same one. Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` (of
    the kept words joined by a space) per row. Null and blank texts have no words. Rows without an id
    come after all others, those of one id in the order of a hash; equal rows are one document, and
    each is returned. ``docs`` is read twice and should be a stored table. Further columns are ignored;
    an empty table gives an empty result.
    """
    rows = _with_ranges(docs.select("doc_id", "text")).select("doc_id", "text", "ranges")
    return rows.mapInArrow(_report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text``; rows that have no words left go.

    All other columns stay as they are, whatever their names. For odd rows see :func:`dedup`.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    rows = _with_ranges(docs.select(rest, "doc_id", "text")).select("row", "text", "ranges")
    cut = rows.mapInArrow(_cut, rows.drop("ranges").schema).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
