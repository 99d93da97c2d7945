"""Spelling variants: words one edit apart, found through sorted permuterm rotations.

A word ``w`` is marked by a terminator, ``w$``, and rotated to every place. A rotation that ends with the
character ``c`` is the word cut open behind ``c``: ``w = a c b`` gives ``b $ a c``. Words that differ in that
character share all of the rotation but its last place, and the word without it has exactly that
prefix as a rotation of its own. So the rotations that begin with ``b $ a`` and are at most one longer
hold the words of one *gap*: all are one edit apart, and no two others of one edit are missed.

Spark sorts the rotations by that prefix and scans each gap. It holds at most one word per character
of the alphabet and one without, and needs no pairs: of each gap a word learns how many others there
are and which is the most frequent. A shorter word meets a longer one in several gaps where a
character is doubled (``aab`` and ``ab``); only the gap at the first of the equal characters counts them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .store import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
END = "$"
#: A run whose crc32 this number divides loses a character.
DAMAGE = 97
MIN_CHARS, MIN_TIMES, RATIO = 5, 3, 2
#: Distinct words a task counts before it hands them on.
HELD = 100_000


def words_of(doc_id: int | None, text: str | None) -> Counter[str]:
    """Words of one text and their occurrences: runs of letters with A-Z in lower case, less one character if
    :data:`DAMAGE` divides the crc32 of id and run."""
    runs: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(text or "")).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    out: Counter[str] = Counter()
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_CHARS:
            out[run] += n
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for given in batches:
        for doc_id, text in zip(given.column("doc_id").to_pylist(), given.column("text")):
            for word, n in words_of(doc_id, text.as_py()).items():
                held[word] += n
            if len(held) > HELD:
                yield batch()
    yield batch()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and its occurrences ``n``, of words long and frequent enough.

    For the words of a text see :func:`words_of`; a missing id counts as empty text. Tasks count before the shuffle.
    """
    counts = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_TIMES)


def rotations(words: DataFrame) -> DataFrame:
    """``gap``, ``mark`` (the character in the gap, null for the word without one), ``last`` (the character before
    the gap), ``word`` and ``n``: two rows per rotation."""
    marked = F.concat("word", F.lit(END))
    length = F.char_length("word") + 1
    ring = words.select("word", "n", F.concat(marked, marked).alias("ring"), length.alias("length"), F.explode(F.sequence(F.lit(1), length)).alias("at"))
    whole = ring.select("word", "n", F.expr("substring(ring, at, length)").alias("rotation"))
    cut = F.expr("left(rotation, char_length(rotation) - 1)")
    opened = whole.filter(~F.endswith("rotation", F.lit(END))).select(cut.alias("gap"), F.right("rotation", F.lit(1)).alias("mark"), "word", "n")
    closed = whole.select(F.col("rotation").alias("gap"), F.lit(None).cast("string").alias("mark"), "word", "n")
    return opened.unionByName(closed).select("gap", "mark", F.right("gap", F.lit(1)).alias("last"), "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near`` (words one edit apart, each once), ``near`` and ``near_n`` (the most frequent, the
    smaller word among equals); words without any are left out.

    ``words`` are distinct. Every gap is one sorted scan of at most an alphabet's words.
    """
    gap = Window.partitionBy("gap")
    order = gap.orderBy(F.desc("n"), F.asc("word"))
    others = {
        "members": F.count(F.lit(1)).over(gap),
        "place": F.row_number().over(order),
        "first": F.first(F.struct("n", "word")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "second": F.nth_value(F.struct("n", "word"), 2).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        # The word without a character meets the doubled one in another gap too: at the first of the two.
        "short": F.count(F.when(F.col("mark").isNull(), 1)).over(gap),
        "doubled": F.count(F.when(F.col("mark") == F.col("last"), 1)).over(gap),
    }
    met = rotations(words).withColumns(others).filter("members > 1")
    twice = F.when(F.col("mark").isNull(), F.col("doubled")).when(F.col("mark") == F.col("last"), F.col("short")).otherwise(0)
    other = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first"))
    seen = met.select("word", "n", (F.col("members") - 1 - twice).alias("near"), other.alias("other"))
    return seen.groupBy("word").agg(
        F.first("n").alias("n"),
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("other.n")).alias("minus"), F.col("other.word").alias("word"))).alias("best"),
    ).select("word", "n", "n_near", F.col("best.word").alias("near"), (-F.col("best.minus")).alias("near_n"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``word``, ``root``: the last word of the chain of ``form`` from each ``word``.

    Each step at least multiplies the count by :data:`RATIO`, so chains are no longer than the logarithm of
    the largest count ``most``, and doubling the step needs the logarithm of that.
    """
    longest = max(1, math.floor(math.log(max(most, 1) / MIN_TIMES, RATIO)) if most >= MIN_TIMES else 1)
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = written(jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variant-roots")
    return jumps


def group(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` with the spelling they are a variant of: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``form`` is the near word of the largest count if that is at least :data:`RATIO` times the word's own, else
    null; ``root`` the end of the chain of forms. Null and empty texts have no words; an empty table gives no
    rows; rows that repeat an id count as often as they occur; further columns are ignored.
    """
    words = written(word_counts(docs), "variant-words")
    near = neighbours(words).select("word", "n_near", "near", "near_n")
    fits = F.col("near_n") >= RATIO * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")
    )
    judged = written(judged, "variant-forms")
    most = judged.agg(F.max("n")).first()[0] or 0
    ends = roots(judged.filter("form IS NOT NULL"), most)
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
