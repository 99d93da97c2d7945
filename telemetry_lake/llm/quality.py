"""Quality rules: a decision list learned from labelled statistics, applied as Spark conditions.

Sequential covering: a conjunction of thresholds is grown on two thirds of the labelled rows by
information gain, pruned on the rest, and added to the list if it is precise enough there; the rows
it covers are removed and the next one is grown. The list becomes one ``CASE WHEN`` over statistics
that Spark computes from the whole text, so applying it needs neither a shuffle nor Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .columns import boxed, n_matches, SPACES, words

#: Labelled rows that fit the rules: the first by a hash of their id. Everything else sees all rows.
MAX_LABELLED = 12_000
#: Words of a window that counts as repeated.
WINDOW = 8
#: A document with fewer words, or with a larger share (per cent) of repeated words, is rejected.
MIN_WORDS, MAX_REPEATED = 20, 30
#: Candidate thresholds per statistic.
CUTS = 32
MAX_RULES, MAX_TERMS, MIN_COVER, MIN_PRECISION = 12, 4, 8, 0.9

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_exclaim", "n_distinct"]
#: Ratios the rules look at.
SHARES = {
    "symbol_share": ("n_symbols", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "exclaim_share": ("n_exclaim", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``__stats`` of :data:`STATISTICS`, :data:`MORE` and :data:`SHARES`.

    Each step is a projection of its own, so that no array is computed twice. Windows of words are
    compared by 64-bit hashes within one text.
    """
    names = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.select(*names, words(F.col("text")).alias("__w"), F.split(text, "\n").alias("__lines"))
    n = F.size("__w")
    hashes = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("__w"), i + k) for k in range(WINDOW)])
    )
    step = step.select(
        *names, "__w",
        F.filter("__lines", lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("__lines"),
        F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("__h"),
    )
    # Sorted hashes with their places, only where one occurs twice.
    places = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.select(
        *names, "__w", "__lines",
        F.when(F.size(F.array_distinct("__h")) < F.size("__h"), places).otherwise(none).alias("__s"),
    )
    twice = F.filter(
        "__s",
        lambda x, j: (x["h"] == F.get(F.col("__s"), j - 1)["h"]) | (x["h"] == F.get(F.col("__s"), j + 1)["h"]),
    )
    step = step.select(*names, "__w", "__lines", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("__p"))
    gaps = F.transform("__p", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("__p"), j + 1) - x, F.lit(WINDOW))))
    counts = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join("__w", "")),
        "n_symbols": n_matches(text, "#*$%&|<>"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.aggregate(gaps, F.lit(0), lambda a, b: a + b),
        "n_lines": F.size("__lines"),
        "n_upper": n_matches(text, "A-Z"),
        "n_exclaim": n_matches(text, "!"),
        "n_distinct": F.size(F.array_distinct("__w")),
    }
    step = step.select(*names, F.struct(*[c.cast("bigint").alias(k) for k, c in counts.items()]).alias("__c"))
    shares = [
        F.when(F.col(f"__c.{b}") > 0, F.col(f"__c.{a}") / F.col(f"__c.{b}")).otherwise(F.lit(0.0)).alias(k)
        for k, (a, b) in SHARES.items()
    ]
    # As output of a generator the statistics are computed once: a filter on them cannot be pushed
    # below, as a copy of all that computes them.
    stats = F.struct(*[F.col(f"__c.{k}").alias(k) for k in counts], *shares)
    return step.select(*names, F.explode_outer(F.array(stats)).alias("__stats"))


def base_failed() -> Column:
    s = lambda k: F.col(f"__stats.{k}")
    return (s("n_words") < MIN_WORDS) | (100 * s("n_repeat_words") > MAX_REPEATED * s("n_words"))


@dataclass(frozen=True)
class Term:
    """``statistic <= cut`` or ``statistic > cut``."""

    statistic: str
    above: bool
    cut: float

    def column(self) -> Column:
        c = F.col(f"__stats.{self.statistic}")
        return c > self.cut if self.above else c <= self.cut


Rule = tuple[Term, ...]


def _gain(p0: float, n0: float, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Information gain of keeping ``p`` of ``p0`` wanted and ``n`` of ``n0`` other rows."""
    before = math.log2(p0 / (p0 + n0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - before), -np.inf)


def _covered(x: np.ndarray, names: list[str], rule: Rule) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for t in rule:
        v = x[:, names.index(t.statistic)]
        hit &= v > t.cut if t.above else v <= t.cut
    return hit


def _grow(x: np.ndarray, y: np.ndarray, names: list[str]) -> Rule:
    rule: list[Term] = []
    rows = np.ones(len(x), bool)
    while len(rule) < MAX_TERMS and (y[rows] == 0).any():
        best, best_gain = None, 1e-9
        wanted, other = y[rows].sum(), (1 - y[rows]).sum()
        if not wanted:
            break
        for f, name in enumerate(names):
            v, label = x[rows, f], y[rows]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, CUTS + 1)[1:-1]))
            below = v[:, None] <= cuts
            p, n = label @ below, (1 - label) @ below
            for above, gain in ((False, _gain(wanted, other, p, n)), (True, _gain(wanted, other, wanted - p, other - n))):
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Term(name, above, float(cuts[k])), gain[k]
        if best is None:
            break
        rule.append(best)
        rows = _covered(x, names, tuple(rule))
    return tuple(rule)


def _prune(x: np.ndarray, y: np.ndarray, names: list[str], rule: Rule) -> Rule:
    """The prefix of the rule with the best (p - n) / (p + n) on rows not used to grow it."""

    def worth(r: Rule) -> float:
        hit = _covered(x, names, r)
        p, n = y[hit].sum(), (1 - y[hit]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Rule]:
    """Rules that cover the rows with ``y == 1``, in the order in which they apply.

    The rows arrive in a fixed order; every third one serves to prune. No rows, or labels of one
    kind only, give no rules.
    """
    held = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and y[left & ~held].sum() >= MIN_COVER and y[left].min() == 0:
        rule = _grow(x[left & ~held], y[left & ~held], names)
        rule = _prune(x[left & held], y[left & held], names, rule) if rule else ()
        hit = _covered(x, names, rule) & left if rule else np.zeros(len(x), bool)
        held_hit = hit & held
        if hit.sum() < MIN_COVER or not held_hit.any() or y[held_hit].mean() < MIN_PRECISION or y[hit].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learn rules for ``quality = 0`` from at most ``max_labelled`` labelled documents.

    Rows without an id, a label or a document do not count; of repeated ids each row does.
    """
    sample = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_labelled)
    )
    # At most max_labelled rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    names = [*STATISTICS, *SHARES]
    found = (
        with_statistics(rows)
        .filter(~base_failed())
        .select("doc_id", (F.col("quality") == 0).cast("int").alias("y"), *[F.col(f"__stats.{k}").cast("double").alias(k) for k in names])
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y", *names)
        .limit(max_labelled)
        .collect()
    )
    data = np.array([tuple(r)[1:] for r in found], dtype=float).reshape(len(found), len(names) + 1)
    return learn(data[:, 1:], data[:, 0], names)


def rejects(rules: list[Rule]) -> Column:
    """The decision list: one branch per rule, in order; what no rule covers is kept."""
    verdict = F.when(base_failed(), F.lit(True))
    for rule in rules:
        hit = rule[0].column()
        for term in rule[1:]:
            hit = hit & term.column()
        verdict = verdict.when(hit, F.lit(True))
    return verdict.otherwise(F.lit(False))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id``, :data:`STATISTICS`, ``base_failed`` and ``kept`` of every row of ``docs``.

    Null and blank texts have no words and fail; repeated rows are judged alike; ids may be null;
    further columns are ignored; an empty table gives an empty result.
    """
    return with_statistics(docs.select("doc_id", "text")).select(
        "doc_id", *[F.col(f"__stats.{k}").alias(k) for k in STATISTICS],
        base_failed().alias("base_failed"), (~rejects(rules)).alias("kept"),
    )


def kept_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns, whatever their names."""
    return with_statistics(boxed(docs, "text")).filter(~rejects(rules)).select("row.*")
