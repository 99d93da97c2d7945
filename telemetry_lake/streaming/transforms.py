"""Stateless record transforms and running counts, for batch and streaming DataFrames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import separators_only
from ..operators.reshape import branch, expand


def filter_values(records: DataFrame, wanted: str) -> DataFrame:
    """Records whose *value* equals ``wanted``."""
    return records.filter(F.col("value") == wanted)


def branch_by_prefix(records: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Number records by the first key prefix they have; drop those without any."""
    numbered = branch(records, [F.col("key").startswith(p) for p in prefixes])
    return numbered.filter(F.col("branch") < len(prefixes))


def map_records(records: DataFrame, key: Column | None = None, value: Column | None = None) -> DataFrame:
    """Replace key and/or value by an expression of the record."""
    replaced = {"key": key, "value": value}
    return records.select(
        *[F.col(c) if replaced.get(c) is None else replaced[c].alias(c) for c in records.columns]
    )


def append_suffix(records: DataFrame, suffix: str = "-new") -> DataFrame:
    """Keep the key and append ``suffix`` to the value."""
    return map_records(records, value=F.concat(F.col("value"), F.lit(suffix)))


def flat_map_prefixes(records: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """One record per prefix, keyed ``prefix-value``."""
    return expand(records, prefixes)


def lower_values(records: DataFrame) -> DataFrame:
    return map_records(records, value=F.lower("value"))


def words(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row per word of every line, as :func:`~telemetry_lake.functions.text.tokenize` splits it.

    Empty words are filtered as rows, in generated code, rather than inside the array.
    """
    pieces = lines.filter(~separators_only(F.col(text))).select(
        F.posexplode(F.split(F.lower(text), r"\W+")).alias("position", "word")
    )
    return pieces.filter((F.col("word") != "") | (F.col("position") == 0)).select("word")


def count_by(records: DataFrame, column: str) -> DataFrame:
    """Records per distinct value. On a stream: running counts without retention (update mode)."""
    return records.groupBy(column).count()


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    return count_by(words(lines, text), "word")
