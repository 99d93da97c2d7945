"""Text columns the native operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: White space between words: the six ASCII space characters.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def n_matches(text: Column, chars: str) -> Column:
    """Characters of a regex class ``[chars]`` in a text without nulls."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{chars}]+", ""))


def boxed(docs: DataFrame, *names: str) -> DataFrame:
    """All columns of ``docs`` as one struct ``row``, and ``names`` beside it: work columns then clash with none."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *names)
