"""Projections, filters and wide-to-long reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import METRIC_CODES


def melt(
    df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str], var_name: str = "variable",
    value_name: str = "value",
) -> DataFrame:
    """Wide to long: one row per input row and value column. Values share one type.

    The rows stay in their partitions, and Spark knows it (of ``unpivot`` it does not): what was dealt by
    ``id_vars`` needs no shuffle to be grouped by them.
    """
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").alias("value")) for c in value_vars]
    return df.select(*[f"`{c}`" for c in id_vars], F.inline(F.array(*pairs)).alias(var_name, value_name))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map in one projection; names that are absent are ignored."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def try_cast_columns(df: DataFrame, names: Sequence[str], data_type: str = "double") -> DataFrame:
    """Cast ``names`` in one projection; text that does not parse becomes null."""
    wanted = set(names)
    return df.select(
        *[F.col(f"`{c}`").try_cast(data_type).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns]
    )


def metric_dictionary(spark: SparkSession) -> DataFrame:
    """The metric dictionary as a table ``(ASMMetric, code)``."""
    return spark.createDataFrame(list(METRIC_CODES.items()), "ASMMetric string, code string")


def with_metric_code(df: DataFrame, column: str = "ASMMetric") -> DataFrame:
    """Replace metric column names by their report codes; unknown metrics are dropped.

    The dictionary is a fixed list of 35 entries, so a map literal does without a join.
    """
    entries = [F.lit(text) for pair in METRIC_CODES.items() for text in pair]
    code = F.try_element_at(F.create_map(*entries), F.col(column))
    return df.withColumn(column, code).filter(F.col(column).isNotNull())


def attach_scalar(df: DataFrame, **scalars: DataFrame) -> DataFrame:
    """Add the single value of each one-row, one-column DataFrame to every row."""
    return df.select("*", *[value.scalar().alias(name) for name, value in scalars.items()])


def branch(df: DataFrame, predicates: Sequence[Column], column: str = "branch") -> DataFrame:
    """Number each row by the first predicate it meets; rows that meet none get ``len(predicates)``."""
    index = F.lit(len(predicates))
    for position in range(len(predicates) - 1, -1, -1):
        index = F.when(predicates[position], position).otherwise(index)
    return df.withColumn(column, index)


def expand(df: DataFrame, prefixes: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """One record per prefix, re-keyed to ``prefix-value``; the value stays."""
    prefix = F.explode(F.array(*[F.lit(p) for p in prefixes]))
    return df.withColumn("__prefix", prefix).select(
        F.concat_ws("-", "__prefix", F.col(value)).alias(key), value, *[c for c in df.columns if c not in (key, value)]
    )
