"""Query registry and the SQL side of the derived views."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .sql_views import VIEWS
from .views import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _with_views(body: str) -> str:
    """Put the derived views a statement names, and those they name, in front of it."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                texts.append(VIEWS[name])
    if not needed:
        return body
    heads = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    return f"WITH {heads}\n{body}"


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def query(sql: str | None = None, name: str | None = None):
    """Register a function of a :class:`Lake`; ``sql`` may name derived views."""

    def register(fn: Callable[[Lake], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _plain_times(fn(Lake(spark, sf_dir)))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = _with_views(sql.strip())
        return fn

    return register
