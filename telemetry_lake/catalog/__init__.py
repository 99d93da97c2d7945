"""Registered queries: each operator and job on the shared test tables, with equivalent SQL."""

from .registry import QUERIES, SQL
from . import scans, sinks, shaping, joins, aggregates, scalars, streams, jobs  # noqa: F401  (register)

__all__ = ["QUERIES", "SQL"]
