"""Queries over the given tables, each with SQL that states its result."""

from . import jobs, records, sources, tenants  # noqa: F401  (importing registers the queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
