"""Registered queries (Spark plans) and their DuckDB oracle SQL."""

from . import other_queries, text_queries  # noqa: F401  (registration side effects)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
