"""Registered queries. Importing the package fills the registry."""

from courtside.queries import loading, refreshing, rosters, split_tables, streams, timing, values  # noqa: F401
from courtside.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
