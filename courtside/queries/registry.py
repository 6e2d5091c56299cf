"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtside.queries.league import League
from courtside.session import ready

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the league's tables under a name, with its SQL if there is one."""

    def register(build: Callable[[League], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(League(ready(spark), sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
