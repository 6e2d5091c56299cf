"""Sort orders with NULL as the largest value, the opposite of Spark's default."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def earliest_first(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def latest_first(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]
