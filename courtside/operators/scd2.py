"""Slowly changing dimension, type 2, as a rewrite of the dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.scalars import differs
from courtside.session import settle


def scd2(
    dim: DataFrame,
    new: DataFrame,
    key: str,
    compare: Sequence[str],
    as_of: Column,
    keep_dates: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Returns (the next full dimension, the rows inserted by this refresh).

    Everything is decided on the dimension as it was before the refresh:

    * an open version closes when any source row of its key differs in a compared
      column; a NULL on either side is no difference;
    * source rows of a key that has no version at all are inserted, and so are those of
      a key that just closed. A key with closed versions only is left alone;
    * inserted rows are active and carry ``as_of`` as start and end date. With
      ``keep_dates`` the rows of unknown keys keep their own ``rec_start_date`` and
      ``rec_end_date``.

    The source may hold any number of rows per key: it is reduced to the smallest and
    largest value per compared column before it meets the dimension (x differs from some
    value exactly when it differs from the smallest or the largest), so both joins here
    have one row per key on their right side.
    """
    edges = new.groupBy(F.col(key).alias("_k")).agg(
        *[f(c).alias(f"_{tag}_{c}") for c in compare for tag, f in (("lo", F.min), ("hi", F.max))]
    )
    compared = [F.col(c) for c in compare for _ in ("lo", "hi")]
    edge = [F.col(f"_{tag}_{c}") for c in compare for tag in ("lo", "hi")]
    # both the kept rows and the state of the keys come from these rows
    marked = settle(dim.join(edges, F.col(key) == F.col("_k"), "left").select(
        *dim.columns,
        (F.coalesce(F.col("is_rec_active"), F.lit(False)) & differs(compared, edge)).alias("_closing"),
    ), "marked")
    closing = F.col("_closing")
    kept = marked.withColumns(
        {
            "updated_at": F.when(closing, as_of.cast(dim.schema["updated_at"].dataType)).otherwise(F.col("updated_at")),
            "rec_end_date": F.when(closing, as_of.cast("date")).otherwise(F.col("rec_end_date")),
            "is_rec_active": F.when(closing, F.lit(False)).otherwise(F.col("is_rec_active")),
        }
    ).drop("_closing")

    state = marked.groupBy(F.col(key).alias("_k")).agg(F.bool_or("_closing").alias("_closed"))
    fresh = F.col("_closed").isNull()
    today = as_of.cast("date")
    start, end = today, today
    if keep_dates:
        start = F.when(fresh, F.col("rec_start_date")).otherwise(today)
        end = F.when(fresh, F.col("rec_end_date")).otherwise(today)
    inserted = (
        new.join(state, F.col(key) == F.col("_k"), "left")
        .where(fresh | F.col("_closed"))
        .withColumns(
            {
                "rec_start_date": start,
                "rec_end_date": end,
                "is_rec_active": F.lit(True),
                "created_at": as_of.cast(dim.schema["created_at"].dataType),
                "updated_at": F.lit(None).cast(dim.schema["updated_at"].dataType),
            }
        )
        .select(*dim.columns)
        .distinct()
    )
    return kept.unionByName(inserted), inserted


def open_versions(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one open version; empty when the source is unique per key."""
    return dim.where("is_rec_active").groupBy(key).count().where("count > 1")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once; empty when the key holds."""
    return df.groupBy(*keys).count().where("count > 1")
