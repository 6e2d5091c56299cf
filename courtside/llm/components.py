"""Connected components of a link table, and links found between blocks of a group."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from courtside.session import settle


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``a, b`` links; the component is its smallest node.

    Alternates two steps: every node's larger neighbours move to its smallest neighbour, then every
    node and its smaller neighbours do. The links shrink to one star per component in few rounds.
    Each round is written to the shared folder; minima are combined before the shuffle, and a hot
    centre only meets one row per node in the joins.
    """
    now = settle(_ordered(links), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _ordered(both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.withColumnRenamed("m", "b")
        )
        now, before = settle(_ordered(small), "links"), mark
        mark = _mark(now)
        if mark == before:
            break
    centres = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, larger node first, without links of a node to itself."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFFFFFF)).alias("s")).first()
    return row.n, row.s or 0


def tiles(rows: DataFrame, group: str, sizes: DataFrame, key: str, block: int) -> DataFrame:
    """Rows of each group once for every pair of blocks they belong to, as columns tile_i <= tile_j and side.

    A group with n rows (``sizes``: group, n) is cut into ceil(n / ``block``) blocks by a hash of
    ``key``; rows of (group, tile_i, tile_j) are at most about two blocks. ``side`` is 0 for rows of
    block tile_i and 1 for rows of tile_j; a block against itself holds its rows once.
    """
    cut = sizes.select(group, F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")
    return (
        rows.join(cut, group)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("tile_i", F.least("own", "other"))
        .withColumn("tile_j", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") > F.col("tile_i")).cast("int"))
        .drop("own", "other", "blocks")
        # else the join's partitioning by group would do for the tiles, and put a large group's in one task
        .repartition(group, "tile_i", "tile_j")
    )


def joined(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the smallest place it is joined with by the links i - j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if (before == label).all():
            return label
