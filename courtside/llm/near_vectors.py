"""Near copies of vectors: tile products of int8 vectors, with error bounds that make the result exact.

A vector u of length one is written as s * q + rest, q in int8 and |rest| = e known exactly. For two vectors

    u . v  <=  s_u s_v (q_u . q_v) + e_u + e_v + e_u e_v

so a pair whose right side stays below the threshold is no link. Every other pair is computed again in double
precision. Tiles are two blocks of vectors; each gives one row per vector at most: how many vectors of the tile
it is linked with, and one vector of its group inside the tile. The groups over all tiles are connected components.
Equal vectors are one class with a weight, so copies meet no tile more than once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from courtside.llm.components import components, joined, tiles
from courtside.session import settle

BLOCK = 4096
# whole numbers are exact in float32 up to 2^24, so products of int8 vectors are exact for this many dimensions
EXACT_WIDTH = (1 << 24) // (127 * 127)


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_column(embeddings: DataFrame) -> Column:
    """The column ``embedding``, of floats where the table has floats and of doubles otherwise: no value is rounded."""
    kind = embeddings.schema["embedding"].dataType.simpleString()
    return F.col("embedding").cast("array<float>" if kind == "array<float>" else "array<double>").alias("embedding")


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that can be compared."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector_column(embeddings))
    return rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale and length of the rest of unit vectors (rows)."""
    scale = np.abs(unit).max(axis=1, initial=0) / 127
    scale = np.where(scale > 0, scale, 1)
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = np.sqrt(np.square(unit - q * scale[:, None]).sum(axis=1))
    return q, scale, rest


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows, through float32 matrix products over at most EXACT_WIDTH dimensions."""
    total = None
    for d in range(0, a.shape[1], EXACT_WIDTH):
        part = a[:, d : d + EXACT_WIDTH].astype(np.float32) @ b[:, d : d + EXACT_WIDTH].astype(np.float32).T
        total = part if total is None else total.astype(np.float64) + part
    return total


def _linked(threshold: float, stripe: int = 256):
    """One tile: vectors with links, their number (copies counted), and their group's first vector in the tile."""

    def find(table: pa.Table) -> pa.Table:
        node, weight, side = (table[c].to_numpy() for c in ("node", "weight", "side"))
        flat = table["embedding"].combine_chunks()
        x = flat.flatten().to_numpy().astype(np.float64).reshape(len(node), -1)
        # scaled first, so that squares neither overflow nor vanish
        unit = x / np.abs(x).max(axis=1)[:, None]
        unit /= np.sqrt(np.square(unit).sum(axis=1))[:, None]
        q, scale, rest = quantise(unit)
        alone = table["tile_i"][0].as_py() == table["tile_j"][0].as_py()
        left = np.flatnonzero(side == 0)
        right = left if alone else np.flatnonzero(side == 1)
        links = np.zeros(len(node), np.int64)
        rows, cols = [], []
        # what rounding of doubles may add, far above d * 2^-52
        slack = 1e-9
        for s in range(0, len(left), stripe):
            part = left[s : s + stripe]
            most = _products(q[part], q[right]) * (scale[part, None] * scale[right][None, :]).astype(np.float64)
            most += rest[part, None] * (1 + rest[right])[None, :] + rest[right][None, :]
            i, j = np.nonzero(most >= threshold - slack)
            if not len(i):
                continue
            hit = np.zeros(len(i), bool)
            for c in range(0, len(i), 1 << 17):
                hit[c : c + (1 << 17)] = (
                    np.einsum("ij,ij->i", unit[part[i[c : c + (1 << 17)]]], unit[right[j[c : c + (1 << 17)]]]) >= threshold
                )
            i, j = part[i[hit]], right[j[hit]]
            other = i != j
            i, j = i[other], j[other]
            np.add.at(links, i, weight[j])
            if not alone:
                np.add.at(links, j, weight[i])
            # the stripe's groups as stars keep what hangs together, in as many rows as it has vectors
            star = joined(i, j, len(node))
            met = np.unique(np.concatenate([i, j]))
            rows.append(met)
            cols.append(star[met])
        star = joined(np.concatenate(rows), np.concatenate(cols), len(node)) if rows else np.arange(len(node))
        least = node.copy()
        np.minimum.at(least, star, node)
        label = least[star]
        keep = links > 0
        return pa.table({"node": node[keep].astype(np.int64), "links": links[keep], "near": label[keep].astype(np.int64)})

    return find


def near_vectors(embeddings: DataFrame, threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """Links by cosine >= ``threshold``: ``vec_id, n_links, component_id, kept``, one row per row of ``embeddings``.

    Only ``vec_id`` and ``embedding`` are read; labels and other columns, whatever their names, play no part.

    * vectors that are null, empty, zero, or hold null or non-finite components: no links, a component of their own, kept;
    * vectors of different lengths are never linked;
    * equal vectors are linked with each other; repeated rows of an id count as rows of one vector each;
    * a null ``vec_id``: a row without links, ``component_id`` null, not kept;
    * an empty table gives an empty result.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector_column(embeddings))
    good = usable_vectors(embeddings)
    classes = settle(
        good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
        .select(F.size("embedding").alias("width"), "node", "weight", "embedding"),
        "classes",
    )
    sizes = classes.groupBy("width").agg(F.count(F.lit(1)).alias("n"))
    found = settle(
        tiles(classes, "width", sizes, "node", block)
        .groupBy("width", "tile_i", "tile_j")
        .applyInArrow(_linked(threshold), "node long, links long, near long"),
        "tiles",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("near").alias("b")))
    known = classes.join(links, "node", "left").join(groups, "node", "left").select(
        F.xxhash64("embedding").alias("print"), F.col("embedding").alias("e"), F.col("node"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "node").alias("component"),
    )
    marked = rows.withColumn("good", usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    placed = marked.join(
        known, F.col("good") & (F.xxhash64("embedding") == F.col("print")) & (F.col("embedding") == F.col("e")), "left"
    )
    component = F.coalesce("component", "vec_id")
    return placed.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
