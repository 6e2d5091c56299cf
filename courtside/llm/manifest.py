"""A Merkle manifest of a table, with proofs made by checkpoint and recomputation.

Every row is a leaf. The leaves of one source in order of id form a tree whose runs of ``FAN`` nodes become one node; the
source's last node is its subroot, and the subroots form one more such tree with the root. Only every ``EVERY`` levels are
written: a level is built from the one below it in aligned subtrees of ``FAN ** EVERY`` nodes, one group each. A proof goes
the other way: from the root down, each subtree's missing nodes are worked out again from its stored descendants, every
descendant is given its siblings and those of its subtree above it, and the nodes in between are dropped.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.session import settle

# Nodes of a run, the columns of a leaf.
FAN = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# levels between two written ones: a subtree has at most 729 written descendants
EVERY = 6

_PATH = "array<struct<before: string, after: string>>"


def leaf_of(values: list[Column]) -> Column:
    """Hash of the values, each `-` if null, else its bytes in UTF-8, `:`, and itself."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def run_hash(nodes) -> str:
    """A run's node."""
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def rounds(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def subtree(nodes: list[str], up: int) -> list[list[str]]:
    """The levels of a subtree, from its descendants up."""
    levels = [nodes]
    for _ in range(up):
        below = levels[-1]
        levels.append([run_hash(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[dict]:
    """What stands before and after a descendant and its ancestors in their runs."""
    path = []
    for level in levels[:-1]:
        low = at - at % FAN
        path.append({"before": "".join(level[low:at]), "after": "".join(level[at + 1 : low + FAN])})
        at //= FAN
    return path


def folded(node: str, path) -> str:
    for step in path:
        node = run_hash((step["before"], node, step["after"]))
    return node


def placed(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``place`` (from 0) and ``size`` within ``tree``, by ranges and prefix sums.

    Rows are dealt into ranges of tree and order; a row's place is its place in the range, plus the rows of its tree in
    ranges before. A tree of a third of all rows is many ranges. ``order`` must tell all rows apart.
    """
    spread = rows.repartitionByRange(F.col(tree).asc_nulls_first(), *order).sortWithinPartitions(F.col(tree).asc_nulls_first(), *order)
    # the upper bits of this id are the range, the lower ones the place in it
    ranged = settle(spread.withColumn("_id", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_id", 33)), "ranged")
    ranges = ranged.groupBy("_range", tree).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # as many rows per tree as it has ranges
    whole = Window.partitionBy(tree)
    sums = ranges.select(
        F.col("_range").alias("_r"), F.col(tree).alias("_t"), "_first",
        F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("size"),
    )
    own = (F.col("_range") == F.col("_r")) & F.col(tree).eqNullSafe(F.col("_t"))
    return ranged.join(sums, own).withColumn("place", F.col("_before") + F.col("_id") - F.col("_first")).drop("_id", "_range", "_r", "_t", "_first", "_before")


class Forest:
    """Trees over written nodes ``tree`` (null is a tree too), ``place``, ``size``, ``node``, with their written levels."""

    def __init__(self, nodes: DataFrame, every: int = EVERY):
        self.every, self.block = every, FAN**every
        self.levels = [nodes.select("tree", "place", "size", "node")]
        most = nodes.agg(F.max("size")).first()[0] or 0
        # one more written level for every ``block``-fold size
        while most > 1:
            most = -(-most // self.block)
            self.levels.append(settle(self._above(self.levels[-1]), "nodes"))

    def _above(self, nodes: DataFrame) -> DataFrame:
        """The next written level; trees that have come to their last node go up as they are."""
        every, block = self.every, self.block

        def build(key, rows):
            levels, _ = regenerated(rows, every, block)
            size = -(-rows["size"][0].as_py() // block)
            return pa.table({"tree": [key[0].as_py()], "place": [key[1].as_py()], "size": [size], "node": levels[-1]}, _NODE)

        return nodes.groupBy("tree", F.floor(F.col("place") / block).alias("b")).applyInArrow(build, "tree string, place long, size long, node string")

    def roots(self) -> DataFrame:
        """``tree, node``."""
        return self.levels[-1].select("tree", "node")

    def paths(self, tops: DataFrame, lowest: int) -> DataFrame:
        """``tree, place, path, root, subroot`` of the nodes of a written level, from ``tree, path, root, subroot`` of the last ones.

        A path holds what stands before and after a node and each of its ancestors, up to the root.
        """
        paths = tops.select("tree", F.lit(0).cast("long").alias("place"), "path", "root", "subroot")
        every, block = self.every, self.block

        def extend(key, rows, above):
            levels, places = regenerated(rows, every, block)
            n, (path, root, subroot) = len(places), (above[c][0].as_py() for c in ("path", "root", "subroot"))
            found = [siblings(levels, i) + path for i in range(n)]
            return pa.table({"tree": [key[0].as_py()] * n, "place": places, "path": found, "root": [root] * n, "subroot": [subroot] * n}, _PATHS)

        for nodes in reversed(self.levels[lowest:-1]):
            paths = settle(
                beside(nodes, paths, block).applyInArrow(extend, f"tree string, place long, path {_PATH}, root string, subroot string"), "paths"
            )
        return paths


_NODE = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("size", pa.int64()), ("node", pa.string())])
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_PATHS = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("path", _STEPS), ("root", pa.string()), ("subroot", pa.string())])
_PROOFS = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
    ("folded_root", pa.string()), ("verified", pa.bool_()),
])


def beside(nodes: DataFrame, paths: DataFrame, block: int):
    """Subtrees beside the path of the node they end in."""
    return nodes.groupBy("tree", F.floor(F.col("place") / block).alias("b")).cogroup(paths.groupBy("tree", F.col("place").alias("b")))


def regenerated(rows: pa.Table, every: int, block: int) -> tuple[list[list[str]], list[int]]:
    """All levels of one subtree, and the places of its descendants in order."""
    rows = rows.sort_by("place")
    size = rows["size"][0].as_py()
    return subtree(rows["node"].to_pylist(), every if size > block else rounds(size)), rows["place"].to_pylist()


def manifest(documents: DataFrame, every: int = EVERY) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row per row of ``documents``.

    Leaves are hashes of ``doc_id, source, lang, n_chars, text``; other columns, whatever their names, play no part. Every
    row whose id has an even unsigned crc32 is tampered with: its text loses its newlines. ``folded_root`` goes up from
    the leaf after that with the siblings before it; ``verified`` tells whether it is the root.

    * null values are marked as null, so a null text is not an empty one; tampering leaves null and empty texts alone;
    * long texts are hashed whole;
    * a null source is a tree of its own, first in order; a null ``doc_id`` comes first in its source and is never
      tampered with;
    * rows that share source and id are ordered by leaf; repeated rows are leaves of their own, in order of reading, and
      only their proofs differ;
    * a source of one row has that leaf as subroot, and a table of one source that subroot as root;
    * an empty table gives an empty result.
    """
    every_id = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("tree"), "lang", "n_chars", F.col("text").cast("string").alias("text")
    )
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.when(even & F.contains("text", F.lit("\n")), F.replace("text", F.lit("\n"), F.lit("")))
    others = [F.col("doc_id"), F.col("tree"), F.col("lang"), F.col("n_chars")]
    leaves = settle(
        every_id.withColumn("cut", cut).select(
            "doc_id", "tree", leaf_of([*others, F.col("text")]).alias("node"), F.when(F.col("cut").isNotNull(), leaf_of([*others, F.col("cut")])).alias("tampered")
        ),
        "leaves",
    ).withColumn("read", F.monotonically_increasing_id())
    rows = settle(placed(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("read")]).drop("read"), "placed")
    trees = Forest(rows, every)
    # the sources' own tree; its places give back the sources
    roots = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node")
    sources = settle(placed(roots, "tree", [F.col("source").asc_nulls_first()]), "sources")
    top = Forest(sources, every)
    start = top.roots().select("tree", F.array().cast(_PATH).alias("path"), F.col("node").alias("root"), F.lit(None).cast("string").alias("subroot"))
    tops = sources.join(top.paths(start, 0).select("place", "path", "root"), "place").select(F.col("source").alias("tree"), "path", "root", F.col("node").alias("subroot"))
    return proofs(rows, trees.paths(settle(tops, "tops"), 1), every)


def proofs(leaves: DataFrame, paths: DataFrame, every: int = EVERY) -> DataFrame:
    """The rows of ``manifest`` from placed leaves and the paths of the lowest written level above them."""
    block = FAN**every

    def prove(key, rows, above):
        rows = rows.sort_by("place")
        levels, _ = regenerated(rows, every, block)
        path, root, subroot = (above[c][0].as_py() for c in ("path", "root", "subroot"))
        upper = "".join(step["before"] + step["after"] for step in path)
        # a subtree's own node goes up once, not once per leaf
        ups = {}
        ids, ends = [], []
        for i, (leaf, tampered) in enumerate(zip(levels[0], rows["tampered"].to_pylist())):
            own = siblings(levels, i)
            ids.append(run_hash([*(step["before"] + step["after"] for step in own), upper]))
            end = folded(tampered or leaf, own)
            if end not in ups:
                ups[end] = folded(end, path)
            ends.append(ups[end])
        n = len(ids)
        return pa.table(
            {
                "doc_id": rows["doc_id"], "leaf": levels[0], "subroot": [subroot] * n, "root": [root] * n, "proof_sha256": ids, "folded_root": ends,
                "verified": [end == root for end in ends],
            },
            _PROOFS,
        )

    kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return beside(leaves, paths, block).applyInArrow(prove, kinds)
