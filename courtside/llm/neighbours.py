"""Nearest neighbours by inner product through low-dimensional stable projections.

Vectors are divided by the greatest length L of all. Largest inner product then becomes smallest distance: every vector x
gets one more component sqrt(1 - |x|^2), a query gets 0, and |q - x|^2 = |q|^2 + 1 - 2 q.x. A Gaussian matrix projects to
half the dimensions or fewer, where the squared distance of a pair at distance d is d^2 times a chi-square variable.

The projected points lie in a kd-tree: its upper levels, fitted on a bounded sample, deal all rows to shards; each shard
builds its own lower levels. A query takes points in order of their projected distance and works out the exact product of
each in turn. A point (and with it all that follow, and every box of the tree that lies no nearer) is passed over once a
point nearer than the k-th best so far would project nearer than that with probability ``certainty``: the chi-square test.
A first round searches each query's own shard; its k-th best then rules out shards, leaves and points in the second.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from courtside.llm.near_vectors import usable_vectors
from courtside.session import settle

# dimensions of the projection, and at most half of the vector's
PROJECTED = 32
# of the k-th neighbour; nearer ones pass the test more often
CERTAINTY = 0.92
SHARD = 8192
# queries of one shard that meet one copy of it
QUERY_BLOCK = 65536
# queries that a task works on at a time
STRIPE = 128
LEAF = 256
# rows that fit the upper levels; every row is indexed
SAMPLE = 65536
# leaves of the upper levels at most, so that their boxes are small enough for every task
SHARDS = 4096
SEED = 20


def chi_square(x: np.ndarray | float, m: int):
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, dtype=np.float64) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_limit(p: float, m: int) -> float:
    """Where the distribution function reaches p."""
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, m) < p else (low, middle)
    return high


def projection(width: int, m: int) -> np.ndarray:
    """The matrix for vectors of a length: one row more for the added component."""
    return np.random.default_rng([SEED, width, m]).standard_normal((width + 1, m))


def dimensions(width: int, m: int = PROJECTED) -> int:
    """An even number of dimensions to project vectors of a length to."""
    return max(2, min(m, width // 2) // 2 * 2)


def _project(x: np.ndarray, asked: bool, m: int) -> np.ndarray:
    """Projected rows of length 1 at most, as queries or as indexed vectors."""
    matrix = projection(x.shape[1], m)
    out = x @ matrix[:-1]
    if not asked:
        out += np.sqrt(np.maximum(1 - np.square(x).sum(axis=1), 0))[:, None] * matrix[-1]
    return out


def grow(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Upper levels of a kd-tree in heap order: (dimension, cut) per inner node, widest dimension at its median."""
    nodes, parts = [], [points]
    for _ in range(depth):
        below = []
        for part in parts:
            if len(part):
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                cut = float(np.median(part[:, axis]))
            else:
                axis, cut = 0, 0.0
            nodes.append((axis, cut))
            below += [part[part[:, axis] < cut], part[part[:, axis] >= cut]]
        parts = below
    return nodes


def place(points: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    """Leaf of each point, 0 .. number of leaves - 1."""
    at = np.zeros(len(points), np.int64)
    if nodes:
        axis, cut = np.array([a for a, _ in nodes]), np.array([c for _, c in nodes])
        for _ in range(int(math.log2(len(nodes) + 1))):
            at = 2 * at + 1 + (points[np.arange(len(points)), axis[at]] >= cut[at])
    return at - len(nodes)


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances points x boxes."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d][:, None]
        out += np.square(np.maximum(np.maximum(low[:, d][None, :] - x, x - high[:, d][None, :]), 0))
    return out


def _leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of the points of each leaf of a full kd-tree; equal points may share a larger leaf."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) > size:
            x = points[part]
            axis = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
            half = len(part) // 2
            order = np.argpartition(x[:, axis], half)
            todo += [part[order[:half]], part[order[half:]]]
        elif len(part):
            done.append(part)
    return done


class Shard:
    """Indexed vectors in the order of the leaves of their kd-tree."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, longest: float, m: int, leaf: int = LEAF):
        points = _project(x / longest, False, m)
        parts = _leaves(points, leaf)
        order = np.concatenate(parts)
        self.x, self.points, self.ids, self.rows, self.longest, self.m = x[order], points[order], ids[order], rows[order], longest, m
        self.starts = np.cumsum([0, *map(len, parts)])
        self.low = np.array([points[p].min(axis=0) for p in parts])
        self.high = np.array([points[p].max(axis=0) for p in parts])
        self.squares = np.square(self.points).sum(axis=1)


def search(shard: Shard, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, limit: float):
    """The k best of a shard for each query: (query, place in the shard, score), and how many products were worked out.

    ``own`` are the queries' rows, ``floor`` is a score known to be reached by k others (-inf: unknown).
    """
    unit = q / shard.longest
    asked = _project(unit, True, shard.m)
    near2 = np.square(unit).sum(axis=1) + 1
    # what rounding may do to a distance of scaled vectors, and to a product of given ones
    tiny = 1e-12 * near2
    loose = 2 * tiny * shard.longest * shard.longest
    kth, done = floor.copy(), 0
    who, what, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def bar():
        return limit * np.maximum(near2 - 2 * kth / shard.longest / shard.longest, 0) + tiny

    # leaves that the test leaves to any of the queries
    open_ = np.flatnonzero((~(box_distance(asked, shard.low, shard.high) > bar()[:, None])).any(axis=0))
    at = np.concatenate([np.arange(shard.starts[i], shard.starts[i + 1]) for i in open_]) if len(open_) else np.zeros(0, np.int64)
    far = np.square(asked).sum(axis=1)[:, None] + shard.squares[at][None, :] - 2 * (asked @ shard.points[at].T)
    far = np.maximum(far, 0)
    for nearest in (2 * k, 16 * k, len(at)):
        if nearest < len(at):
            cols = np.argpartition(far, nearest - 1, axis=1)[:, :nearest]
        elif len(at):
            cols, nearest = np.broadcast_to(np.arange(len(at)), far.shape), len(at)
        else:
            break
        here = np.take_along_axis(far, cols, axis=1)
        # the chi-square test of each point; infinite is what was worked out before
        passed = ~(here > bar()[:, None]) & (here < np.inf)
        if not passed.any() and nearest == len(at):
            break
        new = [(who, what, score)]
        for i in np.flatnonzero(passed.any(axis=1)):
            col = cols[i][passed[i]]
            places = at[col]
            done += len(places)
            far[i, col] = np.inf
            about = shard.x[places] @ q[i]
            least = kth[i]
            if len(places) > k + 1:
                # k + 1, for the query itself may be among them
                least = max(least, np.partition(about, len(places) - k - 1)[len(places) - k - 1])
            places = places[~(about < least - loose[i])]
            places = places[shard.rows[places] != own[i]]
            # one way of adding for every pair, so that equal vectors tie exactly
            exact = np.einsum("j,ij->i", q[i], shard.x[places])
            new.append((np.full(len(places), i), places, exact))
        who, what, score = (np.concatenate(c) for c in zip(*new))
        order = np.lexsort((shard.ids[what], -score, who))
        who, what, score = who[order], what[order], score[order]
        count = np.bincount(who, minlength=len(q))
        rank = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        keep = rank < k
        who, what, score, rank = who[keep], what[keep], score[keep], rank[keep]
        last = rank == k - 1
        kth[who[last]] = np.maximum(kth[who[last]], score[last])
        if nearest == len(at):
            break
    return who, what, score, done


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


FOUND = "row long, query_id long, vec_id long, score double"
GROUP = ("width", "shard", "cut", "block")


def _searcher(lengths: dict, k: int, m: int, certainty: float):
    """Rows of a shard, then the queries that reach it, group by group: a task holds one shard and some queries."""

    def run(batches):
        key = index = None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in (*GROUP, "side")], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), len(marks)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                piece, (*group, side) = batch.slice(low, high - low), map(int, marks[low])
                if group != key:
                    key, index, held = group, None, []
                if side == 0:
                    held.append(piece)
                    continue
                width = group[0]
                if held:
                    rows = pa.Table.from_batches(held)
                    held = []
                    index = Shard(
                        _matrix(rows["embedding"]), rows["vec_id"].to_numpy(), rows["row"].to_numpy(), lengths[width], dimensions(width, m)
                    )
                if index is None:
                    continue
                limit = chi_square_limit(certainty, index.m)
                for start in range(0, piece.num_rows, STRIPE):
                    part = piece.slice(start, STRIPE)
                    rows, ids = part.column("row").to_numpy(), part.column("vec_id").to_numpy()
                    floor = part.column("kth").fill_null(-math.inf).to_numpy(zero_copy_only=False)
                    who, what, score, _ = search(index, _matrix(part.column("embedding")), rows, floor, k, limit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[who]), pa.array(ids[who]), pa.array(index.ids[what]), pa.array(score)], ["row", "query_id", "vec_id", "score"]
                    )

    return run


def _homes(trees: dict, lengths: dict, m: int, asked: bool):
    """Adds the shard of every vector, as an indexed point with the point itself, or as a query."""

    def run(batches):
        for batch in batches:
            width = batch.column("width").to_numpy()
            shard = np.zeros(len(width), np.int64)
            points = [None] * len(width)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                x = _project(_matrix(batch.column("embedding").take(pa.array(at))) / lengths[w], asked, dimensions(w, m))
                shard[at] = place(x, trees[w])
                for i, p in zip(at, x):
                    points[i] = p
            batch = batch.append_column("shard", pa.array(shard))
            yield batch if asked else batch.append_column("point", pa.array(points, pa.list_(pa.float64())))

    return run


def _reaches(shards: dict, lengths: dict, m: int, certainty: float):
    """For queries with the k-th best of their first round: all shards whose boxes the test does not rule out."""

    def run(batches):
        for batch in batches:
            width = batch.column("width").to_numpy()
            found = [None] * len(width)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                names, low, high = shards[w]
                for start in range(0, len(at), STRIPE):
                    part = at[start : start + STRIPE]
                    q = _matrix(batch.column("embedding").take(pa.array(part))) / lengths[w]
                    kth = batch.column("kth").take(pa.array(part)).fill_null(-math.inf).to_numpy(zero_copy_only=False) / lengths[w] / lengths[w]
                    near2 = np.square(q).sum(axis=1) + 1
                    n = dimensions(w, m)
                    limit = chi_square_limit(certainty, n) * np.maximum(near2 - 2 * kth, 0) + 1e-12 * near2
                    reach = ~(box_distance(_project(q, True, n), low, high) > limit[:, None])
                    for i, r in zip(part, reach):
                        found[i] = names[r]
            yield batch.append_column("reach", pa.array(found, pa.list_(pa.int64())))

    return run


def neighbours(
    embeddings: DataFrame, every: int = 20, k: int = 20, m: int = PROJECTED, certainty: float = CERTAINTY,
    shard_rows: int = SHARD, query_block: int = QUERY_BLOCK, sample: int = SAMPLE,
) -> DataFrame:
    """The ``k`` nearest of every vector whose id is divisible by ``every``: ``query_id, rank, vec_id, score``.

    Score is the inner product in double precision of the vectors as they are, ties go to the smaller id. Only ``vec_id``
    and ``embedding`` are read; other columns, whatever their names, play no part. A true neighbour passes the test with
    probability ``certainty`` or more; the test shows the recall against brute force and the share of products worked out.

    * vectors that are null, empty, zero, or hold null or non-finite components, and null ids: no part;
    * vectors of different lengths do not meet; with fewer than ``k`` candidates all are returned;
    * rows that repeat an id and its vector count once. Rows that repeat an id with other vectors are rows of their own:
      each is a candidate, and each asks for itself, so that such an id has one list per vector;
    * a query never finds its own row;
    * of equal vectors only the k + 1 smallest ids are indexed: ties go to them, so no other can be returned;
    * an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    good = usable_vectors(embeddings).distinct()
    # numbers of written rows stay the same
    good = settle(good.select("vec_id", "embedding", F.size("embedding").alias("width"), F.monotonically_increasing_id().alias("row")), "vectors")
    largest = F.array_max(F.transform("embedding", F.abs)).cast("double")
    length = F.aggregate(F.transform("embedding", lambda x: x.cast("double") / F.col("largest")), F.lit(0.0), lambda s, x: s + x * x)
    # one row per length of vectors
    stats = good.withColumn("largest", largest).groupBy("width").agg(
        F.max(F.col("largest") * F.sqrt(length)).alias("longest"), F.count(F.lit(1)).alias("n")
    ).collect()
    lengths = {r.width: r.longest for r in stats}
    trees = {}
    for r in stats:
        depth = min(max(0, math.ceil(math.log2(r.n / shard_rows))), int(math.log2(min(SHARDS, sample // 16))))
        trees[r.width] = []
        if depth:
            some = good.where((F.col("width") == r.width) & (F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(math.ceil(sample / r.n * (1 << 20)))))
            fit = some.select("embedding").limit(2 * sample).toArrow()
            trees[r.width] = grow(_project(_matrix(fit["embedding"]) / r.longest, False, dimensions(r.width, m)), depth)

    kind = good.schema["embedding"].dataType.simpleString()
    shape = f"row long, vec_id long, embedding {kind}, width int, shard long"
    kept = good.withColumn("_at", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("_at") <= k + 1)
    placed = settle(
        kept.select("row", "vec_id", "embedding", "width").mapInArrow(_homes(trees, lengths, m, False), f"{shape}, point array<double>"), "placed"
    )
    corners = [f(F.get("point", F.lit(i))).alias(f"{tag}{i}") for i in range(m) for tag, f in (("low", F.min), ("high", F.max))]
    shards = settle(placed.groupBy("width", "shard").agg(F.count(F.lit(1)).alias("n"), *corners), "shards")
    # at most SHARDS rows per length of vectors
    listed = shards.collect()
    corner = {w: dimensions(w, m) for w in lengths}
    boxes = {
        w: (
            np.array([r.shard for r in listed if r.width == w], np.int64),
            *[np.array([[r[f"{tag}{i}"] for i in range(corner[w])] for r in listed if r.width == w]).reshape(-1, corner[w]) for tag in ("low", "high")],
        )
        for w in lengths
    }
    # a shard above its size (equal or crowded points) is cut further by a hash
    sizes = shards.select("width", "shard", F.ceil(F.col("n") / F.lit(2 * shard_rows)).cast("int").alias("cuts"))
    index = placed.join(sizes, ["width", "shard"]).select(
        "width", "shard", F.pmod(F.xxhash64("row"), F.col("cuts")).cast("int").alias("cut"), "row", "vec_id", "embedding"
    )
    asked = good.where(F.col("vec_id") % every == 0).select("row", "vec_id", "embedding", "width")
    homes = asked.mapInArrow(_homes(trees, lengths, m, True), shape).join(sizes, ["width", "shard"], "left").select(
        "row", "vec_id", "embedding", "width", "shard", F.pmod(F.xxhash64("row"), F.coalesce("cuts", F.lit(1))).cast("int").alias("cut")
    )
    homes = settle(homes, "queries")

    def searched(queries: DataFrame) -> DataFrame:
        to = ["width", "shard", "cut"]
        # a shard is copied once per block of the queries that reach it; shards that none reaches are not read
        blocks = settle(queries.groupBy(*to).agg(F.ceil(F.count(F.lit(1)) / F.lit(query_block)).cast("int").alias("blocks")), "blocks")
        own = index.join(blocks, to).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asking = queries.join(blocks, to).withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).cast("int"))
        both = own.select(*GROUP, F.lit(0).alias("side"), "row", "vec_id", "embedding", F.lit(None).cast("double").alias("kth")).unionByName(
            asking.select(*GROUP, F.lit(1).alias("side"), "row", "vec_id", "embedding", "kth")
        )
        return both.repartition(*GROUP).sortWithinPartitions(*GROUP, "side").mapInArrow(_searcher(lengths, k, m, certainty), FOUND)

    first = settle(searched(homes.withColumn("kth", F.lit(None).cast("double"))), "first")
    best = first.groupBy("row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    known = homes.join(best, "row", "left").select(
        "row", "vec_id", "embedding", "width", F.col("shard").alias("home"), F.col("cut").alias("home_cut"), "kth"
    )
    reach = known.mapInArrow(
        _reaches(boxes, lengths, m, certainty),
        f"row long, vec_id long, embedding {kind}, width int, home long, home_cut int, kth double, reach array<long>",
    )
    onward = settle(
        reach.withColumn("shard", F.explode("reach"))
        .join(sizes, ["width", "shard"])
        .withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .where((F.col("shard") != F.col("home")) | (F.col("cut") != F.col("home_cut")))
        .select("row", "vec_id", "embedding", "width", "shard", "cut", "kth"),
        "onward",
    )
    both = first.unionByName(searched(onward))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
