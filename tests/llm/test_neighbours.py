from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

from courtside.llm.neighbours import CERTAINTY, PROJECTED, Shard, chi_square, chi_square_limit, dimensions, neighbours, search

SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, rank int, score double"


def brute(vectors, ids, query, k):
    x = vectors.astype(np.float64)
    score = np.array([np.dot(x[query], x[i]) if i != query else -np.inf for i in range(len(x))])
    order = np.lexsort((ids, -score))[: min(k, len(x) - 1)]
    return [int(ids[i]) for i in order], score


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_and_scores_over_many_shards(spark, clustered):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 20))
    if clustered:
        x = x[:30][rng.integers(0, 30, 900)] + 0.1 * x
    x = (x * rng.uniform(0.5, 2, (900, 1))).astype(np.float32)
    rows = [(i, v.tolist(), 0, 5, 6, 0.5) for i, v in enumerate(x)]
    got = {}
    for r in neighbours(spark.createDataFrame(rows, SCHEMA), every=20, k=20, shard_rows=64, query_block=16, sample=512).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    ids = np.arange(900)
    assert sorted(got) == list(range(0, 900, 20))
    for q, found in got.items():
        want, score = brute(x, ids, q, 20)
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in found)
        hits += len(set(want) & {v for _, v, _ in found})
        total += 20
    assert hits / total >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0] if i < 60 else [0.0, 1.0], 0, 5, 6, 0.5) for i in range(100)]
    found = neighbours(spark.createDataFrame(rows, SCHEMA), every=20, k=5).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 40: [0, 1, 2, 3, 4], 60: [61, 62, 63, 64, 65], 80: [60, 61, 62, 63, 64]}


def test_odd_rows(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 2.0], 0, 0, 0, 0.0), (20, None, 0, 0, 0, 0.0), (40, [0.0, 0.0], 0, 0, 0, 0.0), (60, [nan, 1.0], 0, 0, 0, 0.0), (1, [3.0, 1.0], 0, 0, 0, 0.0),
        (2, [1.0, 1.0, 1.0], 0, 0, 0, 0.0), (None, [1.0, 2.0], 0, 0, 0, 0.0), (80, [1.0, 0.0, 0.0], 0, 0, 0, 0.0), (0, [1.0, 2.0], 0, 0, 0, 0.0), (3, [], 0, 0, 0, 0.0),
    ]
    got = [tuple(r) for r in neighbours(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 5.0), (80, 1, 2, 1.0)]
    assert neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chi_square():
    rng = np.random.default_rng(0)
    drawn = np.square(rng.standard_normal((200_000, 8))).sum(axis=1)
    for p in (0.5, 0.9, 0.98):
        limit = chi_square_limit(p, 8)
        assert abs(chi_square(limit, 8) - p) < 1e-9 and abs((drawn <= limit).mean() - p) < 0.005


def test_the_test_rules_out_products_of_the_given_vectors():
    """Recall and products worked out over the given table, from the operator's own search."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array(table["embedding"].to_pylist(), np.float64)
    ids = table["vec_id"].to_numpy()
    m = dimensions(x.shape[1], PROJECTED)
    shard = Shard(x, ids, np.arange(len(x)), float(np.sqrt(np.square(x).sum(axis=1)).max()), m)
    asked = np.flatnonzero(ids % 20 == 0)
    who, what, score, products = search(shard, x[asked], asked, np.full(len(asked), -np.inf), 20, chi_square_limit(CERTAINTY, m))
    hits = 0
    for i, a in enumerate(asked):
        want, exact = brute(x, ids, a, 20)
        hits += len(set(want) & set(shard.ids[what[who == i]]))
    assert m <= x.shape[1] // 2
    assert hits >= 0.9 * 20 * len(asked)
    assert products <= 0.6 * len(asked) * len(x)


def test_a_known_kth_best_rules_out_leaves_and_points():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 32))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    x = centres[np.arange(4000) % 8] + 0.02 * rng.standard_normal((4000, 32))
    rows = np.arange(4000)
    shard = Shard(x, rows, rows, float(np.linalg.norm(x, axis=1).max()), 16)
    limit = chi_square_limit(CERTAINTY, 16)
    first = search(shard, x[:40], rows[:40], np.full(40, -np.inf), 10, limit)
    floor = np.array([first[2][first[0] == i].min() for i in range(40)])
    again = search(shard, x[:40], rows[:40], floor, 10, limit)
    # other clusters are passed over
    assert again[3] <= first[3] < 0.3 * 40 * 4000


def test_rows_that_repeat_an_id_with_another_vector_are_candidates(spark):
    rows = [(20, [1.0, 0.0], 0, 0, 0, 0.0), (1, [1.0, 0.1], 0, 0, 0, 0.0), (1, [5.0, 0.0], 0, 0, 0, 0.0)]
    got = [tuple(r) for r in neighbours(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 1, 5.0), (20, 2, 1, 1.0)]
    # an id with two vectors asks with each, and each finds the other
    rows = [(20, [1.0, 0.0], 0, 0, 0, 0.0), (20, [3.0, 0.0], 0, 0, 0, 0.0), (1, [2.0, 0.0], 0, 0, 0, 0.0)]
    got = sorted(tuple(r) for r in neighbours(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(20, 1, 1, 6.0), (20, 1, 20, 3.0), (20, 2, 1, 2.0), (20, 2, 20, 3.0)]


def test_doubles_are_not_rounded(spark):
    rows = [(20, [1e39, 0.0]), (1, [1e39, 1.0]), (2, [1.0 + 1e-12, 0.0]), (3, [1.0, 0.0])]
    got = [tuple(r) for r in neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()]
    assert got == [(20, 1, 1, 1e39 * 1e39), (20, 2, 2, 1e39 * (1.0 + 1e-12)), (20, 3, 3, 1e39)]


def test_queries_in_blocks_meet_the_whole_index(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 6)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    one = sorted(map(tuple, neighbours(frame, every=2, k=5, certainty=0.9999).collect()))
    many = sorted(map(tuple, neighbours(frame, every=2, k=5, certainty=0.9999, query_block=7, shard_rows=32, sample=512).collect()))
    assert one == many and len(one) == 200 * 5
