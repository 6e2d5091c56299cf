from __future__ import annotations

import numpy as np

from courtside.llm.near_vectors import near_vectors, quantise
from tests.llm.test_components import brute

SCHEMA = "vec_id long, embedding array<float>, label int, node string, links string"


def test_links_equal_brute_force_with_small_blocks(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 16))
    # spread so that cosines fall on both sides of the threshold
    vectors = np.concatenate([centres[rng.integers(0, 30, 200)] + rng.standard_normal((200, 16)) * 0.28, centres[:5], centres[:5]])
    vectors = (vectors * rng.uniform(0.01, 100, (len(vectors), 1))).astype(np.float32)
    rows = [(i, v.tolist(), i % 3, "n", "l") for i, v in enumerate(vectors)]
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    groups = brute([(int(a), int(b)) for a, b in zip(*np.nonzero(linked))])
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, SCHEMA), block=16).collect()}
    assert len(got) == len(rows)
    for i in range(len(rows)):
        assert got[i].n_links == linked[i].sum()
        assert got[i].component_id == groups.get(i, i) and got[i].kept == (groups.get(i, i) == i)
    assert 50 < linked.sum() < linked.size / 4


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(6)
    u = rng.standard_normal((60, 24)) ** 3
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    q, s, e = quantise(u)
    bound = (q.astype(int) @ q.astype(int).T) * s[:, None] * s[None, :] + e[:, None] * (1 + e)[None, :] + e[None, :]
    assert (u @ u.T <= bound + 1e-12).all()
    assert q.dtype == np.int8 and np.abs(q.astype(int)).max() <= 127


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 0, "", ""), (2, [2.0, 0.0], 0, "", ""), (2, [2.0, 0.0], 0, "", ""), (3, None, 0, "", ""), (4, [0.0, 0.0], 0, "", ""),
        (5, [nan, 1.0], 0, "", ""), (6, [inf, 1.0], 0, "", ""), (7, [None, 1.0], 0, "", ""), (8, [], 0, "", ""), (9, [1.0, 0.0, 0.0], 0, "", ""),
        (None, [1.0, 0.0], 0, "", ""), (10, [3e38, 1e30], None, None, None), (11, [1e-38, 0.0], 0, "", ""),
    ]
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id, r.kept) for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [
        (-1, 0, None, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)],
        (10, 4, 1, False), (11, 4, 1, False),
    ]
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_doubles_are_not_rounded(spark):
    rows = [(1, [1e39, 0.0]), (2, [1e39, 1.0]), (3, [1.0, 0.0]), (4, [0.0, 1e-300]), (5, [0.0, 1e300])]
    got = sorted(tuple(r) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (5, 1, 4, False)]
