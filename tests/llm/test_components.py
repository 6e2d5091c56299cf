from __future__ import annotations

import random

import numpy as np

from courtside.llm.components import components, joined, tiles


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(5, 5)]
    links += [(rng.randint(300, 420), rng.randint(300, 420)) for _ in range(90)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute([x for x in links if x[0] != x[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_joined_places():
    assert joined(np.array([4, 3, 0]), np.array([3, 2, 1]), 6).tolist() == [0, 0, 2, 2, 2, 5]


def test_tiles_meet_every_pair_of_a_group_once(spark):
    rows = spark.range(50).selectExpr("id % 2 as g", "id as k")
    sizes = spark.createDataFrame([(0, 25), (1, 25)], "g long, n long")
    met = {}
    for r in tiles(rows, "g", sizes, "k", 4).collect():
        met.setdefault((r.g, r.tile_i, r.tile_j), []).append((r.k, r.side))
    pairs = []
    for (g, i, j), members in met.items():
        one = [k for k, s in members if s == 0]
        two = [k for k, s in members if s == 1]
        pairs += [(a, b) for a in one for b in one if a < b] if i == j else [(min(a, b), max(a, b)) for a in one for b in two]
    assert sorted(pairs) == sorted((a, b) for a in range(50) for b in range(a + 2, 50, 2))
