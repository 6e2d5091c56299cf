from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from courtside.llm import mixing
from courtside.llm.mixing import mix_sources, mixture, targets
from tests.llm import cases


def filled(sizes):
    """Targets by repeated sharing out, in order of name with None last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        if not open_:
            return fixed
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(3)
    for sizes in (
        {"a": 10, "b": 1000, "c": 5, None: 40}, {f"s{i}": rng.choice([0, 1, 7, 90, 4000]) for i in range(14)}, {"only": 9}, {"z": 0, None: 0},
        {"é": 50, "z": 50, "Z": 1},
    ):
        got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = filled(sizes)
        assert set(got) == set(want)
        assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want), (got, want)


def documents(spark):
    rng = random.Random(5)
    rows = [
        (i, " ".join(["w"] * rng.choice([1, 3, 20, 100])), rng.choice(["big", "big", "big", "a", "b", None]), i % 4) for i in range(400)
    ]
    return spark.createDataFrame([*rows, (7, "w w", "a", 0), (7, "w w", "a", 0)], "doc_id long, text string, source string, copies int")


def test_cut_is_that_of_one_sorted_list_per_source(spark):
    rows = mix_sources(documents(spark), range_bits=3).collect()
    by_source = {}
    for d, text, source, _ in documents(spark).collect():
        by_source.setdefault(source, []).append((int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16), d, len(text.split())))
    goals = filled({s: sum(n for *_, n in x) for s, x in by_source.items()})
    want = []
    for s, docs in by_source.items():
        size, place = sum(n for *_, n in docs), 0
        full = int(goals[s] // size)
        for _, d, n in sorted(docs):
            more = 2 * place + n <= 2 * (goals[s] - full * size)
            want.append((d, n, size, n * (full + more)))
            place += n
        taken = sum(t for d, n, z, t in want[-len(docs) :])
        assert abs(taken - goals[s]) <= 100
    assert sorted((r.doc_id, r.size, r.source_size, r.taken) for r in rows) == sorted(want)
    assert all(r.taken <= 3 * r.size for r in rows)


def test_mixture_repeats_rows_as_counted(spark):
    docs = documents(spark)
    counted = {}
    for r in mix_sources(docs).collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + r.copies
    mixed = mixture(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in counted.items() if n}


def test_ties_at_the_cut_stay_within_the_budget(spark):
    """Rows without id and of equal size, equal rows, and both beside a source that takes up what they leave."""
    rows = [(None, " ".join(["w"] * 10 + [f"t{i}"]), "a", i) for i in range(100)] + [(None, "x y z", "b", 0)] * 50
    rows += [(5, "one two", "c", 1)] * 30 + [(5, "two one", "c", 2)] * 30 + [(i, "w " * 40, "d", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    plan = mix_sources(docs).collect()
    assert len(plan) == len(rows)
    mixed = mixture(docs).collect()
    for source, size in (("a", 11), ("b", 3), ("c", 2), ("d", 40)):
        whole = sum(len(r[1].split()) for r in rows if r[2] == source)
        planned = [r for r in plan if r.size == size and r.source_size == whole]
        words = sum(len(r.text.split()) for r in mixed if r.source == source)
        assert words == sum(r.taken for r in planned)
        assert abs(words - planned[0].target) <= size
        copies = {r.copies for r in planned}
        assert max(copies) - min(copies) <= 1
    again = mixture(docs.orderBy(F.rand(8)).repartition(5)).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again))


def test_large_groups_are_given_back_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 7)
    rows = [(None, "x y", "a")] * 100 + [(i, "u v w", "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_sources(docs).collect()
    assert len(plan) == 120
    got = {r.source: r["count"] for r in mixture(docs).groupBy("source").count().collect()}
    assert got == {"a": sum(r.copies for r in plan if r.size == 2), "b": sum(r.copies for r in plan if r.size == 3)}


def test_result_does_not_depend_on_partitions(spark):
    docs = documents(spark)
    one = sorted(map(tuple, mix_sources(docs).collect()))
    assert one == sorted(map(tuple, mix_sources(docs.orderBy(F.rand(3)).repartition(7)).collect()))


def test_odd_rows(spark):
    rows = mix_sources(cases.frame(spark)).collect()
    assert len(rows) == len(cases.rows())
    assert sorted((r.doc_id or -1, r.size) for r in rows) == sorted((r[0] or -1, len((r[1] or "").encode().split())) for r in cases.rows())
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixture(cases.frame(spark)).columns == cases.frame(spark).columns
    assert mix_sources(cases.empty(spark)).count() == 0 and mixture(cases.empty(spark)).count() == 0
