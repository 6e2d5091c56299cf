from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from courtside.llm import manifest as m
from tests.llm import cases

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, place long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root, and per node its runs' other nodes from the bottom up with the number before it."""
    paths, level, where = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, at in enumerate(where):
            run, own = level[at // 3 * 3 : at // 3 * 3 + 3], at % 3
            paths[i].append((run[:own], run[own + 1 :]))
            where[i] = at // 3
        level = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(((r[0], leaf(r[0], s, r[2], r[4], r[1]), r) for r in sources[s]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = (own, *tree([x[1] for x in own]))
    root, tops = tree([trees[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        own, subroot, paths = trees[s]
        for (doc_id, node, r), path in zip(own, paths):
            path = path + top
            cut = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and r[1] is not None
            end = leaf(doc_id, s, r[2], r[4], r[1].replace("\n", "")) if cut else node
            for before, after in path:
                end = h("".join(before) + end + "".join(after))
            out.append((str(doc_id), node, subroot, root, h("".join("".join(b + a) for b, a in path)), end, end == root))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("every", [1, 2, 6])
def test_equals_trees_built_whole(spark, every):
    rng = random.Random(every)
    sizes = {"a": 100, "b": 1, "c": 3, None: 9, "": 10, "é": 2, "z": 28, "Z": 27}
    rows = [
        (i, rng.choice(["x\ny", "plain", "", None, "ü\n\n"]), rng.choice(["en", None]), s, rng.choice([5, None]), "n", 3)
        for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    rng.shuffle(rows)
    got = result(m.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), every))
    assert got == brute(rows)
    assert {v for *_, v in got} == {True, False}


def test_many_sources(spark):
    rows = [(i, f"t{i}\n", "en", f"s{i % 40}", i, "n", 3) for i in range(120)]
    assert result(m.manifest(spark.createDataFrame(rows, SCHEMA), 2)) == brute(rows)


def test_one_row_and_none(spark):
    rows = [(2, "a\nb", "en", "s", 3, "n", 3)]
    (got,) = result(m.manifest(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)[0] and got[1] == got[2] == got[3] and got[4] == h("")
    assert m.manifest(cases.empty(spark)).count() == 0


def test_a_changed_row_changes_the_root(spark):
    rows = [(i, f"t{i}", "en", "ab"[i % 2], i, "n", 3) for i in range(20)]
    roots = {m.manifest(spark.createDataFrame([*rows[:7], row, *rows[8:]], SCHEMA)).first().root for row in (rows[7], (7, "other", *rows[7][2:]), (7, None, *rows[7][2:]))}
    assert len(roots) == 3


def test_odd_rows(spark):
    assert result(m.manifest(cases.frame(spark))) == brute(cases.rows())
