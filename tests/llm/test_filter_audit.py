from __future__ import annotations

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from courtside.llm import filter_audit as f
from tests.llm import cases

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, text string"


def fails(text, copied):
    w = WORDS.findall(text)
    bad = {
        "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)), "E": copied,
    }
    return {name for name, is_bad in bad.items() if is_bad}


def brute(docs, labels):
    """Figures by applying the filters in turn, document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    judged = {}
    for i, text, source in docs:
        own = fails(text or "", i is not None and i > least[text or ""])
        judged.setdefault(source or "", []).append((own, i in good, i in toxic))
    out = {}
    for part, rows in judged.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                total[name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(name in r[0] for r in rows) - len(gone), sum(r[0] == {name} for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone), name,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = total[row[6]]
    return sorted((*key, *row) for key, row in out.items())


def check(spark, docs, labels):
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(*row, "x") for row in labels], LABELS)
    assert sorted(tuple(r) for r in f.filter_interactions(table, marks).collect()) == brute(docs, labels)


def text(rng):
    n = rng.choice([0, 3, 199, 200, 260])
    pool = rng.choice([["a", "b"], [f"w{i}" for i in range(400)]])
    words = rng.choices(pool, k=n)
    if rng.random() < 0.3:
        words.append(rng.choice(["A" * 40, "É" * 40, "5%", "x|y"]))
    return rng.choice([" ", "\n", "  "]).join(words)


def test_equals_filters_applied_in_turn(spark):
    rng = random.Random(8)
    texts = [text(rng) for _ in range(60)]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(300)] + [(400, None, "c"), (401, "", "a")]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)] + [(2, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    check(spark, docs, labels)


def test_carry_save_counts_equal_plain_sums(spark):
    rng = random.Random(1)
    for n in (1, 2, 14, 15, 16, 4096, 5000):
        words = [rng.getrandbits(32) for _ in range(n)]
        frame = spark.createDataFrame([("p", True, False, w) for w in words], "part string, good boolean, toxic boolean, word long").coalesce(1)
        (row,) = f.subset_survivors(frame).collect()
        assert row.n == [sum(w >> s & 1 for w in words) for s in range(32)]


def test_survival_word(spark):
    rows = spark.range(32).select("id", f.survival_word(F.col("id")).alias("w")).collect()
    assert all(r.w >> s & 1 == (s & r.id == 0) for r in rows for s in range(32))


def test_plan_holds_no_python(spark):
    plan = f.filter_interactions(cases.frame(spark), spark.createDataFrame([], LABELS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_odd_rows(spark):
    marks = spark.createDataFrame([(1, 1, 0, "x"), (None, 1, 1, None)], LABELS)
    docs = [(r[0], r[1], r[3]) for r in cases.rows()]
    got = sorted(tuple(r) for r in f.filter_interactions(cases.frame(spark), marks).collect())
    assert got == brute(docs, [(1, 1, 0), (None, 1, 1)])
    assert f.filter_interactions(cases.empty(spark), marks).count() == 0
