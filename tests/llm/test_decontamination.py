from __future__ import annotations

import hashlib
import random
import re

import pytest

from courtside.llm import decontamination as d
from tests.llm import cases

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        m = min(window, len(v))
        runs = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i : i + m]) in runs:
                hit |= set(range(i, i + m))
                found.add("" if item_id is None else str(item_id))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def check(spark, docs, items, **options):
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), *map(str, r[1:])) for r in d.contamination(texts, bench, **options).collect())
    want = sorted((str(i), *map(str, brute(t, items, options.get("window", 10)))) for i, t in docs)
    assert got == want


@pytest.mark.parametrize("window, k", [(10, 6), (4, 4), (4, 3), (5, 2), (6, 1)])
def test_equals_brute_force(spark, window, k):
    rng = random.Random(window * 10 + k)

    def text(n):
        return rng.choice(["", "..", "\n"]) + "".join(rng.choice(["a", "B", "b", "É", "é", "x1"]) + rng.choice([" ", "-", ". "]) for _ in range(n))

    # few words: many ties, repeated grams and items within items
    items = [(i, text(rng.randint(0, 14))) for i in range(6)] + [(7, None), (8, ""), (9, "É é"), (10, "a b a b a b a b a b a b a b")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(70, items[0][1]), (71, None), (72, "a b " * 40)]
    check(spark, docs, items, window=window, k=k)


def test_every_shared_window_is_found_and_nothing_shorter(spark):
    rng = random.Random(4)
    item = [f"w{rng.randint(0, 10**6)}" for _ in range(40)]
    filler = ["the", "of", "Straße", "ÉCOLE"]
    docs = []
    for i in range(31):
        docs.append((i, " ".join(rng.choices(filler, k=i) + item[i : i + 10] + rng.choices(filler, k=5)).upper()))
        docs.append((100 + i, " ".join(rng.choices(filler, k=3) + item[i : i + 9] + rng.choices(filler, k=3))))
    check(spark, docs, [(1, " ".join(item))])


def test_case_of_other_letters_counts(spark):
    line = "one two three four five six seven eight nine école"
    check(spark, [(1, line), (2, line.upper()), (3, line.replace("é", "É")), (4, line.replace("e", "E"))], [(1, line)])


def test_repeated_rows_and_items(spark):
    line = "one two three four five six seven eight nine ten eleven"
    docs = [(1, line), (1, line), (1, "x " + line), (None, line), (None, None)]
    check(spark, docs, [(5, line), (5, line), (12, line.upper()), (None, line), (3, "five six"), (None, None)])


def test_merged_spans(spark):
    hits = spark.createDataFrame([(1, 0, "p", 5, 9), (1, 0, "q", 10, 12), (1, 0, "p", 7, 8), (1, 0, "p", 20, 29), (2, 0, "p", 0, 3)], "doc_id long, print long, passage string, first_word long, last_word long")
    assert sorted(tuple(r) for r in d.merged(hits).collect()) == [(1, 0, 5, 12), (1, 0, 20, 29), (2, 0, 0, 3)]


def test_shuffled_join_gives_the_same(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        line = "one two three four five six seven eight nine ten eleven"
        check(spark, [(i, ("x " * i) + line) for i in range(20)] + [(50, "none")], [(1, line), (2, "x x x")])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_plan_holds_no_python(spark):
    bench = cases.frame(spark).withColumnRenamed("doc_id", "item_id")
    plan = d.contamination(cases.frame(spark), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_odd_rows(spark):
    bench = cases.frame(spark).withColumnRenamed("doc_id", "item_id").where("item_id is null or item_id not in (9, 10)")
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = sorted((str(r.doc_id), *map(str, r[1:])) for r in d.contamination(cases.frame(spark), bench).collect())
    assert got == sorted((str(r[0]), *map(str, brute(r[1], items))) for r in cases.rows())
    assert d.contamination(cases.empty(spark), bench).count() == 0
    none = d.contamination(cases.frame(spark), cases.empty(spark).withColumnRenamed("doc_id", "item_id")).collect()
    assert len(none) == len(cases.rows()) and not any(r.contaminated for r in none)
    with pytest.raises(ValueError):
        d.contamination(cases.frame(spark), bench, window=3, k=4)
