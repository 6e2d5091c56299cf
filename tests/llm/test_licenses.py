from __future__ import annotations

import random
import re

from courtside.llm import licenses
from tests.llm import cases

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORDS.findall((text or "").encode().lower())
    at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.encode().split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_equal_brute_force(spark):
    rng = random.Random(2)
    parts = ["MIT", "mit", "License", "license", "apache", "general", "public", "GNU", "é", "x1", "K", "kit", "license."]
    texts = [(i, rng.choice([" ", "", "--"]).join([]) + "".join(rng.choice(parts) + rng.choice([" ", "  ", "-", "\n", "."]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    texts += [(900, "..MIT License"), (901, "MIT License MIT License"), (902, "mit licenses"), (903, "general public general public license")]
    got = {r.doc_id: r for r in licenses.license_labels(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, text in texts:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_copied_notices_are_found_with_words_put_in_and_left_out(spark):
    _, bsd = next(t for t in licenses.TEMPLATES if t[0] == "bsd")
    words = bsd.split()
    changed = words[:8] + ["really"] + words[8:20] + words[22:]
    rng = random.Random(1)
    filler = " ".join(rng.choice(["the", "of", "and", "source", "code"]) for _ in range(80))
    texts = [
        (1, filler + " " + bsd), (2, " ".join(changed)), (3, " ".join(words[: len(words) // 4])), (4, filler), (5, "Licensed under CC BY-NC 4.0."),
        (6, " ".join(reversed(words))), (7, bsd + " " + filler + " " + bsd),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 3)) for r in licenses.license_labels(docs).collect()}
    assert got[1] == ("bsd", 1.0) and got[2][0] == "bsd" and 0.6 < got[2][1] < 1 and got[3] == ("", 0.0) and got[4] == ("", 0.0)
    assert got[5] == ("cc-by-nc", 1.0) and got[6] == ("", 0.0)
    _, spans = licenses.scan_licenses(docs)
    places = {(r.doc_id, r.first_word, r.last_word) for r in spans.collect()}
    n = len(WORDS.findall(bsd.encode()))
    assert {(1, 80, 79 + n), (7, 0, n - 1), (7, n + 80, 2 * n + 79)} <= places


def test_plan_holds_no_python(spark):
    plan = licenses.license_labels(cases.frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_odd_rows(spark):
    rows = licenses.license_labels(cases.frame(spark)).collect()
    assert len(rows) == len(cases.rows())
    want = sorted((r[0] or -1, *map(str, brute(r[1]))) for r in cases.rows())
    assert sorted((r.doc_id or -1, *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in rows) == want
    repeated = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (1, "apache license"), (None, "mit license"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_base, r.labels) for r in licenses.license_labels(repeated).collect())
    assert got == [("1", 1, "apache"), ("1", 1, "mit"), ("1", 1, "mit"), ("None", 0, ""), ("None", 1, "mit")]
    assert licenses.license_labels(cases.empty(spark)).count() == 0
