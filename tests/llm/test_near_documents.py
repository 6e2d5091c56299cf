from __future__ import annotations

import random

import numpy as np
import pytest

from courtside.llm.near_documents import near_documents, one_of_each, super_min_hash
from tests.llm import cases
from tests.llm.test_components import brute


def sets_of(texts, k):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])
    return out


def groups_of(texts, k=4):
    sets = sets_of(texts, k)
    links = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    found = brute(links)
    return {i: found.get(i, i) for i in sets}, sets


def test_groups_equal_brute_force_with_small_blocks(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, number = [], 0
    for size in (90, 40, 6, 3, 2) + (1,) * 40:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 60))]
        for _ in range(size):
            words = list(base)
            # around the threshold: some copies are linked with others but not with the first
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append((number, " ".join(words)))
            number += 1
    passage = " ".join(rng.choice(vocabulary) for _ in range(25))
    for _ in range(60):
        texts.append((number, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(25))))
        number += 1
    rng.shuffle(texts)
    want, sets = groups_of(texts)
    rows = near_documents(spark.createDataFrame(texts, "doc_id long, text string"), k=4, block=16, set_block=8).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (want[r.doc_id] == r.doc_id) for r in rows)
    assert len(set(want.values())) < len(want) - 40


def test_odd_rows(spark):
    rows = near_documents(cases.frame(spark), k=4).collect()
    assert len(rows) == len(cases.rows())
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got[1] == (13, 1, True) and got[2] == (13, 1, False)
    assert got[3] == (0, 3, True) and got[4] == (0, 4, True) and got[5] == (0, 5, True)
    assert got[6] == (1, 6, True) and got[7] == (1, 6, False)
    assert got[9][1:] == (9, True) and got[10][1:] == (9, False)
    assert got[None] == (13, None, False)
    assert got[11] == (14, 1, False) and sum(r.doc_id == 11 for r in rows) == 2
    assert near_documents(cases.empty(spark)).count() == 0


def naive(values, slots, draws):
    """One element after the other, as the signature is defined."""
    h = [None] * slots
    for v in values:
        order = list(range(slots))
        for j in range(slots):
            k, r = draws(v, j, slots)
            order[j], order[k] = order[k], order[j]
            mark = (j, r)
            if h[order[j]] is None or mark < h[order[j]]:
                h[order[j]] = mark
    return h


def test_signature_is_that_of_the_definition():
    from courtside.llm.words import mix

    def draws(v, j, slots):
        d = int(mix(np.array([(v + 0x9E3779B97F4A7C15 * (j + 1)) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])
        return j + (d >> 40) % (slots - j), d & 0xFFFFFFFFFF

    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 62, n) for n in (1, 2, 7, 40)]
    doc = np.repeat(np.arange(4), [len(s) for s in sets])
    got = super_min_hash(doc, np.concatenate(sets).astype(np.uint64), 5, 12)
    for i, s in enumerate(sets):
        assert got[i].tolist() == [j << 40 | r for j, r in naive(s.tolist(), 12, draws)]
    assert (got[4] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


@pytest.mark.parametrize("similarity", [0.3, 0.8])
def test_agreeing_slots_estimate_similarity(similarity):
    rng = np.random.default_rng(2)
    error = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        shared = int(200 * similarity)
        rest = (200 - shared) // 2
        a, b = pool[: shared + rest], np.concatenate([pool[:shared], pool[shared + rest : shared + 2 * rest]])
        sig = super_min_hash(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2, 150)
        error.append((sig[0] == sig[1]).mean() - shared / (shared + 2 * rest))
    assert abs(np.mean(error)) < 0.015
    # below the spread of independent minima
    assert np.std(error) < np.sqrt(similarity * (1 - similarity) / 150)


def test_no_pairs_and_no_plain_shuffle_of_texts(spark):
    plan = near_documents(cases.frame(spark), k=4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "text" not in plan


def varied(seed, *changes):
    """A text, and one near copy of it per change."""
    rng = random.Random(seed)
    words = [f"s{seed}w{rng.randrange(500)}" for _ in range(60)]
    return [" ".join(words)] + [" ".join(words[:-1] + [x]) for x in changes]


def test_every_text_of_a_repeated_id_is_compared(spark):
    rows = []
    for n in range(6):
        # ids 10n and 10n + 1 stand for three texts each; near copies of every one have ids of their own
        for t, (text, near) in enumerate(varied(10 * n + t, "near") for t in range(3)):
            rows += [(10 * n, text), (10 * n + 2 + t, near)]
    got = near_documents(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == r.doc_id // 10 * 10 and r.kept == (r.doc_id % 10 == 0) for r in got)


def test_texts_with_clashing_ids_and_without_id(spark):
    (a, a1), (b, b1), (c, c1) = (varied(90 + t, "near") for t in range(3))
    rows = [(1, a), (1, b), (1, a1), (2, b1), (2, b1), (None, c), (None, c), (None, c1), (3, "alone here"), (3, "alone here"), (4, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, i % 2) for i, (d, t) in enumerate(rows)], "doc_id long, text string, print int")
    got = one_of_each(docs, k=4)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == 6 and set(kept) <= set(rows)
    assert {t for d, t in kept if d == 1} in ({a, b}, {a1, b}) and [t for d, t in kept if d == 3] == ["alone here"]
    assert sum(d is None and t is not None for d, t in kept) == 1 and (4, "") in kept and (None, None) in kept
    assert one_of_each(cases.empty(spark)).count() == 0
