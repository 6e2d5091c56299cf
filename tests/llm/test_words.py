from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from courtside.llm.words import find_words, pieces, shingles, text_bytes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB\t \nçÉ1", max_size=30)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_a_split(texts):
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    w = find_words(data, bounds)
    want = [(i, x) for i, t in enumerate(texts) for x in (t or "").encode().lower().split()]
    assert [(d, bytes(w.low[s:e])) for d, s, e in zip(w.doc, w.start, w.end)] == want
    assert w.counts.tolist() == [len((t or "").encode().split()) for t in texts]
    by_word = {}
    for (_, x), h in zip(want, w.hash):
        assert by_word.setdefault(x, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_are_distinct_windows(texts, k):
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    doc, value = shingles(find_words(data, bounds), k)
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(s) for s in sets]
    assert len(set(value.tolist())) == len(set().union(*sets)) if sets else not len(value)


def test_pieces_cover_all_texts_and_long_ones_stand_alone():
    bounds = np.array([0, 3, 5, 50, 50, 52, 60])
    assert list(pieces(bounds, 10)) == [(0, 2), (2, 3), (3, 6)]
    assert list(pieces(np.zeros(1, np.int64))) == []


def test_sliced_columns_and_large_strings():
    column = pa.array(["a b", None, "c", "d e f"])
    for part in (column.slice(1, 3), pa.chunked_array([column.slice(1, 1), column.slice(2, 2)]), column.slice(1, 3).cast(pa.large_string())):
        data, bounds = text_bytes(part)
        assert find_words(data, bounds).counts.tolist() == [0, 1, 3]
