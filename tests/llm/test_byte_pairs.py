from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from courtside.llm import byte_pairs
from tests.llm import cases

TOKENS = byte_pairs.read_ranks(public.path("byte_bpe_50k.tiktoken"))
CODEC = byte_pairs.Codec(TOKENS, public.PATTERN, remembered=500 * byte_pairs.ENTRY)
WANT = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library_and_come_back(text):
    packed = next(CODEC.encode([text]))
    assert np.frombuffer(packed, "<u4").tolist() == WANT.encode_ordinary(text)
    assert CODEC.decode(packed) == text.encode()


def test_every_white_space_and_letter_class_is_split_as_in_the_library():
    for c in [*range(0x3000), 0x85, 0xA0, 0x180E, 0xFEFF, 0x1F600, 0x20000]:
        if 0xD800 <= c < 0xE000:
            continue
        text = f"a{chr(c)} {chr(c)}{chr(c)}1 b"
        assert np.frombuffer(next(CODEC.encode([text])), "<u4").tolist() == WANT.encode_ordinary(text), hex(c)


def test_bytes_have_characters_of_their_own():
    chars = byte_pairs.byte_characters()
    assert len(set(chars)) == 256 and all(not c.isspace() for c in chars) and chars[65] == "A"


def test_other_rank_file():
    tokens = byte_pairs.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    want = tiktoken.Encoding("x", pat_str=public.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    text = "Ähnliche Texte auf Deutsch, français, 日本語 и по-русски."
    assert np.frombuffer(next(byte_pairs.Codec(tokens, public.PATTERN).encode([text])), "<u4").tolist() == want.encode_ordinary(text)


def test_ranks_with_gaps_are_refused(tmp_path):
    (tmp_path / "v").write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_pairs.read_ranks(str(tmp_path / "v"))


def test_odd_rows(spark):
    docs = cases.frame(spark)
    encoded = byte_pairs.encode(docs, TOKENS, public.PATTERN)
    decoded = byte_pairs.decode(encoded, TOKENS, public.PATTERN).collect()
    texts = sorted(((r[0] or -1), (r[1] or "").encode()) for r in cases.rows())
    assert sorted((r.doc_id or -1, bytes(r.content)) for r in decoded) == texts
    digests = {r.doc_id: r for r in byte_pairs.digests(docs, TOKENS, public.PATTERN).collect()}
    for doc_id, text, *_ in cases.rows():
        ids = WANT.encode_ordinary(text or "")
        r = digests[doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    coded = byte_pairs.coded(docs, TOKENS, public.PATTERN).drop("ids").collect()
    assert sorted(map(str, coded)) == sorted(map(str, byte_pairs.digests(docs, TOKENS, public.PATTERN).collect()))
    for f in (byte_pairs.encode, byte_pairs.coded, byte_pairs.digests):
        assert f(cases.empty(spark), TOKENS, public.PATTERN).count() == 0


def test_long_runs_do_not_pile_up():
    import random

    codec = byte_pairs.Codec(TOKENS, public.PATTERN, remembered=4 << 20)
    rng = random.Random(2)
    for _ in range(12):
        text = "".join(rng.choice("abcdefgh") for _ in range(200_000))
        (packed,) = codec.encode([text])
        assert codec.decode(packed).decode() == text
        # one text is held whole; what came before goes
        assert sum(len(k) + len(v) for k, v in codec.known.items()) <= codec.held <= codec.remembered
