from __future__ import annotations

import corpus_pipeline as pipeline
import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

from courtside.llm.byte_pairs import read_ranks
from courtside.session import fresh_path
from tests.llm import cases
from tests.llm.test_near_documents import groups_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the smallest tables, with odd documents among them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = cases.frame(spark).selectExpr(
        "doc_id + 100000 as doc_id", "text", "cast(null as string) lang", "source", "n_chars"
    )
    docs = docs.unionByName(odd)
    out = []
    for name, stage in pipeline.STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return {name: (before, after) for name, before, after in out}


def test_order_and_columns(stages):
    assert list(stages) == ["language", "quality", "near-copies", "mixing", "encoding"]
    for name, (before, after) in stages.items():
        if name != "encoding":
            assert after.schema.simpleString() == before.schema.simpleString()


def test_letterless_texts_go_and_clean_ones_stay(stages):
    before, after = stages["language"]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert gone == {100003, 100004, 100005, 100008, 100013}


def test_a_text_in_many_learned_languages_stays(spark):
    words = {lang: [f"{c}{x}{c}{y}{c}" for x in "aeiou" for y in "aeiou"] for lang, c in zip(("l1", "l2", "l3", "l4", "l5", "l6"), "bdgkmt")}
    rows = [(i, " ".join(w * 20), lang) for i, (lang, w) in enumerate(words.items())]
    rows += [(10, " ".join(" ".join(w) for w in words.values()), None), (11, "привет мир " * 9, None), (12, "привет мир " * 9 + "babab", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in pipeline.by_language(spark, docs, SF).collect()} == {0, 1, 2, 3, 4, 5, 10}


def test_bad_texts_go_and_good_ones_stay(spark, stages):
    before, after = stages["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    judged = [(d, labels[d]) for d in (r.doc_id for r in before.collect()) if d in labels]
    assert sum((d in kept) == bool(q) for d, q in judged) >= 0.95 * len(judged)


def test_one_of_each_group_stays(stages):
    before, after = stages["near-copies"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want, _ = groups_of([r for r in rows if r[0] is not None], k=5)
    kept = [r.doc_id for r in after.collect()]
    assert sorted(d for d in kept if d is not None) == sorted({d for d in want if want[d] == d})
    assert sum(d is None for d in kept) == sum(d is None for d, _ in rows)


def test_mix_repeats_rows(stages):
    before, after = stages["mixing"]
    names = {r.doc_id for r in before.collect()}
    counts = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert set(counts) <= names and max(counts.values()) <= 3


def test_encoding_is_that_of_the_library(stages):
    before, after = stages["encoding"]
    want = tiktoken.Encoding("x", pat_str=public.PATTERN, special_tokens={}, mergeable_ranks={t: i for i, t in enumerate(read_ranks(public.path("byte_bpe_50k.tiktoken")))})
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows[:80]:
        assert np.frombuffer(r.ids, "<u4").tolist() == want.encode_ordinary(texts[r.doc_id] or "")
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_empty_documents_and_registration(spark):
    import __spark_entry__ as entry

    docs = cases.empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
