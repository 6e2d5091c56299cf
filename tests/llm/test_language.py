from __future__ import annotations

import itertools

import numpy as np
import pytest

from courtside.llm import language
from courtside.llm.words import text_bytes
from tests.llm import cases

SF = "/root/testdata/sf0.01"
RUSSIAN = "привет это простой текст на русском языке и он нужен для проверки"


def test_best_path_equals_trying_all():
    rng = np.random.default_rng(3)
    counts = np.array([3, 0, 5, 1])
    scores = rng.standard_normal((9, 3)).astype(np.float32) * 3
    got = language.best_path(scores, counts, 2.0)
    at = 0
    for n in counts:
        if n:
            def worth(p):
                return sum(scores[at + i, s] for i, s in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
            assert abs(worth(got[at : at + n]) - max(worth(p) for p in itertools.product(range(3), repeat=int(n)))) < 1e-5
        at += n


def test_held_out_texts_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_spans_and_scripts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").union(spark.createDataFrame([(RUSSIAN, "ru")] * 3, "text string, lang string"))
    model = language.learn(docs)
    assert "ru" in model.languages
    by_lang = {r.lang: r.text for r in docs.where("length(text) > 400").dropDuplicates(["lang"]).collect()}
    de, fr = (" ".join(by_lang[x].split()[:60]) for x in ("de", "fr"))
    texts = [(1, f"{de} {fr}"), (2, f"{de} {RUSSIAN}"), (3, RUSSIAN.upper()), (4, "αβγδε"), (5, "12 ... 34"), (6, f"{fr} 日本語")]
    got = {r.doc_id: r for r in language.label(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    runs = [s.lang for s in got[1].spans]
    assert runs[0] == "de" and runs[-1] == "fr" and len(runs) <= 6 and 0.3 < got[1].score < 0.75
    # no word in Latin letters can be Russian, and none in Cyrillic letters anything else
    assert [s.lang for s in got[2].spans] == ["de", "ru"]
    assert got[3].lang_pred == "ru" and got[3].score == 1
    assert got[4].lang_pred in model.languages and got[4].score == 0
    assert got[5].lang_pred == "und" and got[6].lang_pred == "fr" and got[6].score < 1


def test_letters_of_texts():
    data, bounds = text_bytes(__import__("pyarrow").array(["Ab, cD1e", "", "é-नमस्ते"]))
    w = language.Letters(data, bounds, language.Tables.make())
    assert np.bincount(w.doc, minlength=3).tolist() == [3, 0, 2]
    assert w.size.tolist()[:4] == [2, 2, 1, 1]


def test_words_end_where_the_script_changes(spark):
    data, bounds = text_bytes(__import__("pyarrow").array(["日本語English", "русскийenglish", "カナ漢字かな", "об\u02bcєкт", "ne\u0301e", "abcабв гдеabc"]))
    w = language.Letters(data, bounds, language.Tables.make())
    assert np.bincount(w.doc, minlength=6).tolist() == [2, 2, 1, 1, 1, 4]
    assert w.size.tolist() == [3, 7, 7, 7, 6, 6, 3, 3, 3, 3, 3]
    names = [language.SCRIPT_NAMES[i] for i in w.script]
    assert names[:4] == ["han", "latin", "cyrillic", "latin"] and names[-4:] == ["latin", "cyrillic", "cyrillic", "latin"]
    rows = [("これは日本語の文章です漢字とかな", "ja"), ("this is an English text of some words", "en")] * 3
    model = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    got = language.label(spark.createDataFrame([(1, "日本語English")], "doc_id long, text string"), model).first()
    assert [(s.first, s.last, s.lang) for s in got.spans] == [(0, 0, "ja"), (1, 1, "en")] and got.lang_pred == "en" and abs(got.score - 0.7) < 1e-9


def test_many_languages_are_counted_apart_or_refused(spark, monkeypatch):
    rows = [(f"word{'abcdefghij'[i % 10]} {'xyz'[i % 3] * 3} text", f"l{i % 70:02}") for i in range(280)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    whole = language.learn(docs.repartition(1))
    monkeypatch.setattr(language, "COUNTED", 200)
    assert np.array_equal(whole.weights, language.learn(docs).weights) and len(whole.languages) == 70
    with pytest.raises(ValueError, match="256"):
        language.learn(spark.range(5000).selectExpr("'some text' text", "cast(id as string) lang"))


def test_odd_rows(spark):
    rows = language.languages(cases.frame(spark)).collect()
    assert len(rows) == len(cases.rows())
    got = {r.doc_id: r for r in rows}
    assert [got[i].lang_pred for i in (3, 4, 5, 8)] == ["und"] * 4 and got[12].lang_pred == "de" and got[9].lang_pred == "en"
    assert language.languages(cases.empty(spark)).count() == 0
    unlabelled = cases.frame(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {(r.lang_pred, r.score) for r in language.languages(unlabelled).collect()} == {("und", 0.0)}
    kept = language.label(cases.frame(spark), language.learn(cases.frame(spark)), language.PENALTY, "text", "label", "size")
    assert kept.columns == ["doc_id", "lang_pred", "score", "spans", "text", "label", "size"] and kept.where("size = 3").count() == len(cases.rows())
