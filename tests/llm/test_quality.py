from __future__ import annotations

import numpy as np
import pyarrow as pa

from courtside.llm import quality
from courtside.llm.words import text_bytes
from tests.llm import cases

SF = "/root/testdata/sf0.1"


def test_held_out_labels_of_the_given_table(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.quality(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == docs.count() and len(held) > 500
    good, bad = (np.array([s for s, y, _ in held if y == label]) for label in (1, 0))
    assert ((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean() > 0.97
    assert np.mean([y == p for _, y, p in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    # calibrated: the mean score is the share of good texts
    assert abs(np.mean([s for s, *_ in held]) - np.mean([y for _, y, _ in held])) < 0.05


def test_labels_of_the_held_out_part_change_nothing(spark):
    from pyspark.sql import functions as F

    from courtside.llm.language import remainder

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(remainder(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string"))
    assert {(r.doc_id, r.score) for r in quality.quality(docs, labels).collect()} == {(r.doc_id, r.score) for r in quality.quality(changed, other).collect()}


def test_features_approach_the_kernel():
    rng = np.random.default_rng(1)
    count = len(quality.STATISTICS)
    width, features = 2.5, 20_000
    directions = rng.standard_normal((count, features)) / (width * np.sqrt(count)) * 2
    model = quality.Model(np.zeros(count), np.ones(count), directions, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), None)
    x = rng.standard_normal((6, count))
    z = model.features(x)[:, :-1]
    far = np.square(x[:, None] - x[None]).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-far * 4 / (2 * width**2 * count))).max() < 0.05


def test_pooling_adjacent_violators():
    weight, value = np.array([1.0, 2, 0, 1, 4, 1]), np.array([0.2, 0.6, 0, 0.3, 0.5, 0.9])
    assert np.allclose(quality.pooled(weight, value), [0.2, *[(1.2 + 0.3 + 2.0) / 7] * 4, 0.9])
    assert (np.diff(quality.pooled(np.ones(50), np.random.default_rng(0).random(50))) >= -1e-12).all()


def test_statistics_are_finite_and_of_the_whole_text():
    texts = ["", None, " ", "A", "a b a b a b", "X!! " * 50, "line\nline\nline\n", cases.LONG, cases.LONG + " !!! ###" * 20_000]
    data, bounds = text_bytes(pa.array(texts))
    got = quality.statistics(data, bounds)
    assert got.shape == (len(texts), len(quality.STATISTICS)) and np.isfinite(got).all()
    assert got[-1][quality.STATISTICS.index("signs")] > 0.05 > got[-2][quality.STATISTICS.index("signs")]
    line = quality.STATISTICS.index("line_repeats")
    assert np.isclose(got[6][line], 2 / 3) and got[4][line] == 0


def test_odd_rows(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, 0, 0), (4, 0, 0), (4, None, 0), (6, None, 0), (9, 1, 0), (9, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == len(cases.rows()) and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.score for r in rows}
    assert got[1] == got[2] and got[3] == got[4]
    none = quality.quality(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.quality(cases.empty(spark), labels).count() == 0
