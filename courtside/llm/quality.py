"""Quality of texts: random Fourier features, ridge regression, isotonic calibration.

Whole texts become a few statistics, these become cosines of random projections that approximate a Gaussian kernel, and a
ridge regression on them is solved from normal equations that tasks sum. A second part of the labelled rows calibrates
the result: its scores are counted in fixed bins and made monotone by pooling adjacent violators.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from courtside.llm.language import remainder
from courtside.llm.sending import Sent
from courtside.llm.words import Kept, byte_set, find_words, pieces, shingles, text_bytes
from courtside.session import settle

FEATURES = 192
RIDGE = 1e-3
WIDTH = 2.5
BINS = 2000
SEED = 3
LEAST = 0.3

_UPPER, _DIGIT, _STOP = byte_set((65, 90)), byte_set((48, 57)), byte_set((46, 46))
_LETTER = byte_set((65, 90), (97, 122), (128, 255))
# ASCII signs that are rare in running text: all but blanks . , ' - ( ) ; : and quotes
_SIGN = byte_set((33, 33), (35, 38), (42, 43), (47, 47), (60, 64), (91, 96), (123, 126))
_LINE = byte_set((10, 10))

STATISTICS = (
    "size", "words", "word_length", "word_spread", "long_words", "upper", "digits", "signs", "other", "stops", "distinct",
    "top_word", "repeats", "copied", "signed_words", "lines", "line_repeats", "letters", "upper_words",
)


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts x STATISTICS of the texts between ``bounds``. All are finite, for empty texts too."""
    docs = len(bounds) - 1
    size = np.diff(bounds).astype(np.float64)
    some = np.maximum(size, 1)
    w = find_words(data, bounds)
    length = (w.end - w.start).astype(np.float64)
    n = np.maximum(w.counts, 1)

    def share(table):
        return _per_text(table[data], bounds) / some

    def mean(values):
        return np.bincount(w.doc, values, docs) / n

    word_length = mean(length)
    spread = np.sqrt(np.maximum(mean(np.square(length)) - np.square(word_length), 0))
    order = np.lexsort((w.hash, w.doc))
    doc, value = w.doc[order], w.hash[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    often = np.diff(np.concatenate([first, [len(doc)]]))
    top = np.zeros(docs)
    np.maximum.at(top, doc[first], often)
    distinct = np.bincount(doc[first], minlength=docs)
    again = np.zeros(len(w.hash))
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    grams = np.bincount(shingles(w, 3)[0], minlength=docs)
    closing = data[np.maximum(w.end - 1, 0)] if len(w.end) else np.zeros(0, np.uint8)
    ending = _SIGN[closing].astype(np.float64)
    opening = _UPPER[data[w.start]].astype(np.float64)
    lines = find_words(data, bounds, _LINE)
    line_order = np.lexsort((lines.hash, lines.doc))
    ld, lv = lines.doc[line_order], lines.hash[line_order]
    same = np.zeros(len(ld))
    same[1:] = (ld[1:] == ld[:-1]) & (lv[1:] == lv[:-1])
    line_count = np.maximum(lines.counts, 1)
    return np.column_stack([
        np.log1p(size) / 10, np.log1p(w.counts) / 8, np.minimum(word_length, 40) / 10, np.minimum(spread, 40) / 10,
        mean(length > 20), share(_UPPER), share(_DIGIT), share(_SIGN), share(~(_LETTER | _DIGIT | _SIGN)),
        _per_text(_STOP[data], bounds) / n, np.log1p(distinct) / np.log1p(n), top / n, mean(again),
        1 - grams / np.maximum(w.counts - 2, 1).clip(1) * (w.counts > 2) - (w.counts <= 2), mean(ending),
        np.log1p(size / line_count) / 10, np.bincount(ld, same, docs) / line_count, share(_LETTER), mean(opening),
    ])


def measured(documents: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, stats`` and the columns named in ``keep``, one row per row; null texts count as empty."""

    sender = Kept(documents, keep)

    def work(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for i, j in pieces(bounds):
                table = statistics(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                flat = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1]).cast(pa.list_(pa.float64()))
                yield sender.batch(batch.slice(i, j - i), stats=flat)

    return sender.run(work, "stats array<double>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    # calibrated values over the bins of raw scores; None where nothing was learned
    curve: np.ndarray | None

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = math.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(stats), 0.5)
        return np.interp(np.clip(self.raw(stats), 0, 1), (np.arange(BINS) + 0.5) / BINS, self.curve)


def _stats(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def pooled(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Monotone non-decreasing fit of values by pooling adjacent violators; places without weight are interpolated."""
    places = np.flatnonzero(weight > 0)
    blocks: list[list[float]] = []  # weight, mean, members
    for p in places:
        blocks.append([weight[p], value[p], 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, c2 = blocks.pop()
            w1, m1, c1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), c1 + c2])
    fit = np.concatenate([np.full(int(c), m) for _, m, c in blocks])
    return np.interp(np.arange(len(weight)), places, fit)


def learn(rows: DataFrame, calibrates: Column, features: int = FEATURES, ridge: float = RIDGE, width: float = WIDTH) -> Model:
    """A model from rows of ``stats`` and ``quality`` (0 or 1). Rows where ``calibrates`` holds only fit the calibration.

    To the driver go one row of moments, the normal equations ((features + 1)^2 sums) and two counts per bin.
    """
    spark = rows.sparkSession
    count = len(STATISTICS)
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((count, features)) / (width * math.sqrt(count)) * 2
    phases = rng.uniform(0, 2 * math.pi, features)
    rows = rows.where(F.col("quality").isin(0, 1)).select("stats", F.col("quality").cast("double").alias("quality"), calibrates.alias("calibrates"))
    x = [F.get("stats", F.lit(i)) for i in range(count)]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(x) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    empty = Model(np.zeros(count), np.ones(count), directions, phases, np.zeros(features + 1), None)
    if not sums["n"]:
        return empty
    mean = np.array([sums[f"m{i}"] for i in range(count)])
    scale = np.maximum([sums[f"s{i}"] for i in range(count)], 1e-6)
    model = Model(mean, scale, directions, phases, empty.weights, None)
    size = features + 2

    def equations(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for s in range(0, batch.num_rows, 4096):
                part = batch.slice(s, 4096)
                z = np.column_stack([model.features(_stats(part.column("stats"))), part.column("quality").to_numpy()])
                total += z.T @ z
        i, j = np.nonzero(np.triu(total))
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    fits = rows.where(~F.col("calibrates"))
    found = fits.mapInArrow(equations, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    gram = np.zeros((size, size))
    i, j, v = (found[c].to_numpy() for c in "ijv")
    gram[i, j] = gram[j, i] = v
    n = max(gram[size - 2, size - 2], 1)
    left = gram[:-1, :-1] + ridge * n / features * np.eye(size - 1)
    left[-1, -1] = max(gram[-2, -2], 1)
    weights = np.linalg.solve(left, gram[:-1, -1])
    model = Model(mean, scale, directions, phases, weights, None)

    def bins(batches):
        totals = np.zeros((2, BINS))
        for batch in batches:
            at = np.clip((np.clip(model.raw(_stats(batch.column("stats"))), 0, 1) * BINS).astype(np.int64), 0, BINS - 1)
            totals += [np.bincount(at, minlength=BINS), np.bincount(at, batch.column("quality").to_numpy(), BINS)]
        at = np.flatnonzero(totals[0])
        yield pa.record_batch([pa.array(at), pa.array(totals[0, at]), pa.array(totals[1, at])], ["bin", "n", "good"])

    def counted(part):
        return part.mapInArrow(bins, "bin long, n double, good double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toArrow()

    found = counted(rows.where("calibrates"))
    if not found.num_rows:  # too few labels for a part of their own
        found = counted(rows)
    at, n, good = (found[c].to_numpy() for c in ("bin", "n", "good"))
    weight, value = np.zeros(BINS), np.zeros(BINS)
    weight[at], value[at] = n, good / n
    return Model(mean, scale, directions, phases, weights, pooled(weight, value))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` (0 to 1) to rows of ``stats``, which leaves; other columns stay."""
    spark = rows.sparkSession
    sent = Sent(spark, model)
    at = rows.columns.index("stats")

    def work(batches):
        model = sent.value
        for batch in batches:
            score = model.score(_stats(batch.column(at))) if batch.num_rows else np.zeros(0)
            yield batch.append_column("score", pa.array(score)).drop_columns(["stats"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "stats")
    return rows.mapInArrow(work, f"{kinds}, score double")


def train(stats: DataFrame, labels: DataFrame) -> Model:
    """A model from measured documents and ``labels`` (doc_id, quality), without ids whose remainder by 5 is 0.

    Ids whose remainder is 4 calibrate. Of several labels of an id the largest counts; null labels do not.
    """
    known = labels.where(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), 5) != 0)).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max("quality").alias("quality"))
    rows = settle(stats.select("doc_id", "stats").join(known, "doc_id"), "labelled")
    return learn(rows, remainder(F.col("doc_id"), 5) == 4)


def quality(documents: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``documents``.

    Scores use the text alone; other columns, whatever their names, play no part.

    * null texts count as empty and are scored like any other; long texts are measured whole;
    * ties and repeated rows: equal texts have equal scores; each row gives a row; a null ``doc_id`` is kept;
    * without usable labels every score is 0.5; an empty table gives an empty result.
    """
    stats = settle(measured(documents), "stats")
    out = scored(stats, train(stats, labels))
    return out.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
