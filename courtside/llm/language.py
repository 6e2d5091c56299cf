"""Languages of mixed texts: script ranges, per-word scores, Viterbi with a switching penalty.

Training counts letter trigrams (word ends included) per language, hashed to a fixed number of buckets, and letters per
script and language. A word is scored by the trigram model of every language that is written in its script. Over the words
of a text, the best sequence of languages is found in which each change costs a penalty; its runs are the spans, and the
language with most letters is the text's.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from courtside.llm.sending import Sent
from courtside.llm.words import Kept, mix, pieces, text_bytes

BUCKETS = 1 << 16
PENALTY = 9.0
# share of its letters that a language must have in a script to be a candidate there
IN_SCRIPT = 0.001
SMOOTH = 0.02
UNKNOWN = "und"
# bytes of text that are worked on at once: some arrays hold 8 bytes for each
PIECE = 1 << 19

# First code points of script ranges; a range ends where the next one begins.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"),
    (0x2000, "latin"), (0x2C00, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "han"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"),
    (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAB30, "latin"), (0xAB70, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = tuple(sorted({name for _, name in SCRIPTS}))
_STARTS = np.array([start for start, _ in SCRIPTS], np.uint32)
_SCRIPT = np.array([SCRIPT_NAMES.index("han" if name == "kana" else name) for _, name in SCRIPTS], np.int64)

# case is folded below this code point, where the scripts with cases lie
FOLDED = 0x2000
# letters that stand beside letters of any script, such as modifier letters
NEUTRAL = (0x02B0, 0x0370)
# learned languages at most: a model holds BUCKETS numbers for each, here and in every task
LANGUAGES = 256
# languages that a task counts at a time
COUNTED = 32


@dataclass(frozen=True)
class Tables:
    """What the executors need to know about code points, made once on the driver."""

    kinds: bytes  # 0 no part of a word, 1 letter, 2 mark
    lower: bytes

    @staticmethod
    def make() -> Tables:
        kinds = bytes({"L": 1, "M": 2}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x33480))
        fold = [chr(c).lower() for c in range(FOLDED)]
        lower = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(fold)], np.uint32)
        return Tables(kinds, lower.tobytes())


class Letters:
    """Words of letters of some texts, by code points: places, text, script; and a bucket per letter.

    A word is a run of letters of one script.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, tables: Tables):
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
        sizes = np.array([len(t) for t in texts], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = np.frombuffer(tables.kinds, np.uint8)
        kind = kinds[np.minimum(code, len(kinds) - 1)]
        low = code.copy()
        folded = np.flatnonzero(code < FOLDED)
        low[folded] = np.frombuffer(tables.lower, np.uint32)[code[folded]]
        solid = kind > 0
        first, last = solid.copy(), solid.copy()
        if len(code):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            begin = edges[:-1][edges[:-1] < len(code)]
            first[begin] = solid[begin]
            end = edges[1:][edges[1:] > 0] - 1
            last[end] = solid[end]
            self._cut(code, kind, solid, first, last)
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(edges, self.start, "right") - 1
        self.docs = len(texts)
        # the script of a word is that of its first letter; han and kana, which one word may hold, count as one
        self.script = _SCRIPT[np.searchsorted(_STARTS, code[self.start], "right") - 1]
        self.at = np.flatnonzero(solid)
        left = np.where(first[self.at], 0, low[np.maximum(self.at - 1, 0)]).astype(np.uint64)
        right = np.where(last[self.at], 0, low[np.minimum(self.at + 1, max(len(low) - 1, 0))]).astype(np.uint64) if len(low) else left
        key = (left << np.uint64(42)) | (low[self.at].astype(np.uint64) << np.uint64(21)) | right
        self.bucket = (mix(key) % np.uint64(BUCKETS)).astype(np.int64)
        # letters without marks, per word
        self.word = np.repeat(np.arange(len(self.start)), self.end - self.start)
        self.size = np.bincount(self.word, kind[self.at] == 1, len(self.start)).astype(np.int64)

    @staticmethod
    def _cut(code, kind, solid, first, last) -> None:
        """Ends words where the script changes. Marks and neutral letters go with what stands before; han and kana mix."""
        own = (kind == 1) & ~((code >= NEUTRAL[0]) & (code < NEUTRAL[1]))
        at = np.flatnonzero(own)
        if not len(at) or code[at].max() < NEUTRAL[0]:
            return
        script = _SCRIPT[np.searchsorted(_STARTS, code[at], "right") - 1]
        change = np.flatnonzero(script[1:] != script[:-1])
        before, here = at[change], at[change + 1]
        # only within one run of letters: no run starts after the one and up to the other
        starts = np.cumsum(first)
        here = here[starts[before] == starts[here]]
        first[here] = True
        last[here - 1] = True


@dataclass(frozen=True)
class Model:
    """Learned languages with log-probabilities of buckets, and candidates per script."""

    languages: tuple[str, ...]
    weights: np.ndarray  # languages x BUCKETS
    candidates: np.ndarray  # scripts x languages


def learn(documents: DataFrame) -> Model:
    """A model from ``text`` and non-null ``lang`` of all given rows. No rows: no languages.

    Tasks count; at most languages x (BUCKETS + scripts) sums reach the driver. More than ``LANGUAGES`` distinct values of
    ``lang`` are refused with a ValueError: such a column does not hold languages, and the model would not fit. A language
    with less than ``IN_SCRIPT`` of its letters in a script is never a candidate there.
    """
    tables = Tables.make()
    if documents.select("lang").where("lang is not null").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"the column lang has more than {LANGUAGES} values")

    def told(codes, grams, scripts):
        names = list(codes)
        for offset, table in ((0, grams), (BUCKETS, scripts)):
            i, j = np.nonzero(table)
            yield pa.record_batch(
                [pa.array([names[x] for x in i], pa.string()), pa.array(j + offset), pa.array(table[i, j])], ["lang", "place", "n"]
            )

    def count(batches):
        codes: dict[str, int] = {}
        grams, scripts = np.zeros((0, BUCKETS), np.int64), np.zeros((0, len(SCRIPT_NAMES)), np.int64)
        for whole in batches:
            names = whole.column(1).unique().to_pylist()
            for at in range(0, len(names), COUNTED):
                some = names[at : at + COUNTED]
                batch = whole if len(names) <= COUNTED else whole.filter(pc.is_in(whole.column(1), pa.array(some, pa.string())))
                if len(set(codes).union(some)) > COUNTED:
                    yield from told(codes, grams, scripts)
                    codes, grams, scripts = {}, grams[:0], scripts[:0]
                new = [x for x in some if x not in codes]
                codes.update(zip(new, range(len(codes), len(codes) + len(new))))
                grams = np.concatenate([grams, np.zeros((len(new), BUCKETS), np.int64)])
                scripts = np.concatenate([scripts, np.zeros((len(new), len(SCRIPT_NAMES)), np.int64)])
                lang = np.array([codes[x] for x in batch.column(1).to_pylist()], np.int64)
                data, bounds = text_bytes(batch.column(0))
                for i, j in pieces(bounds, PIECE):
                    w = Letters(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], tables)
                    of = lang[i:j][w.doc]
                    grams += np.bincount(of[w.word] * BUCKETS + w.bucket, minlength=grams.size).reshape(grams.shape)
                    scripts += np.bincount(of * len(SCRIPT_NAMES) + w.script, w.size, scripts.size).astype(np.int64).reshape(scripts.shape)
        yield from told(codes, grams, scripts)

    rows = documents.where(F.col("lang").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    found = rows.mapInArrow(count, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    lang, place, n = (found[c].to_numpy(zero_copy_only=False) for c in ("lang", "place", "n"))
    languages = tuple(sorted(set(lang)))
    code = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)))
    np.add.at(counts, (np.array([code[x] for x in lang], np.int64), place.astype(np.int64)), n)
    grams, scripts = counts[:, :BUCKETS] + SMOOTH, counts[:, BUCKETS:]
    weights = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, weights, (share >= IN_SCRIPT).T)


def word_scores(w: Letters, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores words x languages, and which languages are candidates of each word.

    Only candidates are scored; other languages get the worst score of the word less three penalties, so that changing to a
    candidate and back is better. A word in a script that no language uses scores 0 throughout.
    """
    candidate = model.candidates[w.script]
    scores = np.zeros((len(w.start), len(model.languages)), np.float32)
    length = w.end - w.start
    for script in np.unique(w.script):
        here = np.flatnonzero(w.script == script)
        use = np.flatnonzero(model.candidates[script])
        if not len(use):
            continue
        one = len(here) == len(w.start)
        bucket = w.bucket if one else w.bucket[np.repeat(w.script == script, length)]
        ends = np.cumsum(length[here])
        for lang in use:
            sums = np.concatenate([[0.0], np.cumsum(model.weights[lang][bucket], dtype=np.float64)])
            scores[here, lang] = sums[ends] - sums[ends - length[here]]
        rest = np.flatnonzero(~model.candidates[script])
        if len(rest):
            scores[np.ix_(here, rest)] = (scores[np.ix_(here, use)].min(axis=1) - 3 * PENALTY)[:, None]
    return scores, candidate


def best_path(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Language of every word: the best sequence of each text, a change costing ``penalty``.

    ``counts`` are the words of each text, in order. All texts advance one word at a time together, longest first.
    """
    begin = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    begin, counts = begin[order], counts[order]
    longest = int(counts[0]) if len(counts) else 0
    alive = np.searchsorted(-counts, -np.arange(longest), "left")
    n, states = scores.shape
    stay, best = np.zeros((n, states), bool), np.zeros(n, np.int16)
    path = np.zeros(n, np.int16)
    value = np.zeros((len(counts), states), np.float64)
    for t in range(longest):
        a = alive[t]
        at = begin[:a] + t
        now = value[:a]
        if t:
            top = now.argmax(axis=1)
            other = now[np.arange(a), top][:, None] - penalty
            stay[at] = now >= other
            best[at] = top
            now = np.maximum(now, other)
        value[:a] = now + scores[at]
    last = value.argmax(axis=1)
    state = np.zeros(len(counts), np.int64)
    for t in range(longest - 1, -1, -1):
        a = alive[t]
        at = begin[:a] + t
        more = alive[t + 1] if t + 1 < longest else 0
        state[more:a] = last[more:a]
        path[at] = state[:a]
        state[:a] = np.where(stay[at, state[:a]], state[:a], best[at])
    return path


def label(documents: DataFrame, model: Model, penalty: float = PENALTY, *keep: str, shares: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` and the columns named in ``keep``, one row per row of ``documents``.

    ``score`` is the share of the letters that stand in spans of the predicted language and in a script it uses. ``spans``
    lists (first word, last word, language) over words of letters. With ``shares`` there is ``learned`` after ``score``: the
    share of the letters in spans of any language and in a script that one uses.

    Only ``doc_id``, ``text`` and kept columns are read. Null, empty and letterless texts, and all texts if nothing was
    learned: ``und`` with shares 0 and no spans. Long texts are labelled whole; of equally frequent languages the first by
    name wins; a text without any known script gets the first language with score 0; repeated rows and null ids give rows
    like any other; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    sent = Sent(spark, (Tables.make(), model))
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())]))
    sender = Kept(documents, keep)

    def work(batches):
        tables, model = sent.value
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for i, j in pieces(bounds, PIECE):
                w = Letters(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], tables)
                pred, score, learned, spans = _labelled(w, model, penalty)
                part = batch.slice(i, j - i)
                yield sender.batch(part, lang_pred=pa.array(pred, pa.string()), score=pa.array(score), **({"learned": pa.array(learned)} if shares else {}), spans=pa.array(spans, span))

    kinds = "lang_pred string, score double, " + "learned double, " * shares
    return sender.run(work, kinds + "spans array<struct<first: long, last: long, lang: string>>")


def _labelled(w: Letters, model: Model, penalty: float):
    languages = len(model.languages)
    counts = np.bincount(w.doc, minlength=w.docs)
    if not languages or not len(w.start):
        return [UNKNOWN] * w.docs, np.zeros(w.docs), np.zeros(w.docs), [[]] * w.docs
    scores, candidate = word_scores(w, model)
    path = best_path(scores, counts, penalty)
    known = w.size * candidate[np.arange(len(path)), path]
    letters = np.bincount(w.doc * languages + path, known, w.docs * languages).reshape(w.docs, languages)
    total = np.bincount(w.doc, w.size, w.docs)
    top = letters.argmax(axis=1)
    score = letters[np.arange(w.docs), top] / np.maximum(total, 1)
    learned = letters.sum(axis=1) / np.maximum(total, 1)
    pred = [model.languages[x] if n else UNKNOWN for x, n in zip(top, total)]
    turn = np.ones(len(path), bool)
    turn[1:] = (path[1:] != path[:-1]) | (w.doc[1:] != w.doc[:-1])
    first = np.flatnonzero(turn)
    last = np.concatenate([first[1:], [len(path)]]) - 1
    begin = np.cumsum(counts) - counts
    spans: list[list] = [[] for _ in range(w.docs)]
    for a, b in zip(first.tolist(), last.tolist()):
        d = w.doc[a]
        spans[d].append({"first": int(a - begin[d]), "last": int(b - begin[d]), "lang": model.languages[path[a]]})
    return pred, score, learned, spans


def remainder(doc_id, n: int):
    """crc32 of an id as text, modulo n; that of a null id is 0."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def languages(documents: DataFrame) -> DataFrame:
    """Labels of all rows by a model of those whose remainder by 4 is not 2: ``doc_id, held_out, lang_pred, score``.

    One row per row; only ``doc_id``, ``text`` and ``lang`` are read, whatever other columns there are. Null, empty and
    letterless texts are ``und`` with score 0, and so is every text if nothing was learned; long texts count whole; repeated
    rows and null ids (remainder 0) give rows like any other; ties go to the first language by name; an empty table gives an
    empty result. More than ``LANGUAGES`` values of ``lang`` are refused.
    """
    model = learn(documents.where(remainder(F.col("doc_id"), 4) != 2))
    held = remainder(F.col("doc_id"), 4) == 2
    return label(documents, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
