"""Words and shingles of many texts at once, as numpy arrays over the bytes of an Arrow column.

Texts are read as UTF-8 bytes. A-Z become a-z, other bytes stay. Words and shingles are carried as
64-bit hashes: a polynomial over the bytes, so that one cumulative sum gives every word of a batch,
then a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# bytes of text that are worked on at once; a longer text is worked on alone
PIECE = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of the bytes in the given ranges, both ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: what stands between the words `[^\x20\x09-\x0D]+`
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, PIECE + 1)
        steps = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        for step in steps:
            step[0] = 1
        _powers, _inverse = (np.cumprod(step, dtype=np.uint64) for step in steps)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 places where its texts begin and end. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``size`` bytes together, or a single longer text."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        last = min(last, n)
        yield first, last
        first = last


@dataclass
class Words:
    """Words in order of place: first byte, end, text they stand in, hash; and words per text."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    counts: np.ndarray


def find_words(data: np.ndarray, bounds: np.ndarray, blanks: np.ndarray = BLANKS) -> Words:
    """Words of the texts between ``bounds``: runs of bytes that are not in ``blanks``."""
    n, docs = len(data), len(bounds) - 1
    low = LOWER[data]
    solid = ~blanks[low]
    first, last = solid.copy(), solid.copy()
    if n:
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        begin = bounds[:-1][bounds[:-1] < n]
        first[begin] = solid[begin]
        end = bounds[1:][bounds[1:] > 0] - 1
        last[end] = solid[end]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(bounds, start, "right") - 1
    _grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _inverse[start])
    return Words(low, start, end, doc, hashes, np.bincount(doc, minlength=docs))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles as (text, hash), sorted. A text of fewer words is one shingle; without words none."""
    h, doc, counts = words.hash, words.doc, words.counts
    begin = np.cumsum(counts) - counts
    docs, found = [], []
    for length in range(1, k + 1):
        if length == k:
            at = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
        else:
            at = begin[counts == length]
        value = np.full(len(at), length, np.uint64)
        for i in range(length):
            value = mix(value * np.uint64(0x9DDFEA08EB382D69) + h[at + i])
        docs.append(doc[at])
        found.append(value)
    doc, value = np.concatenate(docs), np.concatenate(found)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


class Kept:
    """Sends ``doc_id`` and ``text`` to Arrow functions, and brings named columns back beside their results.

    Kept columns travel under names of their own, so results may be called like any of them; the text travels once.
    """

    def __init__(self, documents: DataFrame, keep: tuple[str, ...] = ()):
        self.keep = tuple(keep)
        self.moved = [c for c in keep if c != "text"]
        self.rows = documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
            *[F.col(c).alias(f"kept_{c}") for c in self.moved],
        )
        self.kinds = [f"`kept_{c}` {documents.schema[c].dataType.simpleString()}" for c in self.keep]

    def __getstate__(self):
        return {"keep": self.keep, "moved": self.moved}

    def batch(self, part: pa.RecordBatch, **results: pa.Array) -> pa.RecordBatch:
        """An output batch for a slice of the input: id, results, kept columns."""
        back = [part.column(1) if c == "text" else part.column(2 + self.moved.index(c)) for c in self.keep]
        return pa.record_batch([part.column(0), *results.values(), *back], ["doc_id", *results, *[f"kept_{c}" for c in self.keep]])

    def run(self, work, kinds: str) -> DataFrame:
        """The function over all rows; ``kinds`` are its results' types."""
        out = self.rows.mapInArrow(work, ", ".join(["doc_id long", kinds, *self.kinds]))
        return out.withColumnsRenamed({f"kept_{c}": c for c in self.keep})
