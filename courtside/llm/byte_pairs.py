"""Byte-level BPE through a sentencepiece model that is serialised from a rank vocabulary.

Every byte has a printable character of its own; a vocabulary entry becomes a piece of such characters whose score is
its negative rank, so that the best-scored merge is the merge of lowest rank. The normaliser is the identity. Text is
cut by a pattern, each pre-token is encoded alone, and ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# bytes of pre-tokens and their ids that a task remembers; it then starts afresh
REMEMBERED = 32 << 20
# what an entry takes besides: two objects and their place in the table
ENTRY = 200


def byte_characters() -> list[str]:
    """The character of each byte: itself where it is printable, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in out:
            out[b], more = chr(more), more + 1
    return [out[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of ``base64 rank`` lines. A vocabulary, so of bounded size."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [base64.b64decode(token) for token, _ in sorted(pairs, key=lambda p: int(p[1]))]
    if [int(r) for _, r in sorted(pairs, key=lambda p: int(p[1]))] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return tokens


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol buffer field: whole number, 32-bit float or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model: piece i is token i, its score -i; one unknown piece, never met, stands last."""
    # Field numbers and codes of sentencepiece's published model format.
    normal, unknown, bpe = 1, 2, 2
    chars = byte_characters()
    pieces = [
        _field(1, "".join(chars[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, normal)
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts to packed little-endian 32-bit ids, and ids to bytes."""

    def __init__(self, tokens: list[bytes], pattern: str, remembered: int = REMEMBERED):
        import regex
        import sentencepiece

        self.tokens, self.split, self.remembered = tokens, regex.compile(pattern).findall, remembered
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        # a pre-token that is itself an entry is that entry
        self.whole = {token: struct.pack("<I", rank) for rank, token in enumerate(tokens)}
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            parts = self.split(text)
            distinct, known = set(parts), self.known
            new = [p for p in distinct if p not in known]
            if new:
                # a letter takes four bytes at most, and an id of four bytes stands for a byte at least
                more = sum(ENTRY + 8 * len(p) for p in new)
                if self.held + more > self.remembered and known:
                    known = self.known = {}
                    self.held = 0
                    new = list(distinct)
                    more = sum(ENTRY + 8 * len(p) for p in new)
                self._learn(new)
                self.held += more
            yield b"".join([known[p] for p in parts])

    def _learn(self, parts: list[str]) -> None:
        raw = [p.encode() for p in parts]
        found = [self.whole.get(r) for r in raw]
        rest = [i for i, f in enumerate(found) if f is None]
        ids = self.model.encode([raw[i].decode("latin-1").translate(self.letters) for i in rest], num_threads=1) if rest else []
        for i, one in zip(rest, ids):
            found[i] = np.array(one, "<u4").tobytes()
        self.known.update(zip(parts, found))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _texts(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


def _each(tokens: list[bytes], pattern: str, work):
    """A function over Arrow batches with one codec per task; the vocabulary travels with it."""

    def run(batches):
        codec = Codec(tokens, pattern)
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), 256):
                yield work(codec, batch.slice(at, 256))

    return run


def encode(documents: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids``: ids as little-endian unsigned 32-bit integers, one row per row of ``documents``.

    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, play no part. Null and empty texts give
    no ids, long texts are encoded whole, a null id stays null, repeated rows each give a row, an empty table none.
    """

    def work(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = list(codec.encode(_texts(batch.column(1))))
        counts = pa.array([len(p) // 4 for p in packed], pa.int64())
        return pa.record_batch([batch.column(0), counts, pa.array(packed, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return _plain(documents).mapInArrow(_each(tokens, pattern, work), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """``doc_id, content``: the bytes of rows made by ``encode``. Null ids give no bytes."""

    def work(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        content = [codec.decode(p or b"") for p in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(content, pa.binary())], ["doc_id", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(_each(tokens, pattern, work), "doc_id long, content binary")


def coded(documents: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256``: encodes, decodes the ids again, and digests both, in one pass."""

    def work(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = list(codec.encode(_texts(batch.column(1))))
        return pa.record_batch(
            [
                batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array([hashlib.sha256(codec.decode(p)).hexdigest() for p in packed], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
        )

    return _plain(documents).mapInArrow(
        _each(tokens, pattern, work), "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
    )


def digests(documents: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``coded``; the ids stay in the task that made them."""

    def work(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, ids, content = [], [], []
        for packed in codec.encode(_texts(batch.column(1))):
            counts.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            content.append(hashlib.sha256(codec.decode(packed)).hexdigest())
        return pa.record_batch(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(content, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _plain(documents).mapInArrow(
        _each(tokens, pattern, work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
