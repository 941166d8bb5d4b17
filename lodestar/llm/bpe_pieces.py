"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Each rank's bytes become a piece of one printable character per byte, scored by the
negative rank, so that sentencepiece merges in rank order; the normaliser is the
identity and nothing is added in front.  Each pre-token is encoded by itself, as a
rank-based byte-level encoder does: one that is a piece as a whole is that piece.
Decoding maps ids to pieces and pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import ship_file

#: Bytes of pre-tokens and of what they encode to that a worker remembers, and the longest pre-token that is worth it.
_CACHE_BYTES = 64 << 20
_CACHED_WORD = 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else one from U+0100 on, in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each rank, in order of rank, of a file with lines of base64 and rank."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(text) for text, rank in map(bytes.split, filter(bytes.strip, lines))}
    if sorted(found) != list(range(len(found))):
        raise ValueError(f"{path}: ranks are not 0 to {len(found) - 1}")
    return [found[r] for r in range(len(found))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _chunk(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: list[bytes]) -> bytes:
    """The protobuf message of a sentencepiece BPE model whose ids are the ranks; the unknown piece comes last."""
    letters = byte_characters()
    out = bytearray()
    for rank, piece in enumerate(ranks):
        text = "".join(letters[b] for b in piece).encode()
        out += _chunk(1, _chunk(1, text) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1))
    out += _chunk(1, _chunk(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", -float(len(ranks))) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(ranks) + 1) + _number(40, len(ranks)) + b"".join(_varint(f << 3) + _varint((1 << 64) - 1) for f in (41, 42, 43))
    normalizer = _chunk(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(out + _chunk(2, trainer) + _chunk(3, normalizer))


class PieceCoder:
    """Encodes and decodes whole texts; remembers the pre-tokens that it met."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.whole = {piece: rank for rank, piece in enumerate(self.ranks)}
        self.letters = byte_characters()
        self.table = {b: c for b, c in enumerate(self.letters)}
        self.bytes_of = {c: b for b, c in enumerate(self.letters)}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.held = 0

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        rank = self.whole.get(raw)
        if rank is not None:
            return [rank]
        return self.processor.encode(raw.decode("latin-1").translate(self.table))

    def decode(self, ids: list[int]) -> bytes:
        pieces = self.processor.id_to_piece(ids)
        return bytes(self.bytes_of[c] for piece in pieces for c in piece)

    def _coded(self, word: str) -> tuple[int, str, bytes]:
        ids = self.encode_word(word)
        found = (len(ids), ",".join(map(str, ids)), self.decode(ids))
        if len(word) <= _CACHED_WORD:
            if self.held >= _CACHE_BYTES:
                self.known.clear()
                self.held = 0
            self.known[word] = found
            self.held += 300 + 4 * len(word) + len(found[1]) + len(found[2])  # 300: objects and their place in the table
        return found

    def encode(self, text: str) -> list[int]:
        return [i for word in self.split(text) for i in self.encode_word(word)]

    def digest(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids as comma-joined decimals, the bytes that they decode to."""
        known = self.known
        parts = [known.get(word) or self._coded(word) for word in self.split(text)]
        return sum(p[0] for p in parts), ",".join([p[1] for p in parts]), b"".join([p[2] for p in parts])


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> PieceCoder:
    return PieceCoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text, and the bytes they decode to.

    A null or empty text has no ids.  One row for each row; other columns are ignored.
    """

    shipped = ship_file(docs.sparkSession, path)

    def run(batches):
        own = coder(SparkFiles.get(shipped), pattern)
        for batch in batches:
            ids = [own.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(x) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each whole text, by the same coder as :func:`encode`.

    A null text counts as empty.  One row for each row; other columns are ignored.
    """

    shipped = ship_file(docs.sparkSession, path)

    def run(batches):
        own = coder(SparkFiles.get(shipped), pattern)
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                count, line, raw = own.digest(text or "")
                n.append(count)
                ids.append(hashlib.sha256(line.encode()).hexdigest())
                decoded.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
