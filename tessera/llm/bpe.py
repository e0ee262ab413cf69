"""Byte-level BPE by a sentencepiece model that is serialised directly from a rank vocabulary.

A rank file lists byte strings, best merge first. Here each becomes a piece of a sentencepiece BPE model: every byte is
written as one printable character, the score is the negated rank, and normalisation is the identity. Pre-tokens (the
matches of the public split pattern) are encoded one by one; a pre-token that is itself a piece takes that id at once.
Decoding maps ids back to their byte strings.

Defined cases: a null or empty text has no ids (the digests are those of no bytes); repeated rows give equal rows; an
empty table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import map_column, table

#: Byte b is written as the character at this code point plus b: letters without case, width or normal forms.
ALPHABET_AT = 0x4E00
#: Distinct pre-tokens that a worker keeps; the cache starts anew beyond it.
CACHE = 400_000


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    """A protobuf field: length-delimited for bytes, a varint for numbers."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def spell(data: bytes) -> str:
    """Bytes as the model's alphabet."""
    return "".join(map(_LETTERS.__getitem__, data))


_LETTERS = [chr(ALPHABET_AT + b) for b in range(256)]


def serialise(pieces: list[bytes]) -> bytes:
    """A sentencepiece ModelProto of BPE type; the id of a piece is its rank, and <unk> comes last."""
    normal, unknown, bpe = 1, 2, 2
    out = bytearray()
    for rank, piece in enumerate(pieces):
        score = np.float32(-rank).tobytes()
        out += _field(1, _field(1, spell(piece).encode()) + _varint(2 << 3 | 5) + score + _field(3, normal))
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + np.float32(0).tobytes() + _field(3, unknown))
    trainer = _field(3, bpe) + _field(4, len(pieces) + 1) + _field(40, len(pieces))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, identity))


def read_ranks(path: str) -> list[bytes]:
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in pairs)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [piece for _, piece in ranked]


class _Packed(dict):
    """Pre-token to its ids as packed little-endian unsigned 32-bit integers."""

    def __init__(self, codec: "Codec"):
        super().__init__()
        self.codec = codec

    def __missing__(self, token: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        packed = self[token] = np.asarray(self.codec.pretoken(token), dtype="<u4").tobytes()
        return packed


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        self.pieces = read_ranks(path)
        self.rank = {piece: i for i, piece in enumerate(self.pieces)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.pieces))
        self.split = regex.compile(pattern).findall
        self.packed = _Packed(self)

    def pretoken(self, token: str) -> list[int]:
        data = token.encode()
        whole = self.rank.get(data)
        return [whole] if whole is not None else self.model.encode(spell(data))

    def encode(self, text: str) -> bytes:
        """The packed ids of a text."""
        return b"".join(map(self.packed.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded bytes; with_ids adds the packed ids and the bytes."""

    def make():
        own = codec(path, pattern)

        def work(texts: list[str | None]) -> list[list]:
            ids = [own.encode(text) if text else b"" for text in texts]
            back = [own.decode(x) for x in ids]
            sha = [[hashlib.sha256(x).hexdigest() for x in column] for column in (ids, back)]
            return [[len(x) // 4 for x in ids], *sha, *([ids, back] if with_ids else [])]

        return work

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded binary" * with_ids
    return map_column(docs, ["doc_id"], "text", make, schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
