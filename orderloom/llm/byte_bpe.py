"""Byte-level BPE through sentencepiece: a model file made from a rank table, encoding, decoding.

Every token of the rank table becomes a piece written in one letter per byte, scored by its
negative rank, so that sentencepiece merges in the order of the ranks. Texts are cut by the
pre-token pattern first; ids equal ranks. Decoding maps each id back to the bytes of its token.

Null and empty texts have no tokens. Rows are independent: repeated rows and ids repeat their
result, an empty table gives an empty one, extra columns are not returned. Surrogates that are
no characters cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import sentencepiece
from pyspark.sql import DataFrame

from orderloom.llm.common import Remembered, kept, map_texts, pick
from orderloom.llm.pretokens import PIECES, as_letters, over_units

# field numbers and values of the sentencepiece model format, fixed
PIECES_FIELD, TRAINER_FIELD, NORMALIZER_FIELD = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TYPE_NORMAL, TYPE_UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
MODEL_TYPE_BPE = 2
NORM_NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in the order of their ranks, which must run from 0 without gaps."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for data, rank in pairs:
        tokens[int(rank)] = base64.b64decode(data)
    if not all(tokens):
        raise ValueError(f"{path}: ranks are not 0 to {len(pairs) - 1}")
    return tokens


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks; the unknown piece comes last."""
    out = []
    for rank, data in enumerate([*tokens, None]):
        text = "<unk>" if data is None else as_letters(data)
        piece = _bytes(PIECE_TEXT, text.encode())
        piece += _varint(PIECE_SCORE << 3 | 5) + struct.pack("<f", -rank if data is not None else 0)
        piece += _number(PIECE_TYPE, TYPE_UNKNOWN if data is None else TYPE_NORMAL)
        out.append(_bytes(PIECES_FIELD, piece))
    trainer = _number(MODEL_TYPE, MODEL_TYPE_BPE) + _number(VOCAB_SIZE, len(tokens) + 1)
    trainer += _number(UNK_ID, len(tokens))
    trainer += b"".join(_number(k, -1) for k in (BOS_ID, EOS_ID, PAD_ID))
    out.append(_bytes(TRAINER_FIELD, trainer))
    normalizer = _bytes(NORM_NAME, b"identity")
    for k in (ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES):
        normalizer += _number(k, 0)
    out.append(_bytes(NORMALIZER_FIELD, normalizer))
    return b"".join(out)


class ByteBPE:
    """Encoder and decoder; ids are little-endian unsigned 32-bit integers in one bytes object."""

    def __init__(self, path: str, remember: int = 100_000) -> None:
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(model_bytes(self.tokens))
        self.of_piece = Remembered(self._piece, remember)
        self.of_unit = Remembered(lambda u: self._unit(" " + u), remember)

    def _piece(self, piece: str) -> bytes:
        ids = self.model.encode(as_letters(piece.encode("utf-8")), num_threads=1)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _unit(self, text: str) -> bytes:
        return b"".join(map(self.of_piece.__getitem__, PIECES.findall(text)))

    def encode(self, text: str | None) -> bytes:
        return b"".join(over_units(text, self._unit, self.of_unit)) if text else b""

    def decode(self, ids: bytes) -> bytes:
        numbers = struct.unpack(f"<{len(ids) // 4}I", ids)
        return b"".join(map(self.tokens.__getitem__, numbers))


def coder(path: str) -> ByteBPE:
    """One encoder per file and worker process."""
    return kept(path, lambda: ByteBPE(path))


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """docs with the column `token_ids` (binary: little-endian uint32) in place of the texts."""

    def start():
        bpe = coder(path)
        return lambda texts: [[bpe.encode(t) for t in texts]]

    return map_texts(docs, {"token_ids": "binary"}, start, column, drop=(column,))


def decode(coded: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """coded with the column `decoded` (binary) in place of the ids; null ids decode to nothing."""

    def start():
        bpe = coder(path)
        return lambda rows: [[bpe.decode(r or b"") for r in rows]]

    return map_texts(coded, {"decoded": "binary"}, start, column, drop=(column,))


def encode_checked(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and decoded_sha256 of each text; ids that do not decode to
    the text raise."""

    def start():
        bpe = coder(path)

        def work(texts: list) -> list:
            n, ids, back = [], [], []
            for t in texts:
                coded = bpe.encode(t)
                decoded = bpe.decode(coded)
                if decoded != (t or "").encode("utf-8"):
                    raise ValueError("a text is not what its ids decode to")
                n.append(len(coded) // 4)
                ids.append(coded)
                back.append(hashlib.sha256(decoded).hexdigest())
            return [n, ids, back]

        return work

    fields = {"n_tokens": "bigint", "token_ids": "binary", "decoded_sha256": "string"}
    return map_texts(pick(docs, "doc_id", "text"), fields, start, drop=("text",))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text, encoded and decoded in one pass."""

    def start():
        bpe = coder(path)
        digest = lambda b: hashlib.sha256(b).hexdigest()

        def work(texts: list) -> list:
            n, ids, back = [], [], []
            for t in texts:
                coded = bpe.encode(t)
                n.append(len(coded) // 4)
                ids.append(digest(coded))
                back.append(digest(bpe.decode(coded)))
            return [n, ids, back]

        return work

    fields = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return map_texts(pick(docs, "doc_id", "text"), fields, start, drop=("text",))
