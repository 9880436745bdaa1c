"""Byte-level BPE encoding and decoding through a sentencepiece model.

A rank file (base64 token, rank) already holds everything a BPE encoder
needs, so nothing is trained: the vocabulary is serialised directly as a
sentencepiece BPE model. Each token becomes one piece whose characters stand
for its bytes (a one-to-one byte map), its score is the negative rank -- so
that the merge of the best score is the merge of the lowest rank -- and the
normaliser is the identity without any white-space handling. Texts are split
by the vocabulary's pattern, each match is encoded on its own (equal matches of
a batch once), and ids are decoded by the inverse map.

Defined results: a null text counts as empty and gives no ids and no bytes;
characters without a UTF-8 form (lone surrogates cannot come out of Spark)
do not occur; repeated rows are encoded each; input columns other than the
id and the text are ignored, so they cannot clash.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import prepare

# Distinct pre-tokens a worker remembers before it starts afresh.
MEMO_TOKENS = 200_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a rank file (its ranks must be 0, 1, 2...)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"ranks of {path} are not 0..n-1")
    return [tokens[i] for i in range(len(tokens))]


@lru_cache(maxsize=1)
def byte_chars() -> str:
    """The character that stands for each byte: 256 letters that neither
    the pattern nor the model treats in a special way."""
    return "".join(chr(0x100 + b) for b in range(256))


@lru_cache(maxsize=1)
def _latin_to_chars() -> dict[int, str]:
    return dict(enumerate(byte_chars()))


def as_chars(token: bytes) -> str:
    """Bytes as the characters that stand for them."""
    return token.decode("latin-1").translate(_latin_to_chars())


def all_as_chars(texts: list[str]) -> list[str]:
    """``as_chars`` of the UTF-8 bytes of several texts, at once: the byte
    0xFF, which UTF-8 never holds, is between them."""
    joined = np.frombuffer(b"\xff".join(map(str.encode, texts)), np.uint8).astype("<u2") + np.uint16(0x100)
    return joined.astype("<u2").tobytes().decode("utf-16-le").split(byte_chars()[0xFF])


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise_model(tokens: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece model; the unknown piece
    it must have takes the id after the last rank and is never produced."""
    # Fixed values of the model format: field numbers and enum values.
    pieces, trainer, normaliser = 1, 2, 3
    piece_text, piece_score, piece_type, normal, unknown = 1, 2, 3, 1, 2
    model_type, bpe, vocab_size, unk_id, bos_id, eos_id, pad_id = 3, 2, 4, 40, 41, 42, 43
    add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = 3, 4, 5

    out = bytearray()
    for rank, token in enumerate(tokens):
        body = _bytes(piece_text, as_chars(token).encode())
        body += _varint(piece_score << 3 | 5) + struct.pack("<f", -float(rank)) + _number(piece_type, normal)
        out += _bytes(pieces, body)
    body = _bytes(piece_text, b"<unk>") + _varint(piece_score << 3 | 5) + struct.pack("<f", 0.0)
    out += _bytes(pieces, body + _number(piece_type, unknown))
    out += _bytes(
        trainer,
        _number(model_type, bpe)
        + _number(vocab_size, len(tokens) + 1)
        + _number(unk_id, len(tokens))
        + _number(bos_id, -1)
        + _number(eos_id, -1)
        + _number(pad_id, -1),
    )
    out += _bytes(
        normaliser,
        _bytes(1, b"identity")
        + _number(add_dummy_prefix, 0)
        + _number(remove_extra_whitespaces, 0)
        + _number(escape_whitespaces, 0),
    )
    return bytes(out)


class Codec:
    """Encoder and decoder of one vocabulary; lives in a Python worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.token_bytes = pa.array(tokens, pa.binary())
        self.find = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.load_from_serialized_proto(serialise_model(tokens))
        self.memo: dict[str, list[int]] = {}

    def _look_up(self, matches: list[str]) -> pa.ListArray:
        """The ids of each of some different matches."""
        memo = self.memo
        new = [t for t in matches if t not in memo]
        if new:
            if len(memo) + len(new) > MEMO_TOKENS:
                memo.clear()
                new = matches
            memo.update(zip(new, self.model.encode(all_as_chars(new), num_threads=1), strict=True))
        ids = [memo[t] for t in matches]
        ends = np.fromiter(accumulate(map(len, ids), initial=0), np.int32, len(ids) + 1)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])))

    def encode_all(self, texts: Iterable[str]) -> pa.ListArray:
        """The ids of each text. A different match of all the texts is looked
        up once; what is done for every match is done on arrays."""
        found = [pa.array(self.find(text), pa.string()) for text in texts]
        ends = np.cumsum([0] + [len(x) for x in found])
        coded = pa.concat_arrays([*found, pa.array([], pa.string())]).dictionary_encode()
        by_match = self._look_up(coded.dictionary.to_pylist()).take(coded.indices)
        return pa.ListArray.from_arrays(pa.array(by_match.offsets.to_numpy()[ends]), by_match.values)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text]).values.to_numpy()

    def decode_all(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each list of ids."""
        pieces = self.token_bytes.take(ids.values)
        ends = np.cumsum(np.concatenate([[0], pc.binary_length(pieces).to_numpy()]), dtype=np.int32)
        starts = ends[ids.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(starts), pieces.buffers()[2] or pa.py_buffer(b"")])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, int, str], Codec] = {}


def codec_for(path: str, tokens: list[bytes], pattern: str) -> Codec:
    """One codec per vocabulary and Python worker."""
    key = (path, len(tokens), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(tokens, pattern)
    return _CODECS[key]


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ids (array of int), decoded (the bytes that
    decoding those ids gives back). ``vocabulary`` is the path of a rank
    file on the driver; its contents travel with the tasks."""
    prepare(docs.sparkSession)
    tokens = read_ranks(vocabulary)
    shipped = docs.sparkSession.sparkContext.broadcast(tokens)  # one vocabulary, fixed size

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(vocabulary, shipped.value, pattern)
        for batch in batches:
            ids = codec.encode_all(text or "" for text in batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["id"], ids, codec.decode_all(ids)], ["id", "ids", "decoded"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(encode, f"id {id_type}, ids array<int>, decoded binary")
