"""BPE encoding to exact ids, and decoding, of whole texts (operator 6).

Method: per-prefix dynamic programming, see ``bpe``. Texts are cut at the vocabulary's special strings (each is one id,
as the tokenizers library does by default) and by its pre-tokenizer pattern; each word's ids come from following the
stored last tokens backwards. Decoding joins the bytes of the ids.

Results: a null text counts as empty; an empty text has no ids and decodes to the empty text. Words that occur again are
taken from a store of bounded size. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm import bpe
from trendspark.llm.common import arrow_map

#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        self.vocabulary = bpe.ByteVocabulary(path, PATTERN)
        self.words = bpe.Remembered(self._word)

    def _word(self, word: str) -> tuple[bytes, bytes]:
        ids = self.vocabulary.bpe.encode(self.vocabulary.symbols(word))
        return struct.pack(f"<{len(ids)}I", *ids), b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def both(self, text: str | None) -> tuple[bytes, str]:
        """The ids of a whole text (little-endian unsigned 32-bit integers) and the text that they decode to. The
        bytes of ids are joined word by word, as they were decoded when the word was first met."""
        v, out = self.vocabulary, []
        for piece, special in v.pieces(text or ""):
            if special:
                ids = np.array([v.special[piece]], "<u4").tobytes()
                out.append((ids, self.decode_bytes(ids)))
            else:
                out += map(self.words.__getitem__, v.find(piece))
        return b"".join([a for a, _ in out]), b"".join([b for _, b in out]).decode("utf-8", "replace")

    def encode(self, text: str | None) -> bytes:
        """The ids alone."""
        return self.both(text)[0]


@cache
def codec(path: str) -> Codec:
    """One codec a Python worker and file."""
    return Codec(path)


def encode_column(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``ids`` (array of int) and ``decoded`` (the text that they decode to)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        ids, decoded = zip(*map(c.both, batch.column(1).to_pylist()), strict=True)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([np.frombuffer(x, "<u4").astype("i4") for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())],
            ["doc_id", "ids", "decoded"],
        )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(narrow, run, "doc_id long, ids array<int>, decoded string")


def codec_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, and SHA-256 of its ids and of the text decoded from them."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        n, a, b = [], [], []
        for text in batch.column(1).to_pylist():
            ids, decoded = c.both(text)
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(decoded.encode()).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(narrow, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
