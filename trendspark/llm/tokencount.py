"""Exact token counts of whole texts, and of every prefix (operator 2).

Method: prefix dynamic programming (see ``bpe``) stores the token count of every prefix of each word; the running sum
over a text's words is then the count of every prefix of the text. ``Counter.cut`` answers truncation and budget
questions from these stored counts without encoding anything again.

Prefixes are of the normalised text as words: the first ``w`` words and the first ``s`` byte symbols of the next.
Results: a null text counts as empty; an empty text has no tokens and its cut is (0, 0). A special string of the
vocabulary is one token. Other columns of the input are not read.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm import bpe
from trendspark.llm.common import arrow_map

#: Fixed value: the word-level pre-tokenizer's pattern.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"


def normalise(text: str) -> str:
    """NFC and lower case letter by letter (so a final sigma is like any other). White space stays: no word has any."""
    text = unicodedata.normalize("NFC", text)
    if "Σ" in text:
        text = text.replace("Σ", "σ")
    return text.lower()


class Counter:
    """Counts of one vocabulary file."""

    def __init__(self, path: str):
        self.vocabulary = bpe.ByteVocabulary(path, PATTERN)
        self.totals = bpe.Remembered(self._total)

    def _total(self, word: str) -> int:
        symbols, encoder = self.vocabulary.symbols(word), self.vocabulary.bpe
        back = encoder.prefixes(symbols)
        return (encoder.ended(symbols, back)[0] if encoder.end else back[-1])[3]

    def words(self, text: str | None) -> tuple[list[str], list[int]]:
        """The words of a text (special strings are words) and their token counts."""
        words, counts = [], []
        for piece, special in self.vocabulary.pieces(text or ""):
            found = [piece] if special else self.vocabulary.find(normalise(piece))
            words += found
            counts += [1] if special else map(self.totals.__getitem__, found)
        return words, counts

    def cut(self, words: list[str], counts: list[int], budget: int) -> tuple[int, int]:
        """The longest prefix of at most ``budget`` tokens: whole words, and symbols of the word after them."""
        sums = np.cumsum(np.array(counts, np.int64)) if counts else np.zeros(0, np.int64)
        whole = int(np.searchsorted(sums, budget, "right"))
        left = budget - (int(sums[whole - 1]) if whole else 0)
        if whole == len(words) or left <= 0 or words[whole] in self.vocabulary.special:
            return whole, 0
        fits = [k + 1 for k, n in enumerate(self.vocabulary.bpe.counts(self.vocabulary.symbols(words[whole]))) if n <= left]
        return whole, max(fits, default=0)


@cache
def counter(path: str) -> Counter:
    """One counter a Python worker and file."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, and the cut for ``limit`` tokens
    (``cut_words`` whole words and ``cut_symbols`` byte symbols of the next word)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counter(path)
        n_bytes, n_tokens, whole, part = [], [], [], []
        for text in batch.column(1).to_pylist():
            words, counts = c.words(text)
            total = sum(counts)
            a, b = c.cut(words, counts, limit) if total > limit else (len(words), 0)
            n_bytes.append(len((text or "").encode("utf-8", "replace")))
            n_tokens.append(total)
            whole.append(a)
            part.append(b)
        over = pa.array([n > limit for n in n_tokens], pa.bool_())
        cols = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_tokens)), over, *(pa.array(x, pa.int64()) for x in (whole, part))]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_words", "cut_symbols"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(narrow, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_words long, cut_symbols long")
