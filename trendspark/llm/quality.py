"""Quality rules for whole texts: base rules and a hashed n-gram likelihood ratio (operator 12).

Method: a document is a bag of n-grams: its words and pairs of words, and the singles, pairs and triples of its words'
shapes (runs of letters and digits reduced to a class, marks kept, a word equal to the one before marked as such). They
are hashed into buckets, and two multinomials are counted over the buckets, from whole texts: the trusted target
(all documents whose labels all say ``quality`` 1) and the raw corpus (every document). A document's score is the mean
over its n-grams of log p_target - log p_raw, so length does not matter. It stays if its score is not below a fixed threshold: every document
is decided by its own score alone, without a draw. The threshold follows from the trusted documents' own scores: SLACK
below their LOW quantile, counted over all of them in steps, and never above 0, the score of a text that says nothing.

Texts are read twice: to count n-grams, and to score; scores are written, and the threshold and verdicts follow from them.
Which documents are trusted is joined to the texts by id, both dealt by it: any number of trusted documents can be learnt
from, and the texts are shuffled once for it at every size.

The number of buckets grows with the corpus, with the square root of its words as the vocabulary does (``bucket_bits``):
2**15 for 0.1 GB, 2**20 for 30 GB, 2**25 for 100 TB. The table that tasks are sent has one 4-byte ratio a bucket: 128 MB
at 100 TB. Counts are added up per task and bucket before the shuffle. Smoothing is a prior of PRIOR raw n-grams a bucket
spread as the raw corpus is, so rare n-grams count for little.

Base rules are exact: n_words of ``[^\\x20\\x09-\\x0D]+``, word_chars (code points in words), n_symbols (``#*$%&|<>``),
n_dup_lines (lines with a word, equal to an earlier line of the text), n_repeat_words (words in three-word windows that
the text has twice or more, the first included). A document of fewer than 50 words, or with more than half of its words in
such windows, fails them and goes.

Results: a null text has no words and goes, as an empty one does; repeated rows are judged alike; a row without a doc_id
is judged and counted in the raw corpus, but is never trusted; without labels or trusted documents only the base rules
decide; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import SLICE_ROWS, cut, map_batches, mix64

#: Fixed values of the base rules: blanks, symbols, least words, and the largest share of repeated words in percent.
BLANKS, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50
#: Buckets: BUCKETS_A_ROOT for each square root of a word, as a power of two, and at least and most so many bits.
BUCKETS_A_ROOT, MIN_BITS, MAX_BITS = 8, 12, 25
#: Raw n-grams added to each bucket.
PRIOR = 20.0
#: The threshold is SLACK nats below the LOW quantile of trusted documents, counted in steps of 1 / STEPS nats.
LOW, SLACK, STEPS = 0.002, 0.25, 1000
#: Distinct words of a worker whose hashes and shapes are kept; bounds its memory.
WORDS_KEPT = 300_000

_CLASSES = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 0x80 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_P = np.uint64(0x9E3779B97F4A7C15)


def shape_of(word: bytes) -> bytes:
    """``A`` for capitals, ``a`` for other letters, ``0`` for digits, marks as they are; each run once."""
    return _RUNS.sub(rb"\1", word.translate(_CLASSES))


class Hashes(dict):
    """(hash of the word, hash of its shape) of words; emptied when full, which changes no result."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = (xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest(shape_of(word), 1))
        return found


HASHES = Hashes()


def words_of(text: str | None) -> tuple[bytes, list[bytes], np.ndarray]:
    """A text as UTF-8, its distinct words in order, and the number of the word at each place."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()  # of bytes, at exactly the six blanks
    index = dict.fromkeys(words)
    for i, word in enumerate(index):
        index[word] = i
    return raw, list(index), np.fromiter(map(index.__getitem__, words), np.int64, len(words))


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(ids) < 4:
        return 0
    n, keys = len(ids), ids[:-1] * distinct + ids[1:]
    if distinct >= 1 << 20:  # three numbers do not fit 63 bits: number the pairs first
        keys = np.unique(keys, return_inverse=True)[1]
    keys = keys[:-1] * distinct + ids[2:]
    order = np.sort(keys)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    many = np.isin(keys, again)
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= many
    return int(inside.sum())


def base(text: str | None, raw: bytes, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n, repeated = len(ids), repeated_words(ids, len(words))
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    return (n, len(text or "") - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n)


def ngrams(words: list[bytes], ids: np.ndarray) -> np.ndarray:
    """The hashes of all n-grams of a text, one for each place."""
    if not words:
        return np.empty(0, np.uint64)
    known = [HASHES[w] for w in words]
    word, shape = (np.fromiter((h[k] for h in known), np.uint64, len(known))[ids] for k in (0, 1))
    again = np.concatenate([[False], ids[1:] == ids[:-1]])
    shape = np.where(again, shape * _P, shape)
    found = [word, mix64(word[:-1] * _P + word[1:]), shape]
    pairs = mix64(shape[:-1] * _P + shape[1:])
    found += [pairs, mix64(pairs[:-1] * _P + shape[2:])]
    return np.concatenate(found)


def bucket_bits(words: int) -> int:
    """Bits of the bucket numbers for a corpus of so many words."""
    return min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1.0, BUCKETS_A_ROOT * math.sqrt(words))))))


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def trusted(labels: DataFrame, most: int | None = None) -> DataFrame:
    """(id, trusted) of all documents whose labels all say quality 1. A caller who gives ``most`` gets about so many if
    they are more, chosen by a hash of the id; the operator gives none."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    good = known.agg(F.min("quality").alias("q")).where("q = 1").select("id")
    if most is not None and (n := good.count()) > most:
        good = good.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < (most << 30) // n)
    return good.withColumn("trusted", F.lit(True))


def marked(docs: DataFrame, good: DataFrame) -> DataFrame:
    """(text, trusted) of all documents; ``good``: the trusted ids."""
    own = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return own.join(good.hint("merge"), "id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))


def counts(rows: DataFrame, bits: int) -> DataFrame:
    """(bucket, target, raw): the n-grams of each bucket in trusted and in all rows; ``rows``: text, trusted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for text, good in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    at = buckets(ngrams(*words_of(text)[1:]), bits)
                    np.add.at(seen[1], at, 1)
                    if good:
                        np.add.at(seen[0], at, 1)
        found = np.flatnonzero(seen[1])
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[0][found]), pa.array(seen[1][found])], ["bucket", "target", "raw"])

    parts = map_batches(rows, run, "bucket long, target long, raw long")
    return parts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def ratios(found: DataFrame, bits: int) -> np.ndarray | None:
    """log p_target - log p_raw of each bucket; None without a trusted n-gram. One row of at most 4096 buckets at a time
    reaches the driver, 16 bytes a bucket in all."""
    packed = found.groupBy(F.shiftright("bucket", 12).alias("block")).agg(F.collect_list(F.struct("bucket", "target", "raw")).alias("rows"))
    target, raw = np.zeros(1 << bits), np.zeros(1 << bits)
    for row in packed.toLocalIterator():
        for bucket, t, r in row["rows"]:
            target[bucket], raw[bucket] = t, r
    if not target.sum():
        return None
    share = target.sum() / raw.sum()
    return np.log((target + PRIOR * share) / ((raw + PRIOR) * share)).astype(np.float32)


def score_of(words: list[bytes], ids: np.ndarray, table: np.ndarray | None, bits: int) -> float:
    """The mean log ratio of a text's n-grams; 0 for a text without words."""
    if table is None or not words:
        return 0.0
    return float(table[buckets(ngrams(words, ids), bits)].mean(dtype=np.float64))


def threshold_of(rows: DataFrame, good: DataFrame) -> float:
    """The least score that stays, from the scores of all trusted rows; ``rows``: scored documents, ``good``: trusted ids."""
    passed = rows.where("NOT base_failed").select(F.col("doc_id").alias("id"), F.floor(F.col("score") * STEPS).alias("step"))
    steps = passed.join(good, "id", "left_semi").groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    found = sorted((r["step"], r["n"]) for r in steps.collect())  # at most so many rows as there are steps
    left = LOW * sum(n for _, n in found)
    for step, n in found:
        left -= n
        if left < 0:
            return min(0.0, step / STEPS - SLACK)
    return -math.inf


SCORED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, score double")


def scored(docs: DataFrame, table: np.ndarray | None, bits: int) -> DataFrame:
    """One row per document: its base columns, and its score by a table of ratios."""
    sent = docs.sparkSession.sparkContext.broadcast(table)  # 4 bytes a bucket, at most 2**MAX_BITS of them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = []
                for text in part.column(1).to_pylist():
                    raw, words, ids = words_of(text)
                    found = base(text, raw, words, ids)
                    rows.append((*found, score_of(words, ids, sent.value, bits)))
                types = (*[pa.int64()] * 5, pa.bool_(), pa.float64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [f.split()[0] for f in SCORED.split(", ")])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, SCORED)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score."""
    # words are about as many as a sixth of the characters; the size of the table needs no more than that
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = bucket_bits(size // 6)
    good = cut(trusted(labels))
    table = ratios(counts(marked(docs, good), bits), bits)
    rows = scored(docs, table, bits)
    kept = F.expr("NOT base_failed")
    if table is not None:
        rows = cut(rows)  # about 100 bytes a document, where scoring again would read all texts
        kept = kept & (F.col("score") >= threshold_of(rows, good))
    columns = [f.split()[0] for f in SCORED.split(", ")]
    return rows.select(*columns[:-1], kept.alias("kept"), "score")
