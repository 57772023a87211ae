"""Language identification with hyperdimensional profiles (operator 1).

Method: every letter has a random vector of DIMENSIONS signs. An n-gram of three letters is bound into one vector, the
product of its letters' vectors, each permuted (rolled) by its place in the n-gram. A document bundles (sums) the
vectors of all its n-grams; a language's prototype bundles those of all its documents. The language whose prototype has
the greatest cosine with the document is predicted (ties: the first language in order), and that cosine, not below 0,
is the score.

Letters are lower-cased; every letter of every script has a vector of its own, drawn for its code point, and each run of
other characters is one blank. Prototypes bundle every learning document, as sums of integers per task and then per
language, so they do not depend on partitioning; what reaches the driver is one vector a language.

Results: null texts and texts without a letter are ``und`` with score 0; with no document to learn from every text is
``und``. Rows without a doc_id are judged but not learnt from. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import arrow_filter, arrow_map, crc_mod, map_batches

DIMENSIONS, SEED = 1024, 20_240_501
UNKNOWN = "und"
#: Vectors of letters and of n-grams kept in a Python worker (8 and 16 MB); emptied when full, which changes no result.
LETTERS_KEPT, NGRAMS_KEPT = 8192, 16_384
#: N-grams bundled together, and languages whose sums a task holds.
TOGETHER, LANGS_HELD = 4096, 1024


@cache
def is_letter() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class NgramVectors:
    """Vectors of letters, each drawn for its own code point (0: a blank), and of n-grams, bound when first met."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.slots: dict[int, int] = {}
        self.rows = np.empty((NGRAMS_KEPT, DIMENSIONS), np.int8)

    def letter(self, point: int) -> np.ndarray:
        found = self.letters.get(point)
        if found is None:
            if len(self.letters) >= LETTERS_KEPT:
                self.letters.clear()
            found = self.letters[point] = np.random.default_rng([SEED, point]).choice(np.array([-1, 1], np.int8), DIMENSIONS)
        return found

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of at most TOGETHER n-grams."""
        wanted = codes.tolist()
        new = [c for c in wanted if c not in self.slots]
        if len(self.slots) + len(new) > NGRAMS_KEPT:
            self.slots.clear()
            new = wanted
        for c in new:
            placed = [np.roll(self.letter(c >> 21 * (2 - k) & 0x1FFFFF), 2 - k) for k in range(3)]
            self.slots[c] = at = len(self.slots)
            self.rows[at] = placed[0] * placed[1] * placed[2]
        return self.rows[[self.slots[c] for c in wanted]]


@cache
def ngram_vectors() -> NgramVectors:
    """One store a Python worker."""
    return NgramVectors()


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text, as sorted codes (21 bits for each letter), and how often each occurs; none if it has
    no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    symbols = np.where(is_letter()[points], points, 0)
    if not symbols.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    symbols = np.concatenate([[0], symbols, [0]])
    symbols = symbols[np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])].astype(np.int64)
    if len(symbols) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(symbols[:-2] << 42 | symbols[1:-1] << 21 | symbols[2:], return_counts=True)


def bundle(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the vectors of n-grams, each as often as it occurs: whole numbers, exact below 2**24 n-grams."""
    total = np.zeros(DIMENSIONS)
    for start in range(0, len(codes), TOGETHER):
        part = slice(start, start + TOGETHER)
        total += counts[part].astype(np.float32) @ ngram_vectors().of(codes[part]).astype(np.float32)
    return total


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """The bundle of each language over all of ``docs`` with a language, of length 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.list_(pa.int64()))], ["lang", "vector"])

        for batch in batches:
            for text, lang in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                if lang not in seen:
                    if len(seen) >= LANGS_HELD:
                        yield rows()
                        seen.clear()
                    seen[lang] = np.zeros(DIMENSIONS, np.int64)
                seen[lang] += np.rint(bundle(*ngrams(text))).astype(np.int64)
        yield rows()

    learnt = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang IS NOT NULL")
    parts = map_batches(learnt, run, "lang string, vector array<long>").select("lang", F.posexplode("vector").alias("at", "x"))
    found: dict[str, np.ndarray] = {}
    for row in parts.groupBy("lang", "at").agg(F.sum("x").alias("x")).collect():
        found.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["at"]] = row["x"]
    return {lang: v / n for lang, v in sorted(found.items()) if (n := np.linalg.norm(v)) > 0}


def effective(counts: np.ndarray) -> int:
    """How many n-grams that occur once would carry as much as these: a text that repeats few words counts as the short
    text that it is, whose cosine with its language is that of a short text too."""
    if not len(counts):
        return 0
    n = counts.astype(np.float64)
    return int(np.rint(n.sum() ** 2 / (n @ n)))


def measured(text: str | None, names: list[str], matrix: np.ndarray) -> tuple[str, float, int]:
    """The language of a text, its score and its ``effective`` number of n-grams; ``matrix`` has a prototype a row."""
    codes, counts = ngrams(text)
    if not len(codes) or not names:
        return UNKNOWN, 0.0, effective(counts)
    vector = bundle(codes, counts)
    cosines = matrix @ vector / max(np.linalg.norm(vector), 1e-12)
    best = int(np.argmax(cosines))
    return names[best], float(min(1.0, max(0.0, cosines[best]))), effective(counts)


def judge(text: str | None, names: list[str], matrix: np.ndarray) -> tuple[str, float]:
    """The language of a text and its score; ``matrix`` has a prototype a row."""
    return measured(text, names, matrix)[:2]


def identify(docs: DataFrame, models: dict[str, np.ndarray], held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    names = list(models)
    matrix = np.array([models[n] for n in names]).reshape(len(names), DIMENSIONS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [judge(t, names, matrix) for t in batch.column(2).to_pylist()]
        langs, scores = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are not learnt from: the remainder of their id's checksum is 0."""
    return F.coalesce(crc_mod(id_col, 5) == 0, F.lit(False))


def identify_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``identify`` with prototypes of the documents that are not held out."""
    models = prototypes(docs.where(crc_mod(id_col, 5) != 0), text_col, lang_col)
    return identify(docs, models, held_out(id_col), id_col, text_col)


#: Least cosine with a prototype for any document to count as written in a known language; that of a text unrelated to
#: all of them is about 1 / sqrt(DIMENSIONS) = 0.03 if it has few n-grams, and grows with their number.
MIN_SCORE = 0.04
#: The least score of a length is SHARE of the LOW quantile of the learning documents of that length.
LOW, SHARE = 0.005, 0.6
#: Bands of length: two for each doubling of the effective n-grams. A band of fewer than BAND_DOCS documents takes in its neighbours.
BANDS, BAND_DOCS = 64, 200
#: Steps in which scores are counted.
STEPS = 1000


def band_of(n: int) -> int:
    """The band of an effective number of n-grams."""
    return min(BANDS - 1, int(2 * np.log2(max(n, 1))))


def least_scores(docs: DataFrame, models: dict[str, np.ndarray], text_col: str = "text", lang_col: str = "lang") -> np.ndarray:
    """The least score of each band, from the scores of all learning documents ``docs``."""
    names = list(models)
    matrix = np.array([models[n] for n in names]).reshape(len(names), DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((BANDS, STEPS + 1), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                lang, score, n = measured(text, names, matrix)
                if lang != UNKNOWN:
                    seen[band_of(n), int(score * STEPS)] += 1
        band, step = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(band), pa.array(step), pa.array(seen[band, step])], ["band", "step", "n"])

    learnt = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"))
    counts = np.zeros((BANDS, STEPS + 1), np.int64)
    for r in map_batches(learnt, run, "band long, step long, n long").groupBy("band", "step").agg(F.sum("n").alias("n")).collect():
        counts[r["band"], r["step"]] = r["n"]
    least = np.full(BANDS, MIN_SCORE)
    for band in range(BANDS):
        for wide in range(BANDS):
            near = counts[max(0, band - wide) : band + wide + 1].sum(axis=0).cumsum()
            if near[-1] >= BAND_DOCS:
                break
        if near[-1]:
            least[band] = max(MIN_SCORE, SHARE * int(np.argmax(near > LOW * near[-1])) / STEPS)
    return least


def known_language(docs: DataFrame, min_score: float | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents in a language that was learnt, with all their columns: a text without a letter is rejected, and
    so is one whose best cosine is below ``min_score``, or without it below ``least_scores`` of its effective number of n-grams.
    With nothing to learn from, every text with a letter stays."""
    learnt = docs.where(crc_mod(id_col, 5) != 0)
    models = prototypes(learnt, text_col, lang_col)
    names = list(models)
    matrix = np.array([models[n] for n in names]).reshape(len(names), DIMENSIONS)
    least = least_scores(learnt, models, text_col, lang_col) if names and min_score is None else np.full(BANDS, min_score or 0.0)

    def keep(texts: list) -> list[bool]:
        if not names:
            return [len(ngrams(t)[0]) > 0 for t in texts]
        return [lang != UNKNOWN and score >= least[band_of(n)] for lang, score, n in (measured(t, names, matrix) for t in texts)]

    return arrow_filter(docs, text_col, keep)
