"""Toxicity scores by non-negative positive-unlabelled learning (operator 4).

Method: confirmed toxic texts are positive, all other texts are unlabelled (a label of 0 is not used as a negative).
With the share of toxic texts (the class prior, from the labelled rows) the risk of a classifier on negatives is that on
unlabelled texts minus the prior times that on positives; where an estimate of it falls below zero the step goes the
other way, so it stays non-negative. A linear classifier over hashed words present in a text is trained with numpy.

It is fitted on a bounded sample: at most POSITIVES confirmed toxic texts and UNLABELLED others of the learning rows,
those with the smallest hash of their id, whole texts. Only words that positives have more often than unlabelled texts
by MIN_Z standard errors, and whose texts are toxic in a share of at least MIN_SHARE (the prior times the ratio of the
two rates), are used, FEATURES at most. Every text is scored.

Results: an empty or null text has no words and gets the score of the bias alone; without any confirmed toxic row, or
without any text, all scores are 0. Labels that repeat a doc_id count once, toxic if any is; null labels are not labels.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import arrow_filter, arrow_map, crc_mod, word_hashes

POSITIVES, UNLABELLED = 4000, 12_000
BUCKETS, FEATURES, MIN_Z, MIN_SHARE = 1 << 20, 128, 5.0, 0.4
STEPS, RATE, DECAY = 1500, 0.05, 3e-6
THRESHOLD = 0.7


def words_of(text: str | None) -> np.ndarray:
    """The hashed words present in a whole text."""
    return np.unique((word_hashes(text) & np.uint64(BUCKETS - 1)).astype(np.int32))


def learning(id_col: str = "doc_id") -> Column:
    """Rows that may be learnt from."""
    return crc_mod(id_col, 3) != 1


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(id_col, 3) == 1, F.lit(False))


def _smallest(ids: DataFrame, n: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("id"), "id").limit(n)


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, list, float]:
    """Word lists of the positives and of the unlabelled texts of the bounded sample, and the class prior."""
    marks = labels.where(learning("doc_id") & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    texts = docs.where(learning(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    positive = _smallest(marks.where("toxic = 1").join(texts.select("id").distinct(), "id", "left_semi").select("id"), POSITIVES)
    other = _smallest(texts.select("id"), UNLABELLED)
    chosen = positive.select("id", F.lit(1).alias("p")).unionByName(other.select("id", F.lit(0).alias("p")).distinct())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([words_of(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], ["id", "p", "words"])

    # the chosen ids are at most POSITIVES + UNLABELLED, so they can be sent to every task
    rows = arrow_map(texts.join(F.broadcast(chosen), "id").select("id", "text", "p"), run, "id long, p int, words array<int>").toArrow()
    order = np.lexsort((rows["id"].to_numpy(), rows["p"].to_numpy())) if rows.num_rows else []
    words, kinds = rows["words"].combine_chunks(), rows["p"].to_pylist()
    # copies of a text count once, so that a large group of copies does not make all its words look toxic
    found: tuple[dict, dict] = ({}, {})
    for i in order:
        own = np.asarray(words[int(i)].values)
        found[kinds[i]].setdefault(own.tobytes(), own)
    return list(found[1].values()), list(found[0].values()), share


def _matrix(texts: list, used: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), len(used)), np.float32)
    for row, words in zip(out, texts, strict=True):
        at = np.searchsorted(used, words)
        at[at == len(used)] = 0
        row[at[used[at] == words] if len(used) else []] = 1
    return out


def fit(positive: list, unlabelled: list, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(words used, their weights, bias) of the trained classifier."""
    if not positive or not unlabelled or prior <= 0:
        return np.empty(0, np.int32), np.empty(0), -np.inf
    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = (np.bincount(np.concatenate([*x, np.empty(0, np.int32)]).astype(np.int64), minlength=BUCKETS) for x in (positive, unlabelled))
    both = (in_p + in_u) / (n_p + n_u)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n_p + 1 / n_u))
    sure = prior * (in_p / n_p) >= MIN_SHARE * (in_u / n_u)
    strong = np.flatnonzero((z >= MIN_Z) & sure)
    used = np.sort(strong[np.argsort(-z[strong], kind="stable")][:FEATURES]).astype(np.int32)
    x_p, x_u = _matrix(positive, used), _matrix(unlabelled, used)
    weights, bias = np.zeros(len(used)), float(np.log(prior / max(1 - prior, 1e-9)))
    theta = np.append(weights, bias)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        f_p, f_u = x_p @ theta[:-1].astype(np.float32) + theta[-1], x_u @ theta[:-1].astype(np.float32) + theta[-1]
        s_p, s_u = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))
        negative = np.mean(np.logaddexp(0, f_u)) - prior * np.mean(np.logaddexp(0, f_p))
        d_u, d_p = s_u / n_u, prior * s_p / n_p  # derivatives of the negative part
        if negative >= 0:
            g_p, g_u = prior * (s_p - 1) / n_p - d_p, d_u
        else:
            g_p, g_u = d_p, -d_u
        gradient = np.append(x_p.T @ g_p.astype(np.float32) + x_u.T @ g_u.astype(np.float32) + DECAY * theta[:-1], g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return used, theta[:-1], float(theta[-1])


def scorer(model: tuple[np.ndarray, np.ndarray, float]) -> Callable[[list], np.ndarray]:
    """A function that scores a list of texts."""
    used, weights, bias = model
    weight_of = np.zeros(BUCKETS)
    weight_of[used] = weights

    def scores(texts: list) -> np.ndarray:
        f = np.array([weight_of[words_of(t)].sum() + bias for t in texts])
        return np.where(np.isneginf(f), 0.0, 1 / (1 + np.exp(-np.clip(f, -700, 700))))

    return scores


def score_texts(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scores = scorer(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = scores(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score_texts`` with a classifier learnt from the rows that are not held out."""
    return score_texts(docs, fit(*sample(docs, labels, id_col, text_col)), held_out(id_col), id_col, text_col)


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    scores = scorer(fit(*sample(docs, labels, id_col, text_col)))

    def keep(texts: list) -> list[bool]:
        return (scores(texts) < THRESHOLD).tolist()

    return arrow_filter(docs, text_col, keep)
