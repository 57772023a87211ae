"""Quality rules: base columns and scores against plain Python, verdicts against planted junk and clean texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from trendspark.llm import quality
from trendspark.llm.common import mix64

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    """The base columns by counting."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def grams(text):
    """Every n-gram's hash, one at a time."""
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    M, P = 1 << 64, 0x9E3779B97F4A7C15
    mix = lambda x: int(mix64(np.array([x % M], np.uint64))[0])
    one = [xxhash.xxh64_intdigest(w.lower()) for w in words]
    shape = [xxhash.xxh64_intdigest(quality.shape_of(w), 1) * (P if i and w == words[i - 1] else 1) % M for i, w in enumerate(words)]
    pairs = [mix(a * P + b) for a, b in zip(shape, shape[1:])]
    return [*one, *(mix(a * P + b) for a, b in zip(one, one[1:])), *shape, *pairs, *(mix(a * P + b) for a, b in zip(pairs, shape[2:]))]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(2)
    made = ["".join(rng.choice("ab #$|\n\t\x0b\x0c\r\x1c\x85 é漢<&") for _ in range(rng.randrange(300))) for _ in range(60)]
    return [None, "", " \n\t", "a", "a a a a", "a b c " * 40, "x\nx\n x\n\n\nx", "w" * 100_000, "one two three four " * 3, *made]


def test_base_columns_equal_counting(spark, odd):
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    texts = [*odd, *real]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], LABELS)
    got = {r.doc_id: tuple(r)[1:7] for r in quality.quality(spark.createDataFrame(list(enumerate(texts)), DOC), labels).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_many_distinct_words_take_the_longer_way():
    ids = np.array([0, 1, 2, 3, 0, 1, 2, 4, 4, 4, 4])
    assert quality.repeated_words(ids, 5) == quality.repeated_words(ids, 1 << 20) == 10


def test_scores_and_threshold_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    docs += [docs[3], (None, docs[4][1])]
    good = {d for d, _ in docs[:60] if d % 3}
    labels = [(d, int(d in good), 0) for d, _ in docs[:60]] + [(docs[1][0], 1, 0), (docs[1][0], 0, 0), (None, 1, 0), (docs[70][0], None, 1)]
    good -= {docs[1][0]}
    bits = quality.bucket_bits(sum(len(t.encode()) for _, t in docs) // 6)
    bags = [Counter(g >> (64 - bits) for g in grams(t)) for _, t in docs]
    target, raw = Counter(), Counter()
    for (d, _), bag in zip(docs, bags):
        raw += bag
        if d in good:
            target += bag
    share = sum(target.values()) / sum(raw.values())
    ratio = {b: math.log((target[b] + quality.PRIOR * share) / ((raw[b] + quality.PRIOR) * share)) for b in raw}
    want = [sum(ratio[b] * n for b, n in bag.items()) / max(1, sum(bag.values())) for bag in bags]
    rows = quality.quality(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABELS)).collect()
    got = sorted((r.doc_id is None, r.doc_id, r.score) for r in rows)
    for (_, a, x), (_, b, y) in zip(got, sorted((d is None, d, s) for (d, _), s in zip(docs, want))):
        assert a == b and x == pytest.approx(y, abs=1e-5)
    passed = sorted(s for (d, t), s in zip(docs, want) if d in good and not plain(t)[-1])
    least = min(0.0, math.floor(passed[int(quality.LOW * len(passed))] * quality.STEPS) / quality.STEPS - quality.SLACK)
    for r in rows:
        assert abs(r.score - least) < 2e-3 or r.kept == (not r.base_failed and r.score >= least)


def test_junk_goes_and_clean_documents_stay(spark):
    """On documents that nothing was learnt from: labels of other documents only."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect()]
    clean = [r for r, q in held if q == 1 and not r.base_failed]
    junk = [r for r, q in held if q == 0]
    assert sum(r.kept for r in clean) / len(clean) > 0.995
    assert sum(not r.kept for r in junk) / len(junk) > 0.95 and any(not r.base_failed and not r.kept for r in junk)


def test_awkward_tables(spark):
    clash = "doc_id long, text string, id string, trusted string, bucket int, score double, raw int, quality int"
    long = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(1, long, "x", "y", 1, 0.5, 2, 3), (1, long, "x", "y", 1, 0.5, 2, 3), (None, long, None, None, None, None, None, None)], clash)
    none = spark.createDataFrame([], LABELS)
    assert [(r.n_words, r.kept, r.score) for r in quality.quality(df, none).collect()] == [(80, True, 0.0)] * 3
    assert quality.quality(spark.createDataFrame([], DOC), none).collect() == []
    assert len({r.score for r in quality.quality(df, spark.createDataFrame([(1, 1, 0)], LABELS)).collect()}) == 1


def test_the_table_grows_with_the_corpus():
    assert [quality.bucket_bits(n) for n in (0, 16_000_000, 80_000_000, 5_000_000_000, 16_000_000_000_000)] == [12, 15, 17, 20, 25]


def test_trusted_documents_are_bounded_and_chosen_by_id(spark):
    labels = spark.range(4000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    some = {r.id for r in quality.trusted(labels, 500).collect()}
    assert 400 < len(some) < 600 and some == {r.id for r in quality.trusted(labels.repartition(7), 500).collect()}
    assert quality.trusted(labels, 4000).count() == 4000


def test_every_trusted_document_is_learnt_from(spark):
    labels = spark.range(200_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.trusted(labels).count() == 200_000


def test_results_do_not_depend_on_how_trusted_ids_reach_the_scores(spark):
    rows = [(i if i % 9 else None, " ".join(f"word{j * i % 97}" for j in range(70 + i)) if i % 7 else None) for i in range(60)]
    docs, labels = spark.createDataFrame(rows * 2, DOC), spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], LABELS)
    found = lambda: sorted(map(str, quality.quality(docs, labels).collect()))
    sent = found()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found() == sent
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
