"""The corpus pipeline, stage by stage, and the registered queries."""

from __future__ import annotations

import base64
import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from trendspark.llm import langid
from trendspark.llm.common import shingle_hashes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(out)
        docs = found[name] = spark.read.parquet(out)
    return found


def test_stages_keep_columns_and_rows(stages):
    names = ["documents", *(n for n, _ in corpus_pipeline.STAGES)]
    for before, after in zip(names[:-2], names[1:-1], strict=True):
        assert stages[after].schema == stages["documents"].schema
        assert {r.doc_id for r in stages[after].select("doc_id").collect()} <= {r.doc_id for r in stages[before].select("doc_id").collect()}


def test_clean_documents_stay_and_toxic_ones_go(spark, stages):
    assert stages["language"].count() == stages["documents"].count()
    left = {r.doc_id for r in stages["toxicity"].select("doc_id").collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean, toxic = [d for d, t in marks.items() if t == 0], [d for d, t in marks.items() if t == 1]
    assert sum(d in left for d in clean) / len(clean) > 0.97 and sum(d in left for d in toxic) / len(toxic) < 0.5


def test_gibberish_and_unlearnt_languages_go(spark, stages):
    rng = random.Random(1)
    planted = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)) for _ in range(20)]
    planted += [base64.b64encode(rng.randbytes(450)).decode() for _ in range(20)] + [rng.randbytes(300).hex() for _ in range(20)]
    planted += [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. " * 2,
        "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu. " * 3,
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. " * 3,
    ]
    clean = ["The weather is good today.", "Das ist ein kurzer Text.", "Wir gehen nach Hause."]
    docs = stages["documents"]
    extra = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(planted + clean)], "doc_id long, text string")
    left = {r.doc_id for r in langid.known_language(docs.unionByName(extra, allowMissingColumns=True)).where("doc_id < 0").select("doc_id").collect()}
    assert left == {-1 - i for i in range(len(planted), len(planted) + len(clean))}


def test_texts_of_few_words_repeated_count_as_short_texts(spark):
    _, counts = langid.ngrams("the weather is good today ")
    _, repeated = langid.ngrams("the weather is good today " * 40)
    assert langid.effective(counts[:0]) == 0 and langid.effective(counts) <= counts.sum()
    assert abs(langid.effective(repeated) - langid.effective(counts)) <= 2
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-1, "The weather is good today. " * 60), (-2, "Das ist ein kurzer Text. " * 60)], "doc_id long, text string")
    left = langid.known_language(docs.unionByName(extra, allowMissingColumns=True)).where("doc_id < 0")
    assert left.count() == 2


def test_copies_go_once(stages):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    before = Counter(norm(r.text) for r in stages["toxicity"].select("text").collect())
    after = Counter(norm(r.text) for r in stages["exact_dedup"].select("text").collect())
    assert set(before) == set(after) and max(after.values()) == 1
    rows = {r.doc_id: set(shingle_hashes(r.text).tolist()) for r in stages["exact_dedup"].collect()}
    kept = {r.doc_id for r in stages["minhash_dedup"].select("doc_id").collect()}
    ids = sorted(rows)
    for a in ids:
        for b in ids:
            if a < b and a in kept and b in kept and rows[a] and rows[b] and min(len(rows[a]), len(rows[b])) > 0.9 * max(len(rows[a]), len(rows[b])):
                assert len(rows[a] & rows[b]) < 0.9 * len(rows[a] | rows[b])


def test_everything_left_is_packed(stages):
    packed = {r.doc_id for r in stages["packing"].select("doc_id").distinct().collect()}
    assert packed == {r.doc_id for r in stages["minhash_dedup"].select("doc_id").collect()}


def test_queries_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
