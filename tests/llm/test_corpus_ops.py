"""Corpus operators against libraries, brute force and held-out labels, with the awkward inputs of real tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendspark.llm import codec, components, embdedup, exactdedup, langid, licenses, minhash, packing, tokencount, toxicity, urlfilter
from trendspark.llm.common import shingle_hashes, word_bytes

SF = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, lang string, source string, score double, recipe string, bucket long, rep long, a long, shard int"
DOC = "doc_id long, text string, lang string, source string"


def rows_of(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    pool = "aaabc  \n\t'sé漢字😀0123!?Ωσςß<|endoftext|>ABİǅ\u0301\x85\x1c "
    odd = ["".join(rng.choice(pool) for _ in range(rng.randrange(120))) for _ in range(150)]
    return odd + ["", " ", "a" * 5000, "<|endoftext|> x<|startoftext|>y <|endoftext|>", " " * 3000, "-=-=" * 600, "don't WE'LL x's", "ΑΣ ΑΣ", "1234567890"]


@pytest.fixture(scope="module")
def real(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


@pytest.mark.parametrize("keep_one", [exactdedup.keep_one, minhash.keep_one])
def test_columns_of_any_name_keep_their_values(spark, keep_one):
    schema = "doc_id long, text string, _id long, _own string, _sha string, _none int, _kept string, _n int, _group string, __id long, _row int, kept int, n int"
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, 77, "o", "s", 5, "k", 6, "g", 78, 9, 8, 7), (1, text, 77, "o", "s", 5, "k", 6, "g", 78, 9, 8, 7), (2, text, 0, *[None] * 10), (3, "x", 1, "p", "t", 6, "l", 7, "h", 79, 10, 9, 8)]
    got = sorted(tuple(r) for r in keep_one(spark.createDataFrame(rows, schema)).collect())
    assert got == [rows[0], rows[3]]


def test_exact_groups_of_the_least_id(spark):
    rows = [(-(2**63), "a", None, None), (2**63 - 1, "a", None, None), (0, "b", None, None)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exactdedup.exact_groups(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {-(2**63): (-(2**63), 2), 2**63 - 1: (-(2**63), 2), 0: (0, 1)}


def test_scripts_are_told_apart_by_their_letters(spark):
    ru = "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. "
    uk = "Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і совістю і повинні діяти у відношенні один до одного в дусі братерства. "
    assert not (langid.ngram_vectors().letter(ord("а")) == langid.ngram_vectors().letter(ord("х"))).all()
    rows = [(i, t * 3, lang, None) for i, (t, lang) in enumerate([(ru, "ru"), (uk, "uk")] * 3)]
    rows += [(100, "они рождаются в духе свободы и должны быть равными", None, None), (101, "вони народжуються в дусі свободи і повинні бути рівними", None, None)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, DOC), langid.prototypes(spark.createDataFrame(rows, DOC)), langid.held_out()).collect()}
    assert (got[100], got[101]) == ("ru", "uk")


# --- 6 and 2: exact BPE ------------------------------------------------------------------------------------------


def test_codec_equals_the_library(spark, texts, real):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate([*texts, *real, None])], DOC)
    out = rows_of(codec.codec_digests(docs, path))
    for i, t in enumerate([*texts, *real, None]):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert out[i]["n_tokens"] == len(ids), repr(t[:60])
        assert out[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    some = codec.encode_column(docs.limit(20), path).collect()
    assert all(list(r.ids) == library.encode(([*texts][r.doc_id]), add_special_tokens=False).ids for r in some)


def test_token_counts_equal_the_library(spark, texts, real):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate([*texts, *real, None])], DOC)
    out = rows_of(tokencount.token_counts(docs, path, limit=50))
    for i, t in enumerate([*texts, *real, None]):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (out[i]["n_tokens"], out[i]["n_bytes"], out[i]["over_limit"]) == (n, len((t or "").encode()), n > 50)


def test_prefix_counts_and_cuts_equal_encoding_again():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, counter = Tokenizer.from_file(path), tokencount.Counter(path)
    for word in ("internationalization", "loweischaft", "aaaaaaaaaaaaaaa", "thththe"):
        own = counter.vocabulary.bpe.counts(word)
        assert own == [len(library.encode(word[:k], add_special_tokens=False).ids) for k in range(1, len(word) + 1)]
    words, counts = counter.words("the internationalization of loweischaft and thththe")
    for budget in range(sum(counts) + 2):
        whole, part = counter.cut(words, counts, budget)
        inside = words[:whole] + ([words[whole][:part]] if part else [])
        assert len(library.encode(" ".join(inside), add_special_tokens=False).ids) <= budget
        if whole < len(words):
            assert len(library.encode(" ".join([*words[:whole], words[whole][: part + 1]]), add_special_tokens=False).ids) > budget


def test_pair_test_equals_merging():
    bpe = codec.Codec(public_tokenizers.path("byte_bpe_50k.json")).vocabulary.bpe
    rng, tokens = random.Random(5), [t for t in list(bpe.parts)[:4000]]
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert bpe.compatible(a, b) == (bpe._merged([*a, *b])[0] == [a, b])


# --- 1 and 4: learnt models --------------------------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.97


def test_language_bundle_and_cosine_by_hand():
    text = "The cat, the hat!"
    codes, counts = langid.ngrams(text)
    spelt = " the cat the hat "
    letter = {c: langid.ngram_vectors().letter(0 if c == " " else ord(c)).astype(int) for c in spelt}
    total = sum(np.roll(letter[a], 2) * np.roll(letter[b], 1) * letter[c] for a, b, c in zip(spelt, spelt[1:], spelt[2:], strict=False))
    assert np.array_equal(langid.bundle(codes, counts), total)


def test_language_awkward_rows(spark):
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "123 !!", None, "s"), (None, "the cat", "en", "s"), (6, "der hund und die katze", "de", "s"), (7, "the cat and the dog", "en", "s"), (7, "the cat and the dog", "en", "s")]
    out = langid.identify_held_out(spark.createDataFrame(rows, DOC)).collect()
    assert len(out) == 7
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in out)
    assert langid.identify_held_out(spark.createDataFrame([], DOC)).count() == 0
    nothing = langid.known_language(spark.createDataFrame([(1, "some text", None, "x"), (2, "7", None, "x")], DOC))
    assert [r.doc_id for r in nothing.collect()] == [1]


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in out}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.02


def test_toxicity_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", "s"), (2, "", "en", "s"), (3, "x", None, "s"), (3, "x", None, "s"), (None, "y", None, None)], DOC)
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == 5 and all(r.score == 0 and r.predicted == 0 for r in out)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.without_toxic(docs, labels.limit(0)).columns == docs.columns


def test_risk_gradient_lowers_the_risk():
    rng = np.random.default_rng(1)
    toxic, clean = [np.unique(np.append(rng.integers(0, 50, 6), 99)).astype(np.int32) for _ in range(300)], [np.unique(rng.integers(0, 50, 7)).astype(np.int32) for _ in range(2700)]
    used, weights, bias = toxicity.fit(toxic[:150], toxic[150:] + clean, 0.1)
    score = lambda x: 1 / (1 + np.exp(-(weights[np.isin(used, x)].sum() + bias)))
    assert min(map(score, toxic)) > 0.7 and max(map(score, clean)) < 0.7


# --- 3: URLs -----------------------------------------------------------------------------------------------------


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def base_rule(host, path):
    fits = [r for r in urlfilter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def test_urls_by_hand(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en", "http://Example.com/en/", "http://a.net/es/1?x=1", "http://a.net?es/", "x://y://net/fr/", "http://net/fr/\n2#a", "http://com", "http://xcom/", "http://é.com/É", "http://u@a.example.com:80/en/"]
    real = [r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    pages = spark.createDataFrame([(i, u, "t") for i, u in enumerate([*odd, *real, *real[:3]])], "page_id long, url string, tokens string")
    out = rows_of(urlfilter.judge_urls(pages), "page_id")
    assert len(out) == len(odd) + len(real) + 3
    for i, u in enumerate([*odd, *real]):
        host, path = host_path(u)
        rule = base_rule(host, path)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule and rule[0] + rule[1]), u
        assert out[i]["verdict"] == (rule[2] if rule else out[i]["verdict"]) and out[i]["verdict"] in ("allow", "block")
    assert urlfilter.judge_urls(pages.limit(0)).count() == 0


def test_mined_rules_equal_counting(spark):
    sets = [(["a", "b"], "block")] * 6 + [(["a"], "allow")] * 5 + [(["b", "c"], "block")] * 3 + [(["c"], "allow")] * 6
    rules = urlfilter.mined_rules(spark.createDataFrame(sets, "tokens array<string>, verdict string"), 0.1, 0.6)
    got = {(r[0], r[1]): (round(r[2], 6), round(r[3], 6)) for r in rules}
    want = {}
    for combo in [("a",), ("b",), ("c",), ("a", "b"), ("b", "c")]:
        hits = [v for t, v in sets if set(combo) <= set(t)]
        for v in ("allow", "block"):
            n = hits.count(v)
            if n / len(sets) >= 0.1 and n / len(hits) >= 0.6:
                want[combo, v] = (round(n / len(hits), 6), round(n / len(sets), 6))
    # rules with a more general one at least as confident are pruned
    want = {k: x for k, x in want.items() if not any(k[1] == o[1] and set(o[0]) < set(k[0]) and y[0] >= x[0] for o, y in want.items())}
    assert got == want


# --- 9: licenses -------------------------------------------------------------------------------------------------


def test_every_label_folder_and_key_is_a_token(spark):
    url = "https://www.cheap-pills.m.example.com/a/12/deep/x.html?one=1&two=2&one=3#q?z=1"
    tokens = spark.createDataFrame([(url,)], "u string").select(urlfilter.tokens_of(F.col("u"), urlfilter.host_of(F.col("u")), urlfilter.path_of(F.col("u"))).alias("t")).first().t
    assert sorted(tokens) == sorted(["scheme=https", "end=com", "domain=example", "sub=www", "sub=cheap-pills", "sub=m", "folder=a", "folder=#", "folder=deep", "type=html", "depth=5", "key=one", "key=two"])


def test_long_left_sides_are_rules(spark):
    """Four tokens together say block; any three of them do not."""
    four = ["a", "b", "c", "d"]
    sets = [(four, "block")] * 10 + [([x for x in four if x != y], "allow") for y in four for _ in range(10)]
    rules = urlfilter.mined_rules(spark.createDataFrame(sets, "tokens array<string>, verdict string"), 0.1, 0.9)
    assert any(set(r[0]) == set(four) and r[1] == "block" for r in rules)


def brute_scan(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    found = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base_places_equal_brute_force(spark, real):
    odd = [None, "", "CC BY-NC CC BY-NC", "cc by nc by nc", "Under the MIT license under the mit license.", "xunder the mit license", "é under the mit licenseé", "Apache License,\nVersion 2.0 cc\tby\x1cnc", "under the mit"]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate([*odd, *real])], DOC)
    out = rows_of(licenses.license_scan(docs))
    for i, t in enumerate([*odd, *real]):
        assert tuple(out[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute_scan(t), t
        assert set(out[i]["base_labels"].split(",")) - {""} <= set(out[i]["labels"].split(",")) and 0 <= out[i]["score"] <= 1
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_license_expressions():
    post = licenses.to_postfix
    assert post("MIT OR Apache-2.0 AND ISC") == ["mit", "apache-2.0", "isc", "and", "or"]
    assert post("(MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND ISC */") == ["mit", "gpl-2.0-only", "classpath-exception-2.0", "with", "or", "isc", "and"]
    assert post("AND MIT") is None and post("") is None and post("MIT OR") == ["mit"] and post("(MIT") is None
    assert licenses.evaluate(post("GPL-3.0-only OR MIT")) == ({"gpl-3.0-only", "mit"}, True)
    assert licenses.evaluate(post("GPL-3.0-only AND MIT")) == ({"gpl-3.0-only", "mit"}, False)
    scan = licenses.scan("// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode")
    assert scan[5] == "apache-2,mit" and scan[6] == 1.0 and scan[7] is True
    assert licenses.scan("spdx license identifier")[6] == 0.5


# --- 10: exact copies --------------------------------------------------------------------------------------------


def test_exact_groups_equal_grouping(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghij klmnop\n") for _ in range(60_000))
    base = ["a b\tc", "abc", " a\x0bb\x0cc\r\n", None, "", " ", "abd", long, long.replace(" ", "  "), long[:-1] + "z", "漢" * 5000, "漢" * 4999, "\u00a0", "\x1c"]
    rows = [(i, t, "en", "s", 0.5, "x", 1, 2, 3, 4) for i, t in enumerate(base * 3)] + [(0, base[0], "en", "s", 0.5, "x", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, CLASH)
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    want = Counter()
    for norm, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0]))[0]
        for r in members:
            want[r[0], keep, len(members), r[0] == keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exactdedup.exact_groups(docs).collect()) == want
    kept = exactdedup.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k[0] for k in want if k[3]}
    assert exactdedup.exact_groups(docs.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "q", None, None), (None, "q", None, None), (5, "q", None, None)], DOC)
    assert sorted((str(r.doc_id), r.keep_id, r.kept) for r in exactdedup.exact_groups(alone).collect()) == [("5", 5, True), ("None", 5, False), ("None", 5, False)]


def test_chunks_are_deduplicated_to_identifiers(spark):
    one, two = "kanawaterkanalpaper" * 60, "слово, ещё слово. И другое; " * 90
    texts = [one + two, " ".join(one + two), two + one, one, one, two[:-9], "", None, "alone in the world " * 70]
    rows = exactdedup.recipes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).withColumnRenamed("doc_id", "row")
    cuts = {r.row: [bytes(c) for c in r.recipe] for r in rows.collect()}
    places = Counter(c for chunks in cuts.values() for c in chunks)
    lists = {r.row: r.ids for r in exactdedup.identifier_lists(rows).collect()}
    assert set(lists) == {r for r, chunks in cuts.items() if chunks and all(places[c] > 1 for c in chunks)} and {0, 1, 3, 4} <= set(lists)
    name = {}
    assert all(name.setdefault(c, i) == i for r in lists for c, i in zip(cuts[r], lists[r], strict=True))
    assert len(set(name.values())) == len(name)  # one identifier a chunk, another chunk another identifier
    assert lists[0] == lists[1] and lists[3] == lists[4] and len(cuts[2]) > 2  # other scripts are cut by content too
    assert exactdedup.identifier_lists(rows.limit(0)).count() == 0


def test_one_row_of_each_exact_group_stays(spark):
    rows = [(1, "a b", "en", "s")] * 50 + [(1, "a  b", "en", "s"), (1, "c", "en", "s"), (2, "ab", "de", "s"), (None, "ab", "en", "s"), (None, "c", "en", "s")]
    rows += [(None, "d", "en", "s")] * 3 + [(None, "d ", "fr", "s")] + [(3, "", "en", "s"), (3, "", "de", "s"), (4, None, "en", "s"), (5, "e", "en", "s")]
    for docs in (spark.createDataFrame(rows, DOC), spark.createDataFrame(rows[::-1], DOC).repartition(7)):
        got = sorted((str(r.doc_id), r.text, r.lang) for r in exactdedup.keep_one(docs).collect())
        assert got == sorted([("1", "a  b", "en"), ("1", "c", "en"), ("None", "d ", "fr"), ("3", "", "de"), ("5", "e", "en")])


def test_recipes_are_whole_texts(spark):
    df = spark.createDataFrame([("x" * 9000 + "kansa" + "y" * 700,), ("",), ("short",)], "t string")
    pattern = f"(?s).{{{exactdedup.MIN_CHUNK},{exactdedup.MAX_CHUNK}}}?{exactdedup.BOUNDARY}|.{{1,{exactdedup.MAX_CHUNK}}}"
    out = df.select("t", F.regexp_extract_all("t", F.lit(pattern), F.lit(0)).alias("c"), F.size(exactdedup.recipe(F.col("t"))).alias("n")).collect()
    assert all("".join(r.c) == r.t and len(r.c) == r.n for r in out)


# --- 8: near copies ----------------------------------------------------------------------------------------------


def near_family(rng, n, words=120, edits=2):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def brute_components(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_near_groups_equal_brute_force(spark):
    rng = random.Random(8)
    found = [t for size in (2, 3, 12, 60) for t in near_family(rng, size, edits=3)] + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    found += ["one two", "one two", "One, two!", "one two three", found[0], found[0].upper()]
    rows = [(i, t, "en", "s", 0.5, "x", 1, 2, 3, 4) for i, t in enumerate(found)] + [(1000, None, *[None] * 8), (1001, "", *[None] * 8), (None, "one two", *[None] * 8), (1002, "...", *[None] * 8)]
    docs = spark.createDataFrame(rows, CLASH)
    out = minhash.near_groups(docs)
    got = [r.asDict() for r in out.collect()]
    assert len(got) == len(rows)
    df = Counter(b for t in [r[1] for r in rows] for b in {int(x) % minhash.BUCKETS for x in shingle_hashes(t)})
    def weighted(t):
        return {int(k): (1 + math.log(n)) * (1 + math.log((1 + len(rows)) / (1 + df[int(k) % minhash.BUCKETS])) / math.log(minhash.BUCKETS)) for k, n in Counter(shingle_hashes(t).tolist()).items()}
    sets = {i: weighted(t) for i, t in enumerate(found)}
    def sim(a, b):
        low = sum(min(w, b[k]) for k, w in a.items() if k in b)
        return low / (sum(a.values()) + sum(b.values()) - low)
    links = [(a, b) for a in sets for b in sets if a < b and sim(sets[a], sets[b]) >= minhash.THRESHOLD]
    root = brute_components(list(sets), links)
    own = {r["doc_id"]: r for r in got}
    assert {i: own[i]["component_id"] for i in root} == root
    assert all(own[i]["kept"] for i in (1000, 1001, 1002, None))
    assert minhash.near_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_document_frequencies_are_exact(spark, parts):
    """Every run's df is its number of documents, with far more runs than BUCKETS, over copies, nulls and blocks."""
    rng = random.Random(5)
    found = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(20_000)) for _ in range(16)]
    found += [t for n in (2, 9) for t in near_family(rng, n)] * 2 + [None, "", "a b", "a b", "a b a b a b a b", "..."]
    df = Counter(k for t in found for k in set(shingle_hashes(t).tolist()))
    assert len(df) > minhash.BUCKETS
    classes = defaultdict(set)
    for t in found:
        runs, counts = minhash.counted(t)
        name = minhash.set_hashes(runs, counts) if len(runs) else None
        for k in runs.tolist():
            classes[k].add(name)
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(found)], "doc_id long, own long, text string").repartition(3)
    dealt = minhash.runs_and_documents(docs, parts, held_runs=2000)
    got = {}
    for r in dealt.where("part >= 0").collect():
        for k, n in zip(np.frombuffer(r.runs, np.uint64).tolist(), np.frombuffer(r.n, np.int64).tolist(), strict=True):
            assert got.setdefault(k, n) == n
    assert {k: n >> 1 for k, n in got.items()} == {k: n for k, n in df.items() if n > 1}
    assert all(n & 1 for k, n in got.items() if len(classes[k]) > 1)  # else a class might be left out wrongly
    rows = {r.doc_id: r for r in minhash.documents_of(dealt).collect()}
    assert sorted(rows) == list(range(len(found)))
    for i, t in enumerate(found):
        runs, counts = minhash.counted(t)
        assert rows[i].n == len(runs) and (rows[i].one, rows[i].two) == (minhash.set_hashes(runs, counts) if len(runs) else (None, None))


def test_only_classes_that_can_be_like_another_are_sketched(spark):
    rng = random.Random(7)
    alone = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(20)]
    pair = near_family(rng, 2, edits=1)
    texts = spark.createDataFrame(list(enumerate([*alone, *pair, alone[0]])), "doc_id long, text string").withColumn("own", F.xxhash64("text"))
    dealt = minhash.cut(minhash.runs_and_documents(texts, 3))
    rows = minhash.documents_of(dealt).join(texts, ["doc_id", "own"]).where("doc_id < 22").select("block", "rep", "text")
    left = {r.text for r in minhash.sketches(rows, dealt, 23, minhash.THRESHOLD).collect()}
    assert set(pair) <= left <= {*pair, alone[0]}


def test_one_row_of_each_near_group_stays(spark):
    rng = random.Random(3)
    (a, b), (c,) = near_family(rng, 2, edits=1), near_family(rng, 1)
    rows = [(1, a, "en", "s")] * 40 + [(1, a.upper() + "!", "en", "s"), (1, c, "en", "s"), (1, c, "de", "s"), (2, b, "en", "s"), (2, b, "en", "s"), (3, c + " x", "en", "s"), (7, "", "en", "s")]
    got = sorted((r.doc_id, r.text, r.lang) for r in minhash.keep_one(spark.createDataFrame(rows, DOC)).collect())
    assert got == sorted([(1, a.upper() + "!", "en"), (1, c, "de"), (7, "", "en")])
    assert minhash.keep_one(spark.createDataFrame([], DOC)).count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_unsettled_buckets_are_compared_to_the_end(spark, monkeypatch, block):
    """A bucket whose first leader is like none of two other groups: both are still found, also in pairs of blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(4)
    a, b, c = (near_family(rng, n, edits=1) for n in (6, 5, 1))
    texts = [*c, *a, *b]
    t = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    members = t.select(F.lit(1).cast("long").alias("bucket"), F.col("id").alias("rep"))
    root = {r.vertex: r.root for r in minhash.linked(members, t, np.ones(minhash.BUCKETS), 0.8).collect()}
    assert root == {**dict.fromkeys(range(1, 7), 1), **dict.fromkeys(range(7, 12), 7)}


def test_cross_links_equal_all_pairs():
    rng = random.Random(9)
    texts = [t for n in (1, 2, 5, 9) for t in near_family(rng, n, words=60, edits=4)]
    idf = np.ones(minhash.BUCKETS)
    sets = [(r, minhash.weights(c, r, idf)) for r, c in map(minhash.counted, texts)]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if minhash.similarity(sets[a], sets[b]) >= 0.8]
    roots = list(range(len(texts)))
    roots[-1] = roots[-2] = roots[-3]
    known = [(a, b) for a in range(len(roots)) for b in range(a) if roots[a] == roots[b]]
    got = minhash.cross_links(list(range(len(texts))), roots, [0] * len(texts), texts, idf, 0.8)
    assert brute_components(range(len(texts)), got + known) == brute_components(range(len(texts)), links + known)


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(0)
    same = total = 0
    want = []
    for _ in range(150):
        runs = np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64))
        w = rng.uniform(0.5, 3, len(runs))
        v = w * rng.uniform(0.6, 1.4, len(runs))
        x, y = minhash.samples(runs[:35], w[:35]), minhash.samples(runs[5:], v[5:])
        same, total = same + (x == y).sum(), total + len(x)
        want.append(minhash.similarity((runs[:35], w[:35]), (runs[5:], v[5:])))
    assert abs(same / total - np.mean(want)) < 0.03


def test_word_hashes_follow_words():
    assert word_bytes("A b,C\u00a0d1") == "a b c\u00a0d1".encode()
    a, b = shingle_hashes("one two three four five six"), shingle_hashes("zero ONE, two three (four) five")
    assert len(a) == 2 and len(set(a.tolist()) & set(b.tolist())) == 1 and len(shingle_hashes("")) == 0


# --- 7: vectors --------------------------------------------------------------------------------------------------


def test_vector_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embdedup, "CELL_ROOT", 1)  # many cells, so that links cross their borders
    monkeypatch.setattr(embdedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 8))
    x = np.concatenate([centres[rng.integers(0, 30, 300)] + rng.normal(scale=0.3, size=(300, 8)), centres[:1] + rng.normal(scale=0.05, size=(60, 8))])
    x[10] = x[11]
    x[12] = x[11] * 3
    rows = [(i, v.tolist(), int(i % 3 == 0), "c") for i, v in enumerate(x)]
    rows += [(900, None, 1, "c"), (901, [0.0] * 8, 1, "c"), (902, [float("nan")] * 8, 1, "c"), (903, [None] * 8, 1, "c"), (904, x[0].tolist(), None, "c"), (905, [], 1, "c"), (906, x[0][:4].tolist(), 1, "c"), (None, x[0].tolist(), 1, "c"), (907, [float("inf")] * 8, 1, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cell string")
    out = embdedup.vector_groups(df)
    got = rows_of(out, "vec_id")
    assert len(got) == len(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(len(x)) % 3 == 0
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    root = brute_components(range(len(x)), np.argwhere(np.triu(linked)).tolist())
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum(), root[i], root[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904, 905, 906, 907, None))
    assert embdedup.vector_groups(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(50, 49), (49, 48), (None, 3), (7, 7)]
    got = {r.vertex: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(1, 40), 1), **dict.fromkeys((48, 49, 50), 48)}


# --- 5: packing --------------------------------------------------------------------------------------------------


def brute_best_fit(sizes, conflicts, capacity):
    left, held, out = [], [], []
    for size, own in zip(sizes, conflicts, strict=True):
        own = {c for c in own if c >= 0}
        fits = [b for b in range(len(left)) if left[b] >= size and not held[b] & own]
        best = min(fits, key=lambda b: left[b], default=None)
        if best is None:
            left.append(capacity)
            held.append(set())
            best = len(left) - 1
        left[best] -= size
        held[best] |= own
        out.append(best)
    return out, left


def test_best_fit_is_as_tight_as_brute_force():
    rng = random.Random(6)
    for _ in range(20):
        n = rng.randrange(1, 200)
        sizes = sorted((rng.randrange(1, 101) for _ in range(n)), reverse=True)
        conflicts = [(rng.choice((-1, 0, 0, 0, 1, 2, 70)), rng.choice((-1, -1, 80, 81))) for _ in range(n)]
        bins, n_bins = packing.best_fit(np.array(sizes), np.array(conflicts), 100)
        room = [100] * n_bins
        seen = defaultdict(list)
        for size, own, b in zip(sizes, conflicts, bins, strict=True):
            # no open bin was both tighter and compatible when the item came
            tightest = min((room[x] for x in range(n_bins) if (x in seen) and room[x] >= size and not {c for c in own if c >= 0} & {c for o in seen[x] for c in o}), default=100)
            assert room[b] == tightest
            room[b] -= size
            seen[b].append(own)
        assert min(room) >= 0 and len(brute_best_fit(sizes, conflicts, 100)[1]) == pytest.approx(n_bins, abs=max(2, n_bins * 0.05))


def test_packing_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", None), (9002, "", None, "src0"), (None, "x y", None, "src0"), (9003, "é" * 30_000, None, None), (9004, "same", None, "a"), (9004, "same", None, "a"), (9005, "sa me", None, "b")], DOC)
    every = docs.select("doc_id", "text", "lang", "source").unionByName(odd)
    out = packing.pack(every, capacity=4000).collect()
    lengths = Counter()
    for r in out:
        lengths[r.doc_id] += r.length
    want = Counter()
    for r in every.collect():
        want[r.doc_id] += len((r.text or "").encode())
    assert lengths == want
    text = {r.doc_id: r for r in every.collect()}
    bins = defaultdict(list)
    for r in out:
        if r.bin is None:
            assert r.length == 0
        else:
            bins[r.shard, r.bin].append(r)
    for held in bins.values():
        assert sum(r.length for r in held) <= 4000
        sources = [text[r.doc_id].source for r in held if text[r.doc_id].source is not None]
        norms = [re.sub(r"[\x20\x09-\x0D]", "", text[r.doc_id].text) for r in held]
        assert len(sources) == len(set(sources)) and len(norms) == len(set(norms))
    assert packing.pack(every.limit(0)).count() == 0
