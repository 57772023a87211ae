"""URL rules over merged items, packing of repeated rows, known license identifiers."""

import random
from collections import Counter, defaultdict
from itertools import combinations

from trendspark.llm import licenses, packing, urlfilter

SETS = "tokens array<string>, verdict string"


def brute_rules(sets, min_support, min_confidence):
    """Every rule of every set of tokens, pruned by more general ones, with (confidence, support)."""
    found = {}
    for combo in {c for t, _ in sets for k in range(1, len(t) + 1) for c in combinations(sorted(t), k)}:
        hits = Counter(v for t, v in sets if set(combo) <= set(t))
        for v, n in hits.items():
            if n / len(sets) >= min_support and n / hits.total() >= min_confidence:
                found[combo, v] = (n / hits.total(), n / len(sets))
    return {k: x for k, x in found.items() if not any(k[1] == o[1] and set(o[0]) < set(k[0]) and y[0] >= x[0] for o, y in found.items())}


def brute_choice(tokens, rules):
    """The most confident rule within ``tokens``, then support, fewer tokens, the tokens' text."""
    return max(((c, s, -len(k), k, v) for (k, v), (c, s) in rules.items() if set(k) <= set(tokens)), default=None)


def random_sets(seed):
    """Pages of a few tokens: some always together, one on all pages, some with one label only."""
    rng, out = random.Random(seed), []
    for _ in range(120):
        own = {"all"} | {t for t in "abcd" if rng.random() < 0.5}
        own |= {"e", "f", "g"} if rng.random() < 0.4 else set()
        own |= {"sure"} if (block := rng.random() < 0.3 + 0.5 * ("a" in own and "b" in own)) and rng.random() < 0.4 else set()
        out.append((sorted(own, key=lambda _: rng.random()), "block" if block else "allow"))
    return out


def test_merged_rules_equal_brute_force(spark):
    for seed in range(3):
        sets = random_sets(seed)
        got = {(r[0], r[1]): r[2:] for r in urlfilter.mined_rules(spark.createDataFrame(sets, SETS), 0.05, 0.6)}
        want = brute_rules(sets, 0.05, 0.6)
        assert got.keys() == want.keys() and len(got) > 5
        assert all(abs(got[k][i] - want[k][i]) < 1e-12 for k in want for i in (0, 1))


def test_the_chosen_rule_equals_brute_force(spark):
    """Whole path: labelled hosts teach, unlabelled ones get the best rule that brute force finds."""
    rng, rows = random.Random(5), []
    for i in range(600):
        host = rng.choice(["a.com", "b.net", "shop.org", "news.info"])
        folders = [f for f in ("es", "x", "y", "deep", "deeper") if rng.random() < 0.5]
        rows.append((i, f"http://{host}/{'/'.join([*folders, 'p'])}?{rng.choice(['id=1', 'ref=2', ''])}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [("com", "/", "allow"), ("net", "/es/", "block"), ("net", "/x/", "block"), ("net", "/y", "allow")]
    out = {r.page_id: r for r in urlfilter.judge_urls(pages, rules, 0.03, 0.8).collect()}
    url = urlfilter.F.col("url")
    tokens = {r.page_id: r.t for r in pages.select("page_id", urlfilter.tokens_of(url, urlfilter.host_of(url), urlfilter.path_of(url)).alias("t")).collect()}
    sets = [(tokens[i], r.verdict) for i, r in out.items() if r.rule is not None]
    mined = brute_rules(sets, 0.03, 0.8)
    judged = 0
    for i, r in out.items():
        if r.rule is None and (best := brute_choice(tokens[i], mined)):
            assert (tuple(r.mined_tokens), r.verdict) == (best[3], best[4]) and abs(r.confidence - best[0]) < 1e-12, rows[i]
            judged += 1
    assert judged > 100


def test_a_popular_deep_url_is_one_item(spark):
    deep = "http://a.com/" + "/".join(f"f{k}" for k in range(40)) + "/x"
    rows = [(i, deep if i % 20 == 0 else f"http://{'a.com' if i % 2 else 'b.net'}/es/{i % 7}/p") for i in range(400)]
    mixed = [(1000 + i, f"http://{'c.com/m0' if i % 2 else 'c.net/es/m0'}/" + "/".join(f"m{k}" for k in range(1, 40)) + "/x") for i in range(40)]
    out = urlfilter.judge_urls(spark.createDataFrame([*rows, *mixed], "page_id long, url string")).collect()
    assert len(out) == 440 and {r.verdict for r in out} == {"allow", "block"}


def test_labels_of_one_kind_and_none(spark):
    one = urlfilter.mined_rules(spark.createDataFrame([(["a", "b"], "block")] * 3, SETS), 0.1, 0.8)
    assert {(r[0], r[1], r[2]) for r in one} == {(("a",), "block", 1.0), (("b",), "block", 1.0)}
    assert urlfilter.mined_rules(spark.createDataFrame([([], "block"), ([], "allow")], SETS), 0.1, 0.8) == []


def test_repeated_rows_are_dealt_round_all_shards(spark):
    n = 40_000
    rows = spark.range(n).selectExpr("if(id < 30000, 7L, CAST(NULL AS LONG)) AS doc_id", "'same text' AS text", "if(id < 30000, 's', CAST(NULL AS STRING)) AS source")
    out = packing.pack(rows).collect()
    shards = Counter(r.shard for r in out)
    assert len(out) == n and len(shards) == 10 and max(shards.values()) - min(shards.values()) <= 2
    assert Counter(r.doc_id for r in out) == {7: 30_000, None: 10_000}
    bins = defaultdict(int)
    for r in out:
        bins[r.shard, r.bin] += 1
    assert set(bins.values()) == {1}  # one cluster: no bin may hold two


def test_only_known_identifiers_are_labels():
    label = lambda text: licenses.scan(text)[5:7]
    assert label("SPDX-License-Identifier: the file header") == ("", 0.5)
    assert label("License: MIT OR Apache-2.0") == ("apache-2,mit", 1.0)
    assert label("license: see the file") == ("", 0.0) and label("License: ") == ("", 0.0)
    assert label("Licensed under the BSD 3-Clause License.") == ("bsd-3-clause", 0.6)
    assert label("SPDX-License-Identifier: LicenseRef-Own-1 AND GPL-2.0+.") == ("gpl-2.0+,licenseref-own-1", 1.0)
    assert label("SPDX-License-Identifier: GPL-2.0-only WITH nothing") == ("gpl-2.0-only", 1.0)
    assert label("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0") == ("gpl-2.0-only", 1.0)
    assert label("a license to fish") == ("", 0.0)
    for family in ("mit", "0bsd", "bsd-3-clause", "agpl-3.0-or-later", "cc-by-nc-sa-4.0", "unicode-dfs-2016", "mpl-2.0"):
        assert licenses.KNOWN.fullmatch(family)
    assert not licenses.KNOWN.fullmatch("the") and not licenses.KNOWN.fullmatch("mit-9")
