"""URL verdicts from host rules and mined association rules (operator 3).

Method: pages that a host rule judges are the labelled ones. Spark's FP-growth mines combinations of URL tokens
together with the label; combinations that imply a label with enough confidence and support become rules, and a rule
with a more general rule at least as confident is pruned. Rules are matched through an inverted index: each is posted
under its rarest token, and a URL only looks at the postings of its own tokens. The most confident rule decides
(then support, then fewer tokens, then the tokens' text); without any, the label that most labelled pages have, or
``allow`` if there are none.

Before mining, tokens that are on the same labelled pages become one item, and tokens that leave the mining are those
whose pages all have one label and those that all pages have: a longer left side with one of them is never more
confident than a shorter one. Both steps lose no rule, and a popular deep URL costs a few items, not every
combination of its folders. A rule of merged items holds for every choice of a token of each.

Every label of the host, folder of the path and key of the query is a token. The work is bounded by the support
alone: a token takes part only if it is frequent over all labelled pages, and left sides have any length.

Results: null URLs and those without ``://`` have an empty host and path and no token, and get the default verdict;
repeated rows are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import product

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import arrow_map, cut

#: Fixed values: (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The text and verdict of the longest rule that fits, as a struct; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The URL's tokens, each once: scheme; ending, domain and every label before it of the host; every folder, file type
    and depth of the path; every key of the query. Parts that a URL lacks give none."""
    labels = F.split(host, r"\.")
    folders = F.split(path, "/")
    extension = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)="), F.lit(1))
    one = [
        F.concat(F.lit("scheme="), F.regexp_extract(url, r"^([A-Za-z]{1,8})://", 1)),
        F.concat(F.lit("end="), F.element_at(labels, -1)),
        F.when(F.size(labels) > 1, F.concat(F.lit("domain="), F.element_at(labels, -2))),
        F.when(extension != "", F.concat(F.lit("type="), extension)),
        F.concat(F.lit("depth="), F.least(F.size(folders), F.lit(9)).cast("string")),
    ]
    subs = F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), lambda x: F.concat(F.lit("sub="), x))
    inner = F.filter(F.slice(folders, 2, F.greatest(F.size(folders) - 2, F.lit(0))), lambda x: x != "")
    inner = F.transform(inner, lambda x: F.concat(F.lit("folder="), F.when(x.rlike(r"^\d+$"), F.lit("#")).otherwise(x)))
    parts = F.concat(F.array_compact(F.array(*one)), subs, inner, F.transform(keys, lambda x: F.concat(F.lit("key="), x)))
    return F.when(host != "", F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def closed_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> list[tuple]:
    """(groups, verdict, confidence, support, rarest group) of the pruned rules; ``labelled`` has tokens and verdict. A
    group holds the tokens that are on the same labelled pages; a rule holds where a URL has a token of each group."""
    shares = {r["verdict"]: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    total = sum(shares.values())
    least = max(1, math.ceil(min_support * total))
    sets = labelled.select(F.array_sort("tokens").alias("tokens"), "verdict").groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n"))
    # equal sets of pages have equal order-free hashes of their distinct kinds of pages
    marked = sets.select(F.explode("tokens").alias("token"), "n", "verdict", F.xxhash64("tokens", "verdict").alias("one"), F.xxhash64(F.lit("second"), "verdict", "tokens").alias("two"))
    tokens = marked.groupBy("token").agg(F.sum("n").alias("n"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"), F.min("verdict").alias("low"), F.max("verdict").alias("high"))
    alike: dict[tuple, list[str]] = defaultdict(list)
    for r in tokens.where(F.col("n") >= least).collect():  # at most (tokens a page) / min_support
        alike[r["n"], r["one"], r["two"], r["low"], r["high"]].append(r["token"])
    groups = {min(found): (tuple(sorted(found)), key[0]) for key, found in alike.items()}
    rules, name = [], {}
    for (n, _, _, low, high), found in alike.items():
        if low == high:  # sure alone: no longer left side is more confident
            rules.append(((min(found),), low, 1.0, n / total))
        elif n == total:  # on all pages: adds nothing to any left side
            rules += [((min(found),), v, m / total, m / total) for v, m in shares.items() if m >= least]
        else:
            name.update((t, min(found)) for t in found)
    if name:

        def items(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array([[*sorted({name[t] for t in own if t in name}), f"verdict={v}"] for own, v in rows], pa.list_(pa.string()))], ["items"])

        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(arrow_map(labelled.select("tokens", "verdict"), items, "items array<string>"))
        for r in model.associationRules.where(F.col("consequent")[0].startswith("verdict=")).collect():
            rules.append((tuple(sorted(r["antecedent"])), r["consequent"][0].removeprefix("verdict="), r["confidence"], r["support"]))
    kept: dict[str, list[tuple]] = defaultdict(list)
    for rule in sorted((r for r in rules if r[2] >= min_confidence), key=lambda r: (len(r[0]), -r[2], r[0])):
        if not any(set(k[0]) <= set(rule[0]) and k[2] >= rule[2] for k in kept[rule[1]]):
            kept[rule[1]].append(rule)
    return [(tuple(groups[t][0] for t in r[0]), *r[1:], groups[min(r[0], key=lambda t: (groups[t][1], t))][0]) for rules in kept.values() for r in rules]


def mined_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> list[tuple]:
    """The rules of ``closed_rules`` spelled out, for reports over few rules: (tokens, verdict, confidence, support)."""
    found = closed_rules(labelled, min_support, min_confidence)
    return [(tuple(sorted(tokens)), *r[1:4]) for r in found for tokens in product(*r[0])]


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    min_support: float = 0.01,
    min_confidence: float = 0.8,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the tokens and confidence of the mined rule used."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    rows = cut(rows.select("page_id", "host", "path", tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), fit["rule"].alias("rule"), fit["verdict"].alias("verdict")))
    labelled = rows.where("verdict IS NOT NULL")
    shares = {r["verdict"]: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    usual = max(shares, key=lambda v: (shares[v], v), default=DEFAULT_VERDICT)
    index: dict[str, list[tuple]] = defaultdict(list)
    if shares:
        for groups, verdict, confidence, support, rarest in closed_rules(labelled, min_support, min_confidence):
            for token in rarest:
                index[token].append((confidence, support, -len(groups), [frozenset(g) for g in groups], verdict))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        verdicts, used, sure = [], [], []
        for tokens, verdict in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True):
            best = None
            if verdict is None:
                own = set(tokens)
                held = (r for t in own for r in index.get(t, ()) if not any(own.isdisjoint(g) for g in r[3]))
                best = max(((*r[:3], sorted(max(own & g) for g in r[3]), r[4]) for r in held), default=None)
            verdicts.append(verdict or (best[4] if best else usual))
            used.append(best[3] if best else None)
            sure.append(best[0] if best else None)
        columns = [*(batch.column(i) for i in (0, 1, 2, 4)), pa.array(verdicts, pa.string()), pa.array(used, pa.list_(pa.string())), pa.array(sure, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "mined_tokens", "confidence"])

    return arrow_map(rows, run, "page_id long, host string, path string, rule string, verdict string, mined_tokens array<string>, confidence double")
