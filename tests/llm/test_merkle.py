"""The Merkle manifest against a plain tree built level by level."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from trendspark.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(r, more=0):
    values = [r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def steps(tree, i):
    """(sibling or nothing, whether the node is the right one) of each level."""
    out = []
    for level in tree[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else "", i & 1))
        i >>= 1
    return out


def expected(rows):
    """The rows of the contract, sorted."""
    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for of in langs.values():
        of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {lang: levels([leaf(r) for r in langs[lang]]) for lang in order}
    whole = levels([trees[lang][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        for i, r in enumerate(langs[lang]):
            path = steps(trees[lang], i) + steps(whole, at)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            x = leaf(r, 1) if tampered else leaf(r)
            for other, right in path:
                x = H(other + x if right else x + other)
            root = whole[-1][0]
            out.append((r[0], leaf(r), trees[lang][-1][0], root, H("".join(s for s, _ in path)), x, x == root))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 13, 16, 33])
def test_log_is_postorder_and_positions_are_closed_form(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    tree = levels([x.hex() for x in leaves])
    for extra in (0, 2):  # a builder may have to go on above its only node
        height = merkle.height_of(n) + extra
        log = merkle.build(leaves, height)
        for _ in range(extra if extra == 2 and len(tree) <= height else 0):
            tree.append([H(tree[-1][0])])
        assert len(log) == len(set(range(len(log)))) == sum(map(len, tree[: height + 1]))
        seen = set()
        for level in range(height + 1):
            for i, digest in enumerate(tree[level]):
                at = merkle.position(level, i, n)
                seen.add(at)
                assert log[at].hex() == digest
                if level:  # children come before their parent
                    assert all(merkle.position(level - 1, c, n) < at for c in (2 * i, 2 * i + 1) if c < len(tree[level - 1]))
        assert seen == set(range(len(log)))


@pytest.mark.parametrize("block_levels", [1, 2, 12])
def test_proofs_equal_a_plain_tree(spark, block_levels):
    """Builders of two leaves need many tiers, for languages too; one language has a third of all rows and one a single row."""
    rng = random.Random(4)
    rows = [(i * 3, rng.choice(["a text", "", None, "漢字 é"]) , rng.choice(["en", "en", "de", "é", None, "zz"]), rng.choice(["s", None]), rng.choice([3, None, 2**63 - 1, -1])) for i in range(60)]
    rows += [rows[5], rows[5], (rows[7][0], "other", *rows[7][2:]), (None, "x", "en", None, 1), (None, "y", "en", None, 1), (7, "one", "only", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    assert got(merkle.proofs(df, block_levels)) == expected(rows)


def test_tampered_rows_fail_and_the_rest_verify(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "fr", "s", 6) for i in range(300)]
    for doc_id, *_, verified in got(merkle.proofs(spark.createDataFrame(rows, DOCS))):
        assert verified == (zlib.crc32(str(doc_id).encode()) % 7 != 0)


def test_empty_table_one_row_and_clashing_columns(spark):
    clash = DOCS + ", key string, idx long, n long, leaf string, altered string, block int, nodes string, _part int, root string"
    rows = [(i, f"t{i}", None, None, i, "k", 1, 2, "l", "a", 3, "n", 9, "r") for i in range(5)]
    assert got(merkle.proofs(spark.createDataFrame(rows, clash))) == expected([r[:5] for r in rows])
    assert got(merkle.proofs(spark.createDataFrame([], DOCS))) == []
    one = [(1, "x" * 1_000_000, "en", None, None)]
    assert got(merkle.proofs(spark.createDataFrame(one, DOCS))) == expected(one)
