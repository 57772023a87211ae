"""Cross-tokenizer alignment against the libraries and plain sets of ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from trendspark.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string"


def plain(texts):
    """The rows of the contract, from the sets of byte offsets at which tokens end."""
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(align.byte_letters())}
    docs = []
    for text in texts:
        a, b = [], []
        if text:
            a = [(i, bytes(letters[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
            for i in model.encode(text):
                p = model.id_to_piece(i)
                b.append((i, bytes.fromhex(p[3:5]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()))
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a, b = [], []

        def ends(side):
            out, at = [], 0
            for i, x in side:
                at += len(x)
                out.append((at, i))
            return out

        ea, eb = ends(a), ends(b)
        common = sorted({x for x, _ in ea} & {x for x, _ in eb})
        groups, low = [], 0
        for high in common:
            groups.append(([i for x, i in ea if low < x <= high], [i for x, i in eb if low < x <= high]))
            low = high
        docs.append((len(a), len(b), groups))
    held = Counter(p for _, _, groups in docs for p in {(x, y) for g, h in groups for x in g for y in h})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for n_a, n_b, groups in docs:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(6)
    pool = "aabc  \n\t'sé漢字😀0123!?=-▁<|endoftext|>　\x85\x00"
    odd = ["".join(rng.choice(pool) for _ in range(rng.randrange(90))) for _ in range(60)]
    odd += [None, "", " ", "a", "<|endoftext|> x <s>", "  a  b", "▁a", "=" * 3000, "ab" * 1500, " " * 2500, "-=" * 700, "x\n" * 300]
    return odd + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]


def got(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("block_links", [1, 500, align.BLOCK_LINKS])
def test_rows_equal_plain_sets(spark, texts, block_links):
    assert got(align.alignment(spark.createDataFrame(list(enumerate(texts)), DOC), A, B, block_links)) == plain(texts)


def test_common_ends_at_every_shift():
    rng = random.Random(3)
    for _ in range(300):
        last = rng.randrange(1, 120)
        a, b = (sorted({last, *rng.sample(range(1, last + 1), rng.randrange(last))}) for _ in range(2))
        if rng.random() < 0.5:  # long stretches one to one
            a, b = ([*range(1, 200), *(199 + x for x in side), *range(200 + last, 300 + last)] for side in (a, b))
        upto_a, upto_b = align.aligned(np.array(a), np.array(b))
        common = sorted(set(a) & set(b))
        assert [a[i - 1] for i in upto_a] == common == [b[j - 1] for j in upto_b]


def test_wide_groups_link_by_distinct_ids(monkeypatch):
    s = align.sides(A, B)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 40, 300), rng.integers(0, 30, 200)
    upto = np.array([100, 101, 300]), np.array([90, 150, 200])
    wide = s.links(a, b, *upto)
    monkeypatch.setattr(align, "WIDE", 1 << 30)
    assert all((x == y).all() for x, y in zip(wide, s.links(a, b, *upto)))


def test_groups_are_spans_of_both_sides(spark, texts):
    s = align.sides(A, B)
    for r in align.groups(spark.createDataFrame(list(enumerate(texts)), DOC), A, B).collect():
        low_a = low_b = 0
        for i, j in zip(r.upto_a, r.upto_b, strict=True):
            assert b"".join(s.bytes_a[x] for x in r.ids_a[low_a:i]) == b"".join(s.bytes_b[x] for x in r.ids_b[low_b:j]) != b""
            low_a, low_b = i, j
        assert (low_a, low_b) == (len(r.ids_a), len(r.ids_b))


def test_awkward_tables(spark):
    clash = "doc_id long, text string, block long, pair long, ids string, n int, count int, best string"
    rows = [(1, "the same text", 1, 2, "x", 3, 4, "y")] * 3 + [(None, "the same text", None, None, None, None, None, None), (2, None, 1, 1, "", 1, 1, "")]
    want = plain([r[1] for r in rows])
    found = align.alignment(spark.createDataFrame(rows, clash), A, B).collect()
    assert sorted(map(repr, (tuple(r)[1:] for r in found))) == sorted(map(repr, want))
    assert sorted(str(r.doc_id) for r in found) == ["1", "1", "1", "2", "None"] and [r.count_sum for r in found if r.doc_id == 1] == [12] * 3
    assert align.alignment(spark.createDataFrame([], DOC), A, B).collect() == []
