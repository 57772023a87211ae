"""Operator 7 on labels of many blocks, by cells and by hyperplane tables, against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from trendspark.llm import embdedup


def grouped(n: int, d: int, groups: int, seed: int) -> np.ndarray:
    """float32 vectors, half of them alone, half in groups whose cosines lie on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 2] = x[rng.integers(0, groups, n // 2)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=(n, d))
    x += noise / np.linalg.norm(noise, axis=1, keepdims=True) * rng.uniform(0.02, 0.4, (n, 1))
    return rng.permutation(x * rng.uniform(0.5, 9, (n, 1))).astype(np.float32)


def brute(x: np.ndarray, threshold: float = 0.93) -> np.ndarray:
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= threshold
    np.fill_diagonal(linked, False)
    return linked


def roots(linked: np.ndarray) -> np.ndarray:
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None], len(root)).min(axis=1))
        if np.array_equal(new, root):
            return root
        root = new


@pytest.mark.parametrize("tables", [False, True])
@pytest.mark.parametrize("own,within", [(3000, True), (1000, True), (1000, False)])
def test_links_equal_brute_force(tables, own, within):
    x = grouped(3000, 64, 40, 5)
    n = np.random.default_rng(1).integers(1, 4, len(x))
    linked = brute(x)
    linked[own:, own:] = False
    if not within:
        linked[:own, :own] = False
    forest = embdedup.Forest(n)
    if tables:
        embdedup.link_by_tables(x, own, 0.93, forest, embdedup.MISS, within)
    else:
        embdedup.link_by_cells(x, np.arange(own), np.arange(own, len(x)), 0.93, forest, within)
    assert np.array_equal(forest.links, linked @ n)
    assert np.array_equal(forest.find(np.arange(len(x))), roots(linked))


def test_tables_look_at_few_pairs(monkeypatch):
    """Vectors without structure: those verified are a small part of the pairs, and every planted link is found."""
    rng = np.random.default_rng(3)
    n = 20_000
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(500, 64))
    side -= (side * x[:500]).sum(axis=1, keepdims=True) * x[:500]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[-500:] = 0.9302 * x[:500] + math.sqrt(1 - 0.9302**2) * side  # just inside the threshold
    seen = []
    plain = embdedup.unit
    monkeypatch.setattr(embdedup, "unit", lambda v: seen.append(len(v)) or plain(v))
    forest = embdedup.Forest(np.ones(n))
    embdedup.link_by_tables(x.astype(np.float32), n, 0.93, forest, embdedup.MISS)
    assert forest.links.sum() == 1000 and forest.links[:500].all() and forest.links[-500:].all()
    assert sum(seen) < 0.01 * n * n


@pytest.mark.parametrize("n", [10, 1000, 200_000, 1_000_000])
def test_chance_of_a_missed_link(n):
    k, tables, most = embdedup.tables_for(n, 0.93, 1e-12)
    side = 1 - math.acos(0.93) / math.pi
    planes = k * embdedup.TABLES
    beyond = sum(math.comb(planes, i) * (1 - side) ** i * side ** (planes - i) for i in range(most + 1, planes + 1))
    assert (1 - side**k) ** tables + tables / embdedup.TABLES * beyond <= 1e-12
    assert tables < 700 and k >= min(20, math.log2(n))


@pytest.mark.parametrize("exact", [0, 10**9])
def test_labels_of_many_blocks(spark, monkeypatch, exact):
    for name, value in {"BLOCK": 50, "EXACT": exact, "EXACT_TABLE": 0, "SHELL": 8, "CHUNK": 32}.items():
        monkeypatch.setattr(embdedup, name, value)
    x = grouped(600, 16, 12, 8)
    x[:, 3] = 0
    x[20] = x[21]
    x[22] = x[23]
    x[22, 3] = -0.0
    label = np.arange(len(x)) % 5 // 4
    rows = [(i, v.tolist(), int(label[i])) for i, v in enumerate(x)]
    rows += [(5, x[5].tolist(), int(label[5])), (7000, [0.0] * 16, 1), (7001, None, 1), (7002, x[5][:7].tolist(), 1), (None, x[5].tolist(), 1), (7003, x[5].tolist(), None)]
    out = embdedup.vector_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    at = np.append(np.arange(len(x)), 5)  # a row that comes twice
    linked = brute(x[at]) & (label[at][:, None] == label[at][None])
    root = at[roots(linked)]
    want = sorted((int(at[i]), int(linked[i].sum()), int(root[i]), bool(root[i] == at[i])) for i in range(len(at)))
    assert sorted(tuple(r) for r in out if r.vec_id is not None and r.vec_id < 7000) == want
    rest = [tuple(r) for r in out if r.vec_id is None or r.vec_id >= 7000]
    assert sorted(rest, key=str) == sorted([(None, 0, None, True), *((i, 0, i, True) for i in (7000, 7001, 7002, 7003))], key=str)
