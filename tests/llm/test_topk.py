from __future__ import annotations

import numpy as np
import pytest

from salesloom.llm import topk


def expected(rows, k):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    whole = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in good]
    out = []
    for i in sorted({i for i, _ in whole if i % 50 == 0}):
        own = min((v for j, v in whole if j == i), key=lambda v: (len(v), v.astype(float).tobytes()))
        hits = sorted({(-int(v @ own), j) for j, v in whole if j != i and len(v) == len(own)})[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(hits)]
    return out


@pytest.mark.parametrize("seed, spread", [(1, 1.0), (2, 30.0)])
def test_equals_brute_force(shipped, seed, spread, monkeypatch):
    chance = np.random.default_rng(seed)
    rows = [(k, (chance.normal(size=12) * spread ** chance.random()).tolist()) for k in range(400)]
    rows += [(k, rows[3][1]) for k in range(400, 460)]  # ties
    rows += [rows[50], rows[60], (500, None), (None, rows[1][1]), (550, [1.0, None]), (600, [float("nan")] * 12)]
    rows += [(650, []), (651, []), (700, [1.0, 2.0]), (701, [3.0, 4.0]), (750, [5.0]), (701, [3.0, 4.0])]
    frame = shipped.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 rank", "2 dim", "3 score")
    monkeypatch.setattr(topk, "SHELF_ROWS", 64)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    found = sorted(tuple(r) for r in topk.top_k(shipped, frame).collect())
    assert found == expected(rows, 5)


def test_search_skips_what_cannot_reach():
    chance = np.random.default_rng(0)
    vecs = np.floor(256 * chance.normal(size=(3000, 16)) * np.exp(chance.normal(size=(3000, 1))))
    queries = vecs[:20]
    ids = np.arange(3000)
    q, c, s = topk.search(ids[:20], queries, {}, ids, vecs, 5)
    for k in range(20):
        own = (vecs @ queries[k]).astype(int)
        order = sorted((-own[j], j) for j in range(3000) if j != k)[:5]
        assert sorted(zip(-s[q == k], c[q == k], strict=True)) == order


def test_large_components_are_exact():
    a = np.array([[2.0**30, 3.0]])
    assert topk._products(a, a).tolist() == [[2**60 + 9]]
    with pytest.raises(ValueError, match="64 bits"):
        topk._products(a * 8, a)


def test_empty_table(shipped):
    assert topk.top_k(shipped, shipped.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
