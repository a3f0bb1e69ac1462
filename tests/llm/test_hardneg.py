from __future__ import annotations

import numpy as np
import pytest

from salesloom.llm import hardneg


def expected(rows, positives=5, negatives=3, low=50, high=95):
    """Every score of every anchor."""
    good = sorted(
        {
            (i, label, tuple(int(x) for x in np.floor(256 * np.array(v, dtype=np.float32).astype(float))))
            for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
        }
    )
    out = []
    for anchor in sorted({i for i, _, _ in good if i % 50 == 0}):
        label, own = min(
            ((lb, v) for i, lb, v in good if i == anchor),
            key=lambda x: (x[0], len(x[1]), hardneg._narrow(np.array(x[1], dtype=float)).tobytes()),
        )
        scored = {(-sum(a * b for a, b in zip(own, v, strict=True)), i, lb == label) for i, lb, v in good if i != anchor and len(v) == len(own)}
        for s, positive in sorted((s, i) for s, i, same in scored if same)[:positives]:
            inside = sorted((t, i) for t, i, same in scored if not same and -low * s <= -100 * t <= -high * s)
            out += [(anchor, positive, n + 1, i, -s, -t) for n, (t, i) in enumerate(inside[:negatives])]
    return sorted(out)


def found(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    frame = frame.selectExpr("*", "1 rank", "2 dim", "3 score", "4 place", "'x' tree")
    return sorted(tuple(r) for r in hardneg.mine(spark, frame).collect())


def near(chance, centres, n, dim, spread):
    middle = chance.normal(size=(centres, dim))
    return middle[np.arange(n) % centres] + spread * chance.normal(size=(n, dim))


@pytest.mark.parametrize("seed, spread", [(1, 0.05), (2, 3.0)])
def test_equals_brute_force(shipped, seed, spread, monkeypatch):
    chance = np.random.default_rng(seed)
    vecs = near(chance, 4, 600, 9, spread).tolist()
    rows = [(k, int(chance.integers(0, 4)), vecs[k]) for k in range(600)]
    rows += [(k, k % 3, vecs[3]) for k in range(600, 680)]  # ties
    rows += [rows[50], rows[60], rows[60], (500, 2, None), (None, 1, vecs[1]), (550, None, vecs[2]), (550, 3, [1.0, None])]
    rows += [(650, 1, []), (651, 1, []), (652, 2, []), (700, 1, [1.0, 2.0]), (701, 1, [3.0, 4.0]), (702, 2, [2.0, 3.0])]
    rows += [(750, 1, [5.0]), (800, 1, [float("nan")] * 9), (50, 3, vecs[7]), (77, 2, vecs[8]), (77, 2, vecs[9])]
    rows += [(850, 1, [-1e-3] * 9), (900, 0, [0.0] * 9), (901, 0, [200.0] * 9), (902, 1, [1e5] * 9)]
    monkeypatch.setattr(hardneg, "SHELF_ROWS", 64)
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hardneg, "TREE_ANCHORS", 5)
    assert found(shipped, rows) == expected(rows)


def test_bounds_spare_products_of_near_anchors():
    chance = np.random.default_rng(3)
    anchors = np.floor(256 * (np.array([1.0] + [0.0] * 15) + 0.002 * chance.normal(size=(50, 16))))
    vecs = np.floor(256 * chance.normal(size=(4000, 16)))
    order, parents, edges = hardneg.spanning_tree(anchors)
    anchors = anchors[order]
    windows = ([*range(50)], [100_000] * 50, [110_000] * 50)
    w, c, s, done = hardneg.search(np.arange(50), anchors, parents, edges, windows, np.arange(100, 4100), vecs, 3)
    scores = (anchors @ vecs.T).astype(int)
    for k in range(50):
        inside = sorted((-x, i + 100) for i, x in enumerate(scores[k]) if 100_000 <= x <= 110_000)[:3]
        assert sorted(zip(-s[w == k], c[w == k], strict=True)) == inside
    assert done < 0.5 * scores.size


def test_the_tree_is_a_least_one():
    points = np.random.default_rng(4).normal(size=(40, 3))
    order, parents, edges = hardneg.spanning_tree(points)
    assert sorted(order) == list(range(40))
    placed = points[order]
    assert all(parents[k] < k for k in range(40))
    assert np.allclose(edges[1:], [np.linalg.norm(placed[k] - placed[parents[k]]) for k in range(1, 40)])
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    joined, total = {0}, 0.0
    while len(joined) < 40:  # the cheapest edge out of the tree, each time
        cost, new = min((apart[a, b], b) for a in joined for b in set(range(40)) - joined)
        joined.add(new)
        total += cost
    assert np.isclose(edges.sum(), total)


def test_large_scores_are_exact(shipped):
    big = 2.0**20
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big * 0.75, 5.0]), (3, 2, [big * 0.75, 4.0]), (4, 2, [big, 2.0])]
    assert found(shipped, rows) == expected(rows) != []


def test_a_task_merges_the_hits_of_its_pairs():
    chance = np.random.default_rng(5)
    hits = chance.integers(0, 4, (4, 500))
    best = {tuple(x) for x in hardneg._best(hits, 3).T.tolist()}
    rows = {tuple(x) for x in hits.T.tolist()}
    for key in {r[:2] for r in rows}:
        own = sorted((-s, i) for a, w, i, s in rows if (a, w) == key)[:3]
        assert {(-s, i) for a, w, i, s in best if (a, w) == key} == set(own)


def test_empty_and_lonely(shipped):
    assert found(shipped, []) == []
    assert found(shipped, [(0, 1, [1.0])]) == []
    assert found(shipped, [(0, 1, [1.0]), (1, 1, [2.0])]) == []
