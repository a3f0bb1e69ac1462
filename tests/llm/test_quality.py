from __future__ import annotations

import resource
import time
from itertools import product

import frames
import numpy as np
import pyarrow as pa

from salesloom.llm import quality


def test_marginals_equal_brute_force():
    chance = np.random.default_rng(0)
    bounds = np.array([0, 1, 1, 5, 9, 15])
    odds, moves = chance.normal(size=15), chance.normal(size=(2, 2))
    found, left, right = quality.marginals(odds, bounds, moves)
    pairs = np.zeros((2, 2))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        total, good = 0.0, np.zeros(b - a)
        own = np.zeros((2, 2))
        for labels in product((0, 1), repeat=int(b - a)):
            weight = np.exp(sum(odds[a + k] for k, y in enumerate(labels) if y) + sum(moves[x, y] for x, y in zip(labels, labels[1:], strict=False)))
            total += weight
            good += weight * np.array(labels)
            for x, y in zip(labels, labels[1:], strict=False):
                own[x, y] += weight
        np.testing.assert_allclose(found[a:b], good / total, rtol=1e-9)
        pairs += own / total
    np.testing.assert_allclose(quality.pair_marginals(odds, bounds, moves, left, right), pairs, rtol=1e-9)


def test_neighbours_stay_inside_a_text():
    lines = quality.Lines(pa.array(["One two.\nTHREE!!", "", "x"], pa.large_string()))
    assert lines.bounds.tolist() == [0, 2, 3, 4]
    own, n = lines.features[:, : quality.OWN], quality.OWN
    np.testing.assert_array_equal(lines.features[0, 2 * n : 3 * n], own[1])
    np.testing.assert_array_equal(lines.features[1, n : 2 * n], own[0])
    assert not lines.features[2:, n : 3 * n].any()


def test_held_out_labels_are_told_apart(spark, sf_dir):
    from salesloom.llm.queries import QUERIES, table

    rows = QUERIES["op5_quality"](spark, sf_dir)
    assert rows.count() == table(spark, sf_dir, "documents").count()
    assert rows.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> cast(score >= 0.3 as int)").count() == 0
    found = rows.join(table(spark, sf_dir, "labels"), "doc_id").where("held_out")
    right = found.selectExpr("avg(cast(predicted = quality as int))").first()[0]
    assert right >= 0.95


def test_edge_cases(shipped):
    frame = frames.clashing(frames.documents(shipped))
    labels = shipped.createDataFrame(
        [(1, 1), (2, 1), (3, 1), (12, 0), (12, 1), (None, 0), (13, None), (14, 7), (17, 1)], "doc_id long, quality int"
    )
    assert quality.score(shipped, frame, labels).count() == frame.count()
    out = quality.with_scores(frame, quality.fit(shipped, frame, labels))
    assert out.columns == [*(c for c in frame.columns if c != "quality_score"), "quality_score"]
    assert quality.without_rejects(shipped, frame, labels).columns == frame.columns
    assert {r["score"] for r in quality.score(shipped, frame, labels.where("false")).collect()} == {0.5}
    assert quality.score(shipped, frames.none(shipped), labels).count() == 0


def a_field(seed: int = 0) -> quality.Field:
    chance = np.random.default_rng(seed)
    weights = chance.normal(size=quality.FEATURES)
    return quality.Field(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), weights, np.array([[1.2, -0.4], [-0.7, 1.5]]))


def test_features_in_blocks_equal_those_at_once(monkeypatch):
    texts = pa.array([r[1] or "" for r in frames.rows()] + ["a\nb\nb\n\nC!"] * 3, pa.large_string())
    whole = quality.Lines(texts)
    expected, odds = whole.features, whole.emissions(a_field())
    monkeypatch.setattr(quality, "BLOCK_LINES", 7)
    blocks = quality.Lines(texts)
    assert (blocks.features == expected).all()
    assert np.allclose(blocks.emissions(a_field()), odds)


def test_long_texts_in_pieces_get_the_same_marginals(monkeypatch):
    chance = np.random.default_rng(1)
    lengths = np.array([0, 1, 5000, 17, 9000, 4097])
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    odds = chance.normal(size=bounds[-1]) * 3
    for moves in (a_field().moves, np.zeros((2, 2)), np.array([[3.0, -3.0], [-2.0, 2.5]])):
        expected = quality.marginals(odds, bounds, moves)[0]
        monkeypatch.setattr(quality, "PIECE_LINES", 300)
        monkeypatch.setattr(quality, "BLOCK_LINES", 2_000)
        assert np.allclose(quality.walked(odds, bounds, moves), expected, rtol=0, atol=1e-10)


def test_millions_of_lines_stay_small():
    start, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = quality.scores(pa.array(["\n" * (3 << 20), "a\n" * (1 << 20)], pa.large_string()), a_field())
    assert len(found) == 2 and time.time() - start < 120
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # KB


def test_repeated_labelled_ids_are_read_once(shipped):
    rows = [(1, "good text here.\nAnd more.")] * 500 + [(2, "BAD !!!")] * 500 + [(2, "BAD ???")] + [(3, "x\n" * 1000)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    labels = shipped.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    seen = []
    fit_field = quality.fit_field
    try:
        quality.fit_field = lambda features, bounds, labels: seen.append(np.diff(bounds).tolist())
        quality.fit(shipped, docs, labels)
    finally:
        quality.fit_field = fit_field
    assert seen in ([[2, 1]], [[2]], [[1]])  # ids whose hash holds them out are not read
