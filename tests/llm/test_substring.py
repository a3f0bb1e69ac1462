from __future__ import annotations

import hashlib
import re
from collections import Counter

import frames
import numpy as np
import pytest

from salesloom.llm import substring


def expected(rows, width=35):
    """Brute force: per row (doc_id, n_words, n_removed, kept_sha256)."""
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + width]) for _, w in texts for k in range(len(w) - width + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def result(spark, frame, width=35):
    found = substring.factored(spark, frame, width).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return Counter(tuple(r) for r in found.collect())


def test_equals_brute_force(shipped):
    frame = frames.clashing(frames.documents(shipped))
    assert result(shipped, frame) == expected([r[:2] for r in frames.rows()])


@pytest.mark.parametrize("seed", [1, 2])
def test_few_words_repeat_in_many_ways(shipped, seed):
    chance = np.random.default_rng(seed)
    rows = [(k, " ".join(f"{x}" for x in chance.integers(0, 2, chance.integers(5, 60)))) for k in range(80)]
    rows += [(100 + k, "a b " * k) for k in range(1, 30, 4)] + [(200 + k, "a " * k) for k in range(10, 18)]
    frame = shipped.createDataFrame(rows, "doc_id long, text string")
    assert result(shipped, frame, width=12) == expected(rows, width=12)


def test_factors_name_a_place_with_the_same_words(shipped):
    rows = frames.rows()
    frame = frames.documents(shipped).where("doc_id < 300").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: (r["text"] or "").split() for r in frame.collect()}
    factors = [(r["doc_id"], f) for r in substring.factored(shipped, frame).collect() for f in r["factors"] or ()]
    assert len(factors) > 50 and rows
    for doc_id, f in factors:
        assert f["length"] >= 35
        assert (doc_id, f["start"]) != (f["ref_doc_id"], f["ref_start"])
        first = slice(f["start"], f["start"] + 35)
        there = slice(f["ref_start"], f["ref_start"] + 35)
        assert texts[doc_id][first] == texts[f["ref_doc_id"]][there]


def test_rows_and_columns_stay(shipped):
    frame = frames.clashing(frames.documents(shipped))
    out = substring.without_repeats(shipped, frame)
    assert out.columns == frame.columns
    kept = {(r["doc_id"], r["source"]): r["text"] for r in out.collect()}
    assert out.count() == frame.count()
    assert kept[6, "s"] is None and kept[8, "s"] == " \n\t " and kept[200, "s"] == "" and kept[9, "s"] == "one two"


def test_empty_table(shipped):
    assert substring.factored(shipped, frames.none(shipped)).count() == 0
    assert substring.without_repeats(shipped, frames.none(shipped)).count() == 0
