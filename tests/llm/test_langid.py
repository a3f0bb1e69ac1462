from __future__ import annotations

import frames
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesloom.llm import langid
from salesloom.llm.lockstep import Segments
from salesloom.llm.textops import Letters


def greedy(codes: list[int], reference: list[int], piece: int) -> int:
    """Brute-force phrases, cut every `piece` codes."""
    def inside(run):
        return any(reference[k : k + len(run)] == run for k in range(len(reference) - len(run) + 1))

    total = 0
    for first in range(0, len(codes), piece):
        part, run = codes[first : first + piece], []
        for code in part:
            if inside([*run, code]):
                run.append(code)
            else:
                total += 1
                run = [code] if inside([code]) else []
        total += bool(run)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.lists(st.lists(st.integers(0, 4), max_size=30), max_size=5))
def test_phrases_equal_brute_force(reference, texts):
    table = langid.moves(langid.SuffixAutomaton(reference, 5).table())
    codes = np.array([c for t in texts for c in t], dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    found = langid.phrases(Segments(codes, bounds, pad=5, length=8), table)
    assert found.tolist() == [greedy(t, reference, 8) for t in texts]


def test_reduced_texts():
    letters = Letters("abé")
    codes, bounds = langid.reduced(pa.array(["Ab, é!", "", "12 3", "B"], pa.large_string()), letters)
    parts = [codes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [[c for c in p if c] for p in parts] == [[1, 2, 3], [], [], [2]]


def test_held_out_accuracy(spark, sf_dir):
    from salesloom.llm.queries import QUERIES, table

    rows = QUERIES["op3_langid"](spark, sf_dir).join(table(spark, sf_dir, "documents"), "doc_id")
    found = rows.where("held_out AND lang IS NOT NULL").selectExpr("avg(cast(lang = lang_pred as int)) a", "count(*) n").first()
    assert found["n"] > 20 and found["a"] >= 0.97
    assert rows.where("score < 0 OR score > 1 OR score IS NULL OR lang_pred IS NULL").count() == 0


def test_edge_cases(shipped):
    frame = frames.clashing(frames.documents(shipped))
    out = {r["doc_id"]: r for r in langid.identify(shipped, frame).collect()}
    assert {out[k]["lang_pred"] for k in (6, 7, 8)} == {"und"}
    assert out[1]["lang_pred"] == "en"
    assert langid.identify(shipped, frame).count() == frame.count()
    assert langid.identify(shipped, frames.none(shipped)).count() == 0


def test_nothing_learned_is_und(shipped):
    frame = frames.documents(shipped).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.identify(shipped, frame).collect()} == {"und"}


@pytest.mark.parametrize("doc_id, held", [(0, None), (5, None)])
def test_held_out_follows_crc32(shipped, doc_id, held):
    import zlib

    row = shipped.range(1).selectExpr(f"{doc_id}L doc_id").select(langid.held_out("doc_id", 4, 2)).first()
    assert row[0] == (zlib.crc32(str(doc_id).encode()) % 4 == 2) and held is None
