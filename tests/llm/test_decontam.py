from __future__ import annotations

import random

import frames
import numpy as np
import pyarrow as pa
import pytest

from salesloom.llm import decontam

ITEMS = [
    (1, "A train leaves the station with Anna Miller at 9:30 and travels 120 km to reach Boston in 3 hours, then Anna rests."),
    (2, "short item of words"),
    (3, None),
    (4, ""),
    (5, frames.text(50, 60)),
    (5, frames.text(50, 60)),
]
DOCS = [
    (1, "Intro words here. " + ITEMS[0][1] + " And more."),
    (2, "Intro words here. A train leaves the station with Peter Jones at 7:15 and travels 80 miles to reach Denver in 2 days, "
        "then Peter rests. And more."),
    (3, "A train leaves the station with Peter Jones at 7:15 and travels 80 miles to reach Denver in 2 days, then Maria rests."),
    (4, frames.text(51, 100)),
    (5, frames.text(52, 30) + " " + " ".join(frames.text(50, 60).split()[20:50]).upper() + " " + frames.text(53, 30)),
    (6, " ".join(frames.text(50, 60).split()[:9])),
    (7, None),
    (8, ""),
    (9, "12 13 14 15 16 17 18 19 20 21 22 23 24 25 26"),
    (1, "Intro words here. " + ITEMS[0][1] + " And more."),
    (None, ITEMS[4][1]),
]


@pytest.mark.parametrize("limit", [decontam.MAX_WINDOWS, 1])
def test_leaks(shipped, limit):
    docs = shipped.createDataFrame(DOCS, "doc_id long, text string")
    items = shipped.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontam.leaks(frames.clashing(docs), items.selectExpr("*", "1 item", "2 window"), limit).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert found == {(1, 1), (2, 1), (3, 1), (5, 5), (None, 5)}  # one slot of seven may differ
    by = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert by[1, 1]["exact"] and not by[2, 1]["exact"] and by[2, 1]["changed_slots"] >= 5
    assert by[5, 5]["n_words"] >= 29


def test_inconsistent_slots_are_no_match():
    import numpy as np

    docs = decontam.Templates.of(frames_array(["then Peter met Peter at 5 with Maria and others again"]))
    items = decontam.Templates.of(frames_array(["then Anna met Anna at 6 with Anna and others again"]))
    assert decontam._slots(docs, 0, items, 0, 10) is None
    assert np.array_equal(docs.shapes, items.shapes)


def frames_array(texts):
    import pyarrow as pa

    return pa.array(texts, pa.large_string())


def test_clean_documents_stay(shipped):
    docs = frames.clashing(shipped.createDataFrame(DOCS, "doc_id long, text string"))
    items = shipped.createDataFrame(ITEMS, "item_id long, text string")
    for limit in (None, 1):
        with pytest.MonkeyPatch.context() as patch:
            if limit:
                patch.setattr(decontam, "MAX_WINDOWS", limit)
            out = decontam.without_leaks(docs, items)
            assert out.columns == docs.columns
            assert sorted(r["doc_id"] for r in out.collect()) == [4, 6, 7, 8, 9]


def test_empty_tables(shipped):
    docs, items = frames.none(shipped), shipped.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.leaks(docs, items).count() == 0
    assert decontam.leaks(frames.documents(shipped), items.where("false")).count() == 0


def test_all_passages_are_found(spark, sf_dir):
    from salesloom.llm.queries import QUERIES, table

    flat = lambda t: " ".join((t or "").split())
    items = [(r["item_id"], flat(r["text"])) for r in table(spark, sf_dir, "benchmark").collect()]
    docs = [(r["doc_id"], flat(r["text"])) for r in table(spark, sf_dir, "documents").collect()]
    inside = {(d, i) for d, t in docs for i, x in items if x in t}
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontamination"](spark, sf_dir).collect()} == inside


NUMBERS = "Find the mean of 3 7 9 12 15 18 21 24 30 33 40"
APPLES = "{0} has {2} apples. {0} gives {3} apples to {1}. How many apples does {0} have?"


@pytest.mark.parametrize("limit", [decontam.MAX_WINDOWS, 1])
def test_copies_of_numbers_names_at_sentences_and_short_items(shipped, limit):
    items = [(1, NUMBERS), (2, APPLES.format("Anna", "Peter", 12, 5)), (3, "What is two plus two?")]
    docs = [
        (1, "We read: " + NUMBERS + " and so on"),
        (2, "Well. " + APPLES.format("Maria", "John", 31, 8) + " Bye."),
        (3, APPLES.format("Anna", "Peter", 12, 5).lower()),
        (4, "They ask: what is two plus two? It is four."),
        (5, "Find the mean of 4 8 10 13 16 19 22 25 31 34 41"),
        (6, "What is two plus three?"),
    ]
    docs = shipped.createDataFrame(docs, "doc_id long, text string")
    items = shipped.createDataFrame(items, "item_id long, text string")
    rows = decontam.leaks(docs, items, limit).collect()
    assert sorted((r["doc_id"], r["item_id"], r["exact"]) for r in rows) == [(1, 1, True), (2, 2, False), (3, 2, True), (4, 3, True)]


@pytest.mark.parametrize("limit", [decontam.MAX_WINDOWS, 1])
def test_rows_are_judged_by_their_own_text(shipped, limit, monkeypatch):
    """A clean row stays beside a leaking one with the same id, or with no id either."""
    monkeypatch.setattr(decontam, "MAX_WINDOWS", limit)
    leak = ITEMS[4][1]
    rows = [(None, leak), (None, frames.text(60, 40)), (7, leak), (7, frames.text(61, 40)), (8, None), (None, None)]
    docs = frames.clashing(shipped.createDataFrame(rows, "doc_id long, text string"))
    out = decontam.without_leaks(docs, shipped.createDataFrame(ITEMS, "item_id long, text string"))
    assert out.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect()) == sorted(
        (str(i), str(t)) for i, t in rows if t != leak
    )


def test_runs_of_numbers_neither_stall_nor_hide_a_match(shipped):
    import resource
    import time

    numbers = lambda seed, n: " ".join(map(str, np.random.default_rng(seed).integers(0, 1000, n)))
    question = "Find the mean of the following list of numbers and explain your answer"
    items = shipped.createDataFrame(
        [(1, numbers(1, 1000)), (2, f"{question}: {numbers(2, 40)}"), (3, "1 and 2 and " * 300), (4, numbers(9, 30))],
        "item_id long, text string",
    )
    rows = [
        (1, numbers(5, 100_000)),
        (2, "Before. " + f"{question}: {numbers(3, 40)}" + " After."),
        (3, f"{numbers(4, 500)} {numbers(9, 30)} {numbers(6, 500)}"),
        (4, f"{numbers(8, 300)} {question}: {numbers(2, 40)}"),
    ]
    start = time.time()
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs, items).collect()}
    assert time.time() - start < 60
    assert (1, 1) not in found and (2, 2) in found and (3, 4) in found and found[4, 2].exact
    # Other numbers are too many for a template, but the question before them is a copy.
    assert found[2, 2].exact and found[2, 2].n_words == 13 and found[3, 4].n_words == 30
    assert {key[0] for key in found} == {2, 3, 4}
    bench = decontam.Benchmark([3], decontam.Templates.of(pa.array(["1 and 2 and " * 300], pa.large_string())))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    decontam.compare(pa.array([1]), pa.array(["3 and 4 and " * 5000], pa.large_string()), bench)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # KB


def test_lining_up_equals_comparing_every_place(shipped, monkeypatch):
    """Templates and slots by brute force: all places of a document against all of an item."""
    chance = random.Random(4)
    vocabulary = ["has", "apples", "gives", "how", "many", "left", "are", "the", "of", "and"]
    names = ["Anna", "Peter", "Zoe"]

    def text(n):
        out = []
        for _ in range(n):
            kind = chance.random()
            out.append(str(chance.randrange(9)) if kind < 0.2 else chance.choice(names) if kind < 0.35 else chance.choice(vocabulary))
            if chance.random() < 0.08:
                out[-1] += "."
        return out

    items = [text(chance.randrange(8, 30)) for _ in range(12)]
    docs = []
    for _ in range(60):
        own = chance.choice(items).copy()
        swap = {w.strip("."): str(chance.randrange(100)) if w.strip(".").isdigit() else chance.choice(names) for w in own if w.strip(".").isdigit() or w.strip(".") in names}
        own = [swap.get(w.strip("."), w.strip(".")) + ("." if w.endswith(".") else "") for w in own]
        for _ in range(chance.randrange(3)):
            own[chance.randrange(len(own))] = chance.choice(vocabulary)
        docs.append(text(chance.randrange(10)) + own + text(chance.randrange(10)))
    bench = decontam.Benchmark(list(range(len(items))), decontam.Templates.of(pa.array([" ".join(i) for i in items], pa.large_string())))
    mine = decontam.Templates.of(pa.array([" ".join(d) for d in docs], pa.large_string()))

    def expected():
        out = set()
        for d in range(len(docs)):
            a0, a1 = mine.bounds[d : d + 2].tolist()
            for i in range(len(items)):
                b0, b1 = bench.items.bounds[i : i + 2].tolist()
                longest = 0
                for line in range(a0 - b1 + 1, a1 - b0):
                    lo, hi = max(a0, b0 + line), min(a1, b1 + line)
                    same = [
                        mine.shapes[k] == bench.items.shapes[k - line]
                        or mine.wide[k] == bench.items.wide[k - line]
                        or mine.values[k] == bench.items.values[k - line]
                        for k in range(lo, hi)
                    ]
                    start = 0
                    for k in range(len(same) + 1):
                        if k == len(same) or not same[k]:
                            first, n = lo + start, k - start
                            if n >= min(decontam.RUN, b1 - b0 - 1) and _has_seed(first, line, n):
                                ok = decontam._slots(mine, first, bench.items, first - line, n) is not None
                                equal = mine.values[first : first + n] == bench.items.values[first - line : first - line + n]
                                part = 0 if ok else decontam._equal_run(equal)[1]
                                part = part if part >= min(decontam.RUN, b1 - b0 - 1) else 0
                                longest = max(longest, n if ok else part)
                            start = k + 1
                if longest:
                    out.add((d, i, longest))
        return out

    def _has_seed(first, line, n):
        """A window of one form throughout, with a word in it unless it is of values."""
        w = decontam.WINDOW
        for k in range(first, first + n - w + 1):
            for form in ("shapes", "wide", "values"):
                a, b = getattr(mine, form)[k : k + w], getattr(bench.items, form)[k - line : k - line + w]
                if (a == b).all() and (form == "values" or not np.isin(a, decontam._PLACEHOLDERS).all()):
                    return True
        return False

    wanted = expected()
    assert len(wanted) > 25
    texts = pa.array([" ".join(d) for d in docs], pa.large_string())
    for meetings in (1 << 20, 5):
        monkeypatch.setattr(decontam, "MEETINGS", meetings)
        got = {(row[0], row[1], row[3]) for row in decontam.compare(pa.array(range(len(docs))), texts, bench) if row[4] >= decontam.WINDOW}
        assert got == wanted
