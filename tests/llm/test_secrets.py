from __future__ import annotations

import hashlib
import random
import re

import frames
import numpy as np
import pytest

from salesloom.llm import queries, secrets

SIGNS = "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"


def some(chance, signs, n):
    return "".join(chance.choice(signs) for _ in range(n))


def base(text):
    """The patterns over the whole text, letter by letter."""
    text = text or ""
    assign = (
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
        r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(found)]


def texts():
    chance = random.Random(6)
    pieces = ["token", "API_KEY", "apikey", "Passwd", "pasſword", "toKen", "secret", "=", " : ", '"', "'", " ", "é", "😀", "\n"]
    pieces += ["AKIA", "AKIAAKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "fedcba98", "0", "-", "password=secret=short", "x" * 13]
    out = [(k, "".join(chance.choice(pieces) for _ in range(chance.randrange(25)))) for k in range(600)]
    out += [(1000, "token=" + "a" * 70_000), (1001, "f" * 300_000), (1002, "AKIA" * 20_000), (1003, "token" + " " * 5000)]
    out += [(1004, "é" * 40 + "0123456789abcdef0"), (1005, "0123456789abcde"), (1006, "0123456789abcdef"), (None, "secret:abcdefghijkl")]
    # A run goes on in the next row of the slice, where it is another run.
    out += [(1007, "abcdef0123"), (1008, "456789abcdef"), (1009, "AKI"), (1010, "A0123456789ABCDEFGH")]
    return out


def test_base_matches_equal_whole_text_patterns(shipped):
    rows = texts() + [(i, t) for i, t, *_ in frames.rows()]
    frame = shipped.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' spans", "1 kind", "2 n_hex")
    got = secrets.scan(shipped, frame).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    mine = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.gain is None]) for r in got), key=key)
    assert mine == sorted(((i, base(t)) for i, t in rows), key=key)
    for r in got:
        spans = sorted((s.start, s.end, s.gain is None) for s in r.spans)
        assert [(s.start, s.end) for s in r.spans] == sorted((s.start, s.end) for s in r.spans) or any(x[2] for x in spans)
        for s in r.spans:
            if s.gain is not None:
                assert all(s.end <= t.start or t.end <= s.start for t in r.spans if t is not s)


def test_the_query_carries_base_and_all_spans(shipped, sf_dir):
    rows = {r.doc_id: r for r in queries.op12_secrets(shipped, sf_dir).collect()}
    for doc in shipped.read.parquet(f"{sf_dir}/documents.parquet").collect():
        own, found = base(doc.text), rows[doc.doc_id]
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in own)
        assert found.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (found.n_assign, found.n_access, found.n_hex) == tuple(sum(k == kind for k, _, _ in own) for kind in secrets.KINDS)
        assert set(said.split(",")) <= set(found.spans.split(",")) or not own


def corpus(chance):
    """Labelled credentials of two formats, ordinary words, and bare credentials."""
    key = lambda: "ghp_" + some(chance, SIGNS + SIGNS.upper() + "0123456789", 36)
    word = lambda: some(chance, "etaoinshrdlu", chance.randrange(3, 9))
    prose = lambda: " ".join([*(word() for _ in range(60)), word() + "-" + word() + word(), word() + word() + "." + word()])
    labelled = [f"{prose()} token = '{key()}' {prose()}" for _ in range(150)]
    labelled += [f"{prose()} AKIA{some(chance, SIGNS.upper() + '234567', 16)} {prose()}" for _ in range(100)]
    bare = [(key(), prose()) for _ in range(100)] + [("ASIA" + some(chance, SIGNS.upper() + "234567", 16), prose()) for _ in range(20)]
    clean = [prose() for _ in range(300)]
    return labelled, bare, clean


def test_inferred_formats_find_bare_credentials_and_leave_words(shipped):
    labelled, bare, clean = corpus(random.Random(1))
    rows = [(k, t) for k, t in enumerate(labelled)]
    rows += [(1000 + k, f"{prose} {key}\n{prose}") for k, (key, prose) in enumerate(bare)]
    rows += [(2000 + k, t) for k, t in enumerate(clean)]
    got = {r.doc_id: r.spans for r in secrets.scan(shipped, shipped.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = 0
    for k, (key, prose) in enumerate(bare[:100]):
        hit += [(s.kind, s.start, s.end) for s in got[1000 + k]] == [("like_assign", len(prose) + 1, len(prose) + 1 + len(key))]
    assert hit >= 90
    assert all(not got[2000 + k] for k in range(len(clean)))
    assert all([s.kind for s in got[k]] == ["assign"] for k in range(150))


def test_formats_are_a_parameter_and_unknown_without_examples(shipped):
    chance = random.Random(2)
    known = secrets.learned({"key": [f"zz-{some(chance, 'QRST', 30)}" for _ in range(200)], "rare": ["zz-1"] * 50})
    assert list(known.kinds) == ["key"] and known.plain is None
    rows = [(1, f"a zz-{some(chance, 'QRST', 30)} b"), (2, "justalongordinaryword"), (3, f"zz-{some(chance, 'QRST', 20)}")]
    frame = shipped.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in secrets.scan(shipped, frame, known).collect()}
    assert got == {1: ["like_key"], 2: [], 3: []}  # the last is shorter than any example


def test_merging_folds_a_loop_and_keeps_a_head():
    chance = random.Random(3)
    automaton = secrets.infer([("ghp_" + some(chance, HEX, 30)).encode() for _ in range(800)])
    assert 5 <= len(automaton.step) < 60  # the head's four states and few more, of 20,000 in the tree
    symbol = lambda c: secrets.SYMBOLS.index(c.encode())
    assert np.exp(automaton.weight[0, symbol("g")]) > 0.99


def test_states_that_differ_stay_apart():
    # After "a" always "x", after "b" always "y": merging the two states would lose it.
    automaton = secrets.infer([b"ax"] * 300 + [b"by"] * 300)
    of = lambda t: automaton.totals(*secrets._coded([t.encode()]))[0]
    assert of("ax") > np.log(0.4) and of("by") > np.log(0.4) and of("ay") < -5 and of("bx") < -5


@pytest.mark.parametrize("seed", range(3))
def test_merged_counts_are_those_of_the_examples(seed):
    chance = random.Random(seed)
    examples = [some(chance, chance.choice(["ab", "01", "aAb"]), chance.randrange(1, 9)).encode() for _ in range(300)]
    tree = secrets.PrefixTree(examples)
    total = sum(tree.count)
    kept = tree.merged()
    assert sum(tree.end[s] for s in kept) == len(examples)
    assert sum(tree.count[s] for s in kept) == total  # each beginning is counted in one state
    assert all(child in kept for s in kept for child in tree.next[s].values())
    assert all(tree.count[s] == tree.end[s] + sum(tree.edges[s].values()) for s in kept)


def test_walk_in_step_equals_a_walk_by_symbol():
    chance = random.Random(4)
    automaton = secrets.infer([some(chance, "ab01", chance.randrange(2, 30)).encode() for _ in range(200)])
    runs = [some(chance, "ab01zZ", n).encode() for n in (1, 5, 255, 256, 257, 700)]
    codes, bounds = secrets._coded(runs)
    for run, got in zip(runs, automaton.totals(codes, bounds), strict=True):
        state, total = 0, 0.0
        for k, byte in enumerate(run):
            state = automaton.hub if k and k % secrets.SEGMENT == 0 else state
            code = secrets.SYMBOL_OF[byte]
            total += automaton.weight[state, code]
            state = automaton.step[state, code]
        assert np.isclose(got, total + automaton.weight[state, secrets.END])


def test_a_crowded_task_keeps_the_smallest_hashes(shipped):
    rows = [(k, f"token={k:012d}z") for k in range(200)] * 2
    frame = shipped.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = secrets.examples(shipped, frame, 7).where("kind = 'assign'").collect()
    values = sorted((f"{k:012d}z" for k in range(200)), key=lambda v: secrets._place(v.encode()))[:7]
    assert sorted(r.value for r in got) == sorted(values)


def test_empty_table(shipped):
    assert secrets.scan(shipped, frames.none(shipped)).count() == 0
