from __future__ import annotations

import hashlib
import random
import re

import frames
import numpy as np
import pytest

from salesloom.llm import fim

TOKENS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc_id, text):
    """By splitting the text, without ranks."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    tokens = TOKENS.findall(text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    chance = random.Random(5)
    signs = "abcXYZ019 .,\n\t\x00é中😀<PSM>-"
    out = [(k, "".join(chance.choice(signs) for _ in range(chance.randrange(60)))) for k in range(400)]
    out += [(1000, "a"), (1001, "é"), (1002, "<P>"), (1003, "x<M>y"), (1004, "word" * 50_000), (1005, "😀" * 70_000)]
    out += [(1006, "1 " * 90_000), (1007, "same"), (1007, "same"), (1007, "other text"), (None, "no id"), (-3, "minus")]
    return out


def test_equals_splitting(shipped):
    rows = texts() + [(i, t) for i, t, *_ in frames.rows()]
    made = shipped.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 n", "'x' form", "2 output")
    back = fim.restored(fim.transform(made)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in back), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sorted(r.restored for r in back) == sorted(t or "" for _, t in rows)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_shares_and_sentinels_are_parameters(shipped):
    rows = [(k, f"some words {k} <P> and <S> more") for k in range(50)]
    own = ("[a]", "[b+", "(c")
    made = fim.transform(shipped.createDataFrame(rows, "doc_id long, text string"), 7, 100, 100, own)
    back = fim.restored(made, own).collect()
    assert {r.form for r in back} == {"spm"}
    assert sorted(r.restored for r in back) == sorted(t for _, t in rows)


def test_empty_table(shipped):
    assert fim.restored(fim.transform(frames.none(shipped))).count() == 0


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_ranks_count_symbols(size):
    symbols = np.random.default_rng(size).integers(0, 7, size).astype(np.uint8)
    matrix = fim.WaveletMatrix(symbols, 3)
    places = np.arange(size + 1)
    for symbol in range(8):
        assert matrix.rank(symbol, places).tolist() == [int((symbols[:k] == symbol).sum()) for k in places]
