from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import frames
import numpy as np
import pyarrow as pa

from salesloom.llm import pst


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def test_counts_and_base_equal_brute_force(shipped):
    frame = frames.clashing(frames.documents(shipped))
    rows = [r[:2] for r in frames.rows()]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    train = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    total, types = sum(train.values()), len(train)
    expected = Counter(
        (i, held(i), len(tokens(t)), sum(train[x] > 0 for x in tokens(t)), total,
         round(sum(math.log10((train[x] + 0.5) / (total + 0.5 * (types + 1))) for x in tokens(t)), 6))
        for i, t in rows
    )
    out = pst.score(shipped, frame).collect()
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in out) == expected
    assert all(r["score"] < 0 for r in out)


def brute_model(texts, states, depth):
    counts = {}
    for t in texts:
        codes = [pst.START] * depth + list(t) + [pst.END]
        for k in range(depth, len(codes)):
            for n in range(depth + 1):
                counts.setdefault(tuple(codes[k - n : k]), Counter())[codes[k]] += 1

    def chance(context, symbol):
        own = counts.get(context, Counter())
        if not context:
            return (own[symbol] + pst.UNSEEN) / (own.total() + pst.UNSEEN * pst.SYMBOLS)
        return (own[symbol] + pst.BACKOFF * chance(context[1:], symbol)) / (own.total() + pst.BACKOFF)

    def score(t):
        codes = [pst.START] * depth + list(t) + [pst.END]
        out = 0.0
        for k in range(depth, len(codes)):
            context = max((s for n in range(depth + 1) if (s := tuple(codes[k - n : k])) in states), key=len)
            out += math.log10(chance(context, codes[k]))
        return out

    return counts, score


def passing(texts, depth, gain):
    """Contexts whose gain reaches `gain`, with their suffixes, by definition."""
    counts, _ = brute_model(texts, {()}, depth)
    states = {()}
    for context, own in counts.items():
        if context:
            short = counts[context[1:]]
            gained = sum(n * math.log(n * short.total() / (own.total() * short[x])) for x, n in own.items())
            if gained >= gain:
                states |= {context[k:] for k in range(len(context) + 1)}
    return states


class Tree:
    """The rows of a tree on the driver, scored as a slice scores its own."""

    def __init__(self, spark, training, depth=pst.DEPTH, gain=pst.GAIN):
        rows = pst.learned(spark, training, depth, gain).collect()
        self.depth = depth
        self.keys = np.array([r["key"] for r in rows], dtype=np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(r["next"]) // 8 for r in rows])
        self.nodes = pst.Nodes(self.keys, owner, np.frombuffer(b"".join(r["next"] for r in rows), dtype=np.int64))

    def states(self):
        codes = lambda key: key & ((1 << pst.KEY_BITS) - 1)
        return {
            tuple((codes(key) >> (pst.BITS * k)) & pst.SYMBOL for k in range(key >> pst.KEY_BITS))
            for key in self.keys.tolist()
        }

    def scores(self, texts):
        found = []
        for text in texts:
            codes, bounds = pst.byte_codes(pa.array([text], pa.large_string()))
            packed = pst.grams(codes, bounds, self.depth)
            found.append(pst.run_scores(packed, self.nodes, self.depth).sum())
        return found


def test_tree_and_scores_equal_brute_force(shipped, monkeypatch):
    texts = ["the cat sat on the mat", "the dog sat", "", "a cat", "the cat and the dog on the mat"] * 3
    frame = shipped.createDataFrame([(t,) for t in texts], "text string")
    asked = ["the cat sat", "dog", "", "zebra the mat!", "the dog sat on the cat " * 40, "é"]
    raw = [t.encode() for t in texts]
    for depth, gain, merge in ((3, 4.0, pst.MERGE), (5, 4.0, 10), (4, 0.5, 0), (1, 1.0, pst.MERGE)):
        monkeypatch.setattr(pst, "MERGE", merge)
        tree = Tree(shipped, frame, depth, gain)
        states = passing(raw, depth, gain)
        assert tree.states() == states and len(states) > 3
        _, score = brute_model(raw, states, depth)
        np.testing.assert_allclose(tree.scores(asked), [score(t.encode()) for t in asked], rtol=1e-9)


def test_a_context_seen_three_times_is_kept_where_it_gains_enough(shipped):
    """Three "qz!" among 10,000 "za": the context "qz" gains more than 20 nats."""
    texts = ["za" * 10_000, "qz!", "qz!", "qz!"]
    tree = Tree(shipped, shipped.createDataFrame([(t,) for t in texts], "text string"))
    assert tuple(b"qz") in tree.states()
    assert tree.states() == passing([t.encode() for t in texts], pst.DEPTH, pst.GAIN)


def test_probabilities_add_up(shipped):
    frame = shipped.createDataFrame([("abab abba",), ("baab",)], "text string")
    tree = Tree(shipped, frame, 3, 0.5)
    for context in ([pst.START] * 3, list(b"aba"), list(b"bab"), list(b"xxx")):
        packed = 0
        for code in reversed(context):
            packed = (packed << pst.BITS) | code
        runs = (packed << pst.BITS) | np.arange(pst.SYMBOLS)
        chances = 10 ** pst.run_scores(runs, tree.nodes, 3)
        np.testing.assert_allclose(chances.sum(), 1.0, rtol=1e-9)


def test_contexts_help_on_held_out_texts(spark, sf_dir):
    from salesloom.llm.langid import held_out
    from salesloom.llm.queries import table

    rows = table(spark, sf_dir, "documents").select("text", held_out("doc_id", 5, 1).alias("held"))
    asked = pst.lower_ascii(pst.strings(rows.where("held").select("text").toArrow().column(0).combine_chunks())).to_pylist()
    training = rows.where("NOT held")
    tree, root = Tree(spark, training), Tree(spark, training, gain=1e18)
    assert len(asked) > 20 and root.states() == {()}
    assert sum(tree.scores(asked)) > 0.6 * sum(root.scores(asked))


def test_empty_table(shipped):
    assert pst.score(shipped, frames.none(shipped)).count() == 0
    only = frames.documents(shipped).where("doc_id IS NULL OR text IS NULL")
    assert pst.score(shipped, only).count() == only.count()


def test_only_the_divergence_test_bounds_the_tree(shipped, monkeypatch):
    """Scores are those of all contexts that pass, also above a number that once was a cap."""
    monkeypatch.setattr(pst, "SLICE_BYTES", 400)
    monkeypatch.setattr(pst, "PART_SLICES", 2)
    rows = [(k, frames.text(k % 7, 30) + (" the cat sat on the mat" * (k % 4))) for k in range(40)]
    rows += [(None, "The CAT"), (90, None), (91, "zebra é")]
    raw = lambda t: (t or "").lower().encode()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    train = [raw(t) for i, t in rows if not held(i)]
    states = passing(train, pst.DEPTH, pst.GAIN)
    assert len(states) > 20
    _, score = brute_model(train, states, pst.DEPTH)
    frame = shipped.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in pst.score(shipped, frame).collect()}
    for i, t in rows:
        assert math.isclose(found[i], score(raw(t)), rel_tol=1e-9), i


def _random_tree(runs=400_000, seed=7):
    rng = np.random.default_rng(seed)
    keys = [np.zeros(1, dtype=np.int64)]
    for length in range(1, pst.DEPTH + 1):
        codes = rng.integers(0, 1 << (pst.BITS * length), 4000, dtype=np.int64)
        keys.append(np.unique((length << pst.KEY_BITS) | codes))
    keys = np.concatenate(keys)
    pairs = np.unique(rng.integers(0, len(keys) << pst.BITS, runs, dtype=np.int64))
    pairs = pairs[(pairs & pst.SYMBOL) < pst.SYMBOLS]
    counts = rng.integers(1, 1000, len(pairs), dtype=np.int64)
    return keys, pairs >> pst.BITS, (counts << pst.BITS) | (pairs & pst.SYMBOL)


def test_nodes_hold_few_temporaries_and_pieces_change_nothing(monkeypatch):
    import tracemalloc

    keys, owner, runs = _random_tree()
    tracemalloc.start()
    whole = pst.Nodes(keys, owner, runs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 52 * len(runs)  # 64 bytes a run before temporaries were let go
    monkeypatch.setattr(pst, "NODE_ROWS", 1000)
    pieces = pst.Nodes(keys, owner, runs)
    assert np.array_equal(whole.chances, pieces.chances) and np.array_equal(whole.pairs, pieces.pairs)
