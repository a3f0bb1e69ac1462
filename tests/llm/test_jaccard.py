from __future__ import annotations

import random
import re
from collections import Counter

import frames
import numpy as np
import pytest

from salesloom.llm import jaccard
from salesloom.llm.components import components
from salesloom.plans.session import work_dir


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return Counter((i, len(sets[k]), least.get(root(k)) if sets[k] else i) for k, (i, _) in enumerate(rows))


def result(spark, frame):
    join = jaccard.Join(spark, frame)
    return Counter(tuple(r) for r in join.per_document().select("doc_id", "n_shingles", "component_id").collect())


def test_equals_brute_force(shipped):
    frame = frames.clashing(frames.documents(shipped))
    assert result(shipped, frame) == expected([r[:2] for r in frames.rows()])


@pytest.mark.parametrize("seed, rows_of_block", [(1, 20_000), (2, 20_000), (3, 4)])
def test_groups_of_near_copies(shipped, seed, rows_of_block, monkeypatch):
    """Chains, stragglers and groups around one text, with frequent shingles in sub-blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", rows_of_block)
    chance = random.Random(seed)
    rows = []
    for group in range(6):
        base = frames.words(seed * 100 + group, chance.choice([6, 9, 30, 80]), 50)
        for _ in range(40):
            own = base.copy()
            for _ in range(chance.randrange(6)):
                own[chance.randrange(len(own))] = f"z{chance.randrange(60)}"
            if chance.random() < 0.3:
                own = own[: chance.randrange(len(own)) + 1]
            rows.append((chance.randrange(10_000), " ".join(own)))
            base = own if chance.random() < 0.2 else base
    frame = shipped.createDataFrame(rows, "doc_id long, text string")
    assert result(shipped, frame) == expected(rows)


def test_links_are_true(shipped):
    frame = frames.documents(shipped).where("doc_id < 100")
    join = jaccard.Join(shipped, frame)
    for row in join.links.collect():
        assert 100 * row["overlap"] >= 80 * row["total"]


def test_one_row_of_each_component_stays(shipped):
    frame = frames.clashing(frames.documents(shipped))
    join = jaccard.Join(shipped, frame)
    out = join.representatives(frame)
    assert out.columns == frame.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect())
    wanted = {c for (i, n, c) in expected([r[:2] for r in frames.rows()]) if n}
    kept = [i for none, i in ids if not none]
    assert set(kept) == {i for i in wanted if i is not None} | {6, 7, 8}
    assert sum(none for none, _ in ids) == 1 and kept.count(19) == 2


def test_components_of_a_long_chain(shipped):
    pairs = [(k, k + 1) for k in range(200)] + [(1000, 1001), (5, 1000)] + [(2000, k) for k in range(2001, 2100)]
    random.Random(0).shuffle(pairs)
    links = shipped.createDataFrame(pairs, "a long, b long")
    found = dict(components(shipped, links, work_dir(shipped, "components")).collect())
    assert all(found[k] == 0 for k in [*range(201), 1000, 1001]) and all(found[k] == 2000 for k in range(2000, 2100))


def test_required_is_the_least_overlap():
    for n, m in np.random.default_rng(0).integers(1, 60, (200, 2)).tolist():
        least = next(o for o in range(n + m + 1) if 100 * o >= 80 * (n + m - o))
        assert jaccard.required(n, m) == least


def test_empty_table(shipped):
    assert result(shipped, frames.none(shipped)) == Counter()
    frame = frames.none(shipped)
    assert jaccard.Join(shipped, frame).representatives(frame).count() == 0


def test_parity_bits_never_differ_more_than_sets(shipped):
    chance = random.Random(8)
    texts = [" ".join(chance.choice("abcdefg") for _ in range(chance.randrange(400))) for _ in range(60)]
    import pyarrow as pa

    own = jaccard.Sets(pa.array(texts, pa.large_string()))
    parts = [set(own.values[a:b].tolist()) for a, b in zip(own.bounds[:-1], own.bounds[1:], strict=True)]
    parity = own.parity().view(np.uint64)
    for a in range(60):
        for b in range(a):
            assert np.bitwise_count(parity[a] ^ parity[b]).sum() <= len(parts[a] ^ parts[b])


@pytest.mark.parametrize("tile_rows, held", [(2_048, 400_000), (3, 4)])
def test_the_product_adds_up_what_first_elements_share(shipped, tile_rows, held, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile_rows)
    chance = random.Random(9)
    component = {node: chance.randrange(12) for node in range(40)}
    size = {node: chance.choice([50, 52, 90]) for node in range(40)}
    rows, wanted = [], Counter()
    for block in range(30):
        nodes = chance.sample(range(40), chance.randrange(2, 15))
        weight = chance.randrange(1, 4)
        rows += [(block, -block, min(nodes), len(nodes), x, size[x], component[x], weight, *[0] * jaccard.PARITY) for x in nodes]
        for a in nodes:
            for b in nodes:
                if a < b and component[a] != component[b] and 100 * min(size[a], size[b]) >= 80 * max(size[a], size[b]):
                    wanted[a, b, size[a], size[b]] += weight
    schema = "rows_1 long, rows_2 long, first long, height long, node long, n long, component long, weight long, "
    frame = shipped.createDataFrame(rows, schema + ", ".join(f"{b} long" for b in jaccard.BITS))
    got = Counter()
    for r in jaccard.product(frame).collect():
        got[r.a, r.b, r.n, r.m] += r.shared
    assert got == wanted
    sums, pieces = jaccard._Sums(), []
    monkeypatch.setattr(jaccard, "HELD_PAIRS", held)
    for k in range(20):
        pieces += sums.add(np.array([[1, 2, 1], [3, 4, 3], [5, 5, 5], [6, 6, 6], [k, 1, 1]]))
    pieces += sums.rest()
    added = Counter()
    for p in pieces:
        for a, b, *_, shared in zip(*(c.to_pylist() for c in p.columns), strict=True):
            added[a, b] += shared
    assert added == {(1, 3): 210, (2, 4): 20}


def test_pairs_that_share_much_below_the_threshold(shipped):
    """Thousands of rows around 70 to 90 % of common shingles, rare ones and common ones."""
    chance = random.Random(10)
    rows = []
    for group in range(25):
        base = frames.words(900 + group, 60, 4000)
        for k in range(60):
            own = base.copy()
            for at in chance.sample(range(60), chance.randrange(4)):
                own[at] = f"u{group}-{k}-{at}" if chance.random() < 0.7 else f"v{chance.randrange(40)}"
            rows.append((group * 100 + k, " ".join(own)))
    rows += [(10_000 + k, " ".join(frames.words(k, 25, 900) + frames.words(7, 30) + frames.words(k + 9999, 25, 900))) for k in range(500)]
    frame = shipped.createDataFrame(rows, "doc_id long, text string")
    assert result(shipped, frame) == expected(rows)
