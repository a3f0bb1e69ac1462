"""Secrets in texts: known patterns, and formats inferred from the credentials that they find.

What the patterns match in the corpus are labelled credentials. For each kind a bounded sample of
them becomes a prefix tree whose states know how often they are reached, left by each character,
and ended in. States whose frequencies do not differ by more than chance allows (a Hoeffding bound
on characters, on classes of characters and on the end, all the way down) are merged, from the
most frequent on, each with the one that explains it best; what remains is a probabilistic automaton of the kind's format. Another is
inferred from ordinary words. Every run of credential characters that no pattern has found is then
a candidate: it is added where a kind's automaton explains it as well as it explains credentials
that were kept out of its fit, and far better than the automaton of ordinary words does.

Patterns and runs are found in the bytes of a whole slice of texts at once, and all runs of a
slice walk an automaton in step. Each task keeps the smallest hashes of each kind for the sample,
so a task sends EXAMPLES short rows of a kind at most, and the sample depends on no partitioning.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.lockstep import SEGMENT, Segments
from salesloom.llm.textops import Bits, slices, strings
from salesloom.plans.session import work_dir

# Kinds of secrets, their patterns, and the least characters of what they match.
ASSIGN, ACCESS, HEX = "assign", "access", "hex"
KINDS = (ASSIGN, ACCESS, HEX)
ASSIGNED = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KEYWORD_PARTS = ("passw", "secret", "token", "api")
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {ASSIGN: 12, ACCESS: 18, HEX: 16}

#: The kind of what is learned as ordinary, and the start of the names of kinds that are inferred.
PLAIN, INFERRED = "plain", "like_"
#: Characters of a candidate, and of the example that is learned from at most.
CANDIDATE_CHARS, EXAMPLE_CHARS = 12, 128
#: Examples of a kind that are learned from at most, and at least.
EXAMPLES, LEAST_EXAMPLES = 1_000, 20
#: One in so many examples is kept out of the fit, to tell how well the fit explains new ones.
KEPT_OUT = 5
#: Share of the kept-out examples at whose log-likelihood a symbol the low end of a format lies.
BELOW = 0.02
#: Share of ordinary runs that a format may explain; one that explains more tells nothing apart.
MIXED = 0.5
#: Chance of error of a merging test; weight of the smoothing; nats by which a candidate must
#: be likelier as a credential than as an ordinary word.
ALPHA, SMOOTHING, GAIN = 0.05, 1.0, 12.0

SYMBOLS = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_.=-"
END = len(SYMBOLS)
#: Class of each symbol: digit, small letter, capital, sign.
CLASS_OF = [0] * 10 + [1] * 26 + [2] * 26 + [3] * 6

SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,gain:double>>"
SAMPLE = "kind string, place long, value string"


def _symbol_of_bytes() -> np.ndarray:
    symbols = np.full(256, END, dtype=np.uint8)
    symbols[np.frombuffer(SYMBOLS, dtype=np.uint8)] = np.arange(END)
    return symbols


#: Of every byte: its symbol, or END. Symbols below 16 are small hexadecimal digits.
SYMBOL_OF = _symbol_of_bytes()


@dataclass
class Automaton:
    """A probabilistic automaton; state 0 is the start.

    step: the next state by symbol. Where the examples hold no such step, it is the state that they
    reach most. weight: the logarithm of each symbol's probability, the last that of the end.
    """

    step: np.ndarray
    weight: np.ndarray
    hub: int

    def totals(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The log-likelihood of each run codes[bounds[i]:bounds[i + 1]], its end included.

        Runs above SEGMENT symbols are walked in pieces; each but the first goes on in the hub.
        """
        longest = int(np.diff(bounds).max(initial=0))
        parts = Segments(codes, bounds, END, length=max(1, min(SEGMENT, longest)))
        first = np.concatenate(([True], parts.owner[1:] != parts.owner[:-1])) if len(parts.owner) else np.empty(0, bool)
        state = np.where(first, 0, self.hub)
        stay = np.arange(len(self.step))[:, None]
        step = np.hstack((self.step, stay))
        weight = np.hstack((self.weight[:, :END], np.zeros((len(stay), 1))))
        total = np.zeros(len(state))
        for row in parts.matrix:
            total += weight[state, row]
            state = step[state, row]
        last = np.concatenate((first[1:], [True])) if len(first) else first
        total += np.where(last, self.weight[state, END], 0.0)
        return parts.per_run(total)


class PrefixTree:
    """The states of examples, by their beginnings, merged as far as their counts allow."""

    def __init__(self, examples: list[bytes], alpha: float = ALPHA):
        self.alpha = alpha
        self.count, self.end = [0], [0]
        self.edges: list[dict[int, int]] = [{}]
        self.next: list[dict[int, int]] = [{}]
        for example in sorted(examples):
            at = 0
            self.count[0] += 1
            for code in SYMBOL_OF[np.frombuffer(example, dtype=np.uint8)].tolist():
                if code not in self.next[at]:
                    self.next[at][code] = len(self.next)
                    self.count.append(0)
                    self.end.append(0)
                    self.edges.append({})
                    self.next.append({})
                self.edges[at][code] = self.edges[at].get(code, 0) + 1
                at = self.next[at][code]
                self.count[at] += 1
            self.end[at] += 1

    def alike(self, one: int, other: int) -> bool:
        """Whether two states' counts may come from the same probabilities."""
        n, m = self.count[one], self.count[other]
        bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        if bound >= 1:
            return True
        if abs(self.end[one] / n - self.end[other] / m) >= bound:
            return False
        apart = [0.0] * 4
        mine, its = self.edges[one], self.edges[other]
        for code in mine.keys() | its.keys():
            difference = mine.get(code, 0) / n - its.get(code, 0) / m
            if abs(difference) >= bound:
                return False
            apart[CLASS_OF[code]] += difference
        return max(map(abs, apart)) < bound

    def explained(self, kept: int, new: int) -> float:
        """The log-likelihood of what `new` goes on with, by the frequencies of `kept`."""
        rest = self.count[kept] + END + 1
        mine = self.edges[kept]
        total = self.end[new] * math.log((self.end[kept] + 1) / rest)
        return total + sum(n * math.log((mine.get(code, 0) + 1) / rest) for code, n in self.edges[new].items())

    def compatible(self, kept: int, new: int) -> bool:
        """Whether the trees below two states are alike; the one below `new` holds no merged state."""
        pairs = [(kept, new)]
        while pairs:
            one, other = pairs.pop()
            if self.count[other] == 1:  # nothing can be told from one example, here or below
                continue
            if not self.alike(one, other):
                return False
            pairs += [(self.next[one][code], child) for code, child in self.next[other].items() if code in self.next[one]]
        return True

    def merged(self) -> list[int]:
        """Merges states; the kept ones, the start first. Their `next` holds kept states only."""
        kept, parent, order = [0], {}, []
        is_kept = {0}

        def offer(state: int, above: int, code: int) -> None:
            parent[state] = (above, code)
            heapq.heappush(order, (-self.count[state], state))

        for code, child in self.next[0].items():
            offer(child, 0, code)
        while order:
            weight, new = heapq.heappop(order)
            if new not in parent or -weight != self.count[new]:
                continue  # merged since, or offered again with more examples
            likeliest = sorted(kept, key=lambda state: -self.explained(state, new))
            target = next((state for state in likeliest if self.compatible(state, new)), None)
            above, code = parent.pop(new)
            if target is None:
                kept.append(new)
                is_kept.add(new)
                for below, child in self.next[new].items():
                    offer(child, new, below)
                continue
            self.next[above][code] = target
            pairs = [(target, new)]
            while pairs:
                into, out = pairs.pop()
                self.count[into] += self.count[out]
                self.end[into] += self.end[out]
                for below, n in self.edges[out].items():
                    self.edges[into][below] = self.edges[into].get(below, 0) + n
                for below, child in self.next[out].items():
                    if below in self.next[into]:
                        pairs.append((self.next[into][below], child))
                    else:
                        self.next[into][below] = child
                        if into in is_kept:
                            offer(child, into, below)
                if into in parent:
                    heapq.heappush(order, (-self.count[into], into))
        return kept


def infer(examples: list[bytes], alpha: float = ALPHA) -> Automaton:
    """The automaton of the examples; they may hold nothing but SYMBOLS, and repeat."""
    tree = PrefixTree(examples, alpha)
    kept = tree.merged()
    number = {state: k for k, state in enumerate(kept)}
    hub = max(range(len(kept)), key=lambda k: (tree.count[kept[k]], -k))
    seen = np.zeros((len(kept), END + 1))
    step = np.full((len(kept), END), hub)
    for k, state in enumerate(kept):
        seen[k, END] = tree.end[state]
        for code, n in tree.edges[state].items():
            seen[k, code] = n
            step[k, code] = number[tree.next[state][code]]
    anywhere = (seen.sum(0) + 0.5) / (seen.sum() + 0.5 * (END + 1))
    weight = np.log((seen + SMOOTHING * anywhere) / (seen.sum(1, keepdims=True) + SMOOTHING))
    return Automaton(step, weight, hub)


@dataclass
class Formats:
    """Automata by kind, with the shortest example and the log-likelihood a symbol to be reached."""

    kinds: dict[str, tuple[Automaton, int, float]]
    plain: Automaton | None

    def gains(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """kind (its place in `kinds`, -1 for none) and gain in nats of each run."""
        lengths = np.diff(bounds)
        if self.plain is not None:
            ordinary = self.plain.totals(codes, bounds)
        else:
            ordinary = -(lengths + 1) * math.log(END + 1)
        kind, best = np.full(len(lengths), -1), np.full(len(lengths), GAIN)
        for k, (automaton, least, floor) in enumerate(self.kinds.values()):
            total = automaton.totals(codes, bounds)
            gain = total - ordinary
            taken = (lengths >= least) & (total >= floor * (lengths + 1)) & (gain >= best)
            taken &= (kind < 0) | (gain > best)
            kind[taken], best[taken] = k, gain[taken]
        return kind, best


def learned(examples: dict[str, list[str]]) -> Formats:
    """Formats of labelled credentials by kind; those of the kind PLAIN are ordinary runs.

    Kinds with fewer than LEAST_EXAMPLES different examples have no automaton, nor have kinds that
    explain more than MIXED of the ordinary runs. Credentials among the ordinary runs are left out
    of their fit. Examples that hold other characters than SYMBOLS are dropped.
    """
    kinds: dict[str, tuple[Automaton, int, float]] = {}
    drawn = {kind: _drawn(values) for kind, values in examples.items()}
    plain = drawn.pop(PLAIN, [])
    codes, bounds = _coded(plain)
    free = np.ones(len(plain), dtype=bool)
    for kind in sorted(drawn, key=lambda k: (KINDS.index(k) if k in KINDS else len(KINDS), k)):
        own = drawn[kind]
        if len(own) < LEAST_EXAMPLES:
            continue
        automaton = infer([v for k, v in enumerate(own) if k % KEPT_OUT])
        held = _coded(own[::KEPT_OUT])
        reached = automaton.totals(*held) / (np.diff(held[1]) + 1)
        low, middle = np.quantile(reached, (BELOW, 0.5), method="lower")
        floor = float(low - (middle - low))  # few are kept out: as far again below
        least = min(map(len, own))
        explained = (np.diff(bounds) >= least) & (automaton.totals(codes, bounds) >= floor * (np.diff(bounds) + 1))
        if explained.sum() <= MIXED * len(plain):
            kinds[kind] = (automaton, least, floor)
            free &= ~explained
    if free.sum() < LEAST_EXAMPLES:
        return Formats(kinds, infer(plain) if len(plain) >= LEAST_EXAMPLES else None)
    sure = Formats(kinds, infer([v for v, own in zip(plain, free, strict=True) if own]))
    words = sure.gains(codes, bounds)[0] < 0
    return Formats(kinds, infer([v for v, own in zip(plain, words, strict=True) if own]))


def _drawn(values: list[str]) -> list[bytes]:
    """The EXAMPLES different values of smallest hash."""
    own = sorted({value.encode() for value in values}, key=lambda v: (_place(v), v))
    return [v for v in own if v and (SYMBOL_OF[np.frombuffer(v, dtype=np.uint8)] < END).all()][:EXAMPLES]


def _coded(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int64)
    return SYMBOL_OF[np.frombuffer(b"".join(values), dtype=np.uint8)], bounds


def _place(value: bytes) -> int:
    """Where a value stands in the order by which examples are drawn."""
    return xxhash.xxh3_64_intdigest(value) >> 1


class Found:
    """Base matches and runs of credential characters in the texts of a slice.

    base: arrays (text, place of the kind, start, end, start of the credential), places in
    characters, by text, start and kind. runs: arrays (text, start, end, first byte) of the runs
    that no base match overlaps.
    """

    def __init__(self, texts: pa.Array):
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(texts) + 1]
        self.data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        self.characters = Bits((self.data & 0xC0) != 0x80)
        self.codes = SYMBOL_OF[self.data]
        text, start, end, _ = self._runs(self.codes < 16, LEAST[HEX])
        base = np.array([text, np.full(len(text), KINDS.index(HEX)), start, end, start])
        base = np.hstack((base, np.array(list(_pattern_matches(texts)), dtype=np.int64).reshape(-1, 5).T))
        self.base = base[:, np.lexsort((base[1], base[2], base[0]))]
        runs = self._runs(self.codes < END, CANDIDATE_CHARS)
        self.runs = tuple(x[self._free(*runs[:3])] for x in runs)

    def _runs(self, inside: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
        """(text, start, end, first byte) of the longest runs of set places, within a text."""
        edge = np.zeros(len(inside) + 1, dtype=bool)
        edge[self.bounds] = True
        before, after = np.concatenate(([False], inside)), np.concatenate((inside, [False]))
        first = np.flatnonzero(after & (~before | edge))
        last = np.flatnonzero(before & (~after | edge))
        long = last - first >= least
        first, length = first[long], (last - first)[long]
        text = np.searchsorted(self.bounds, first, side="right") - 1
        start = self.characters.rank(first) - self.characters.rank(self.bounds[text])
        return text, start, start + length, first

    def _free(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which runs no base match of their text overlaps."""
        free = np.ones(len(text), dtype=bool)
        if not self.base.shape[1]:
            return free
        # Characters are counted over the whole slice, so that places of all texts are in order.
        owner, _, first, last, _ = self.base
        shift = self.characters.rank(self.bounds)
        reach = np.maximum.accumulate(last + shift[owner])
        before = np.searchsorted(first + shift[owner], end + shift[text], side="left")
        met = before > 0
        free[met] = reach[before[met] - 1] <= (start + shift[text])[met]
        return free

    def coded_runs(self) -> tuple[np.ndarray, np.ndarray]:
        _, start, end, first = self.runs
        bounds = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
        places = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], end - start)
        return self.codes[places], bounds


def _pattern_matches(texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    for k, text in enumerate(texts):
        own = text.as_py()
        low = own.lower()
        if any(part in low for part in KEYWORD_PARTS):
            for match in ASSIGNED.finditer(own):
                if match.end(2) - match.start(2) >= LEAST[ASSIGN]:
                    yield k, KINDS.index(ASSIGN), match.start(), match.end(), match.start(2)
        if "AKIA" in own:
            for match in ACCESS_KEY.finditer(own):
                if match.end() - match.start() >= LEAST[ACCESS]:
                    yield k, KINDS.index(ACCESS), match.start(), match.end(), match.start()


def examples(spark: SparkSession, documents: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """SAMPLE: of each kind, and of ordinary words, the `most` different values of smallest hash.

    Values are credentials (of an assignment, what is assigned) and free runs of credential
    characters, of EXAMPLE_CHARS characters at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[bytes, int]] = {kind: {} for kind in (*KINDS, PLAIN)}
        floor: dict[str, int] = {kind: 1 << 63 for kind in kept}

        def offer(kind: str, value: bytes) -> None:
            if len(value) > EXAMPLE_CHARS or (place := _place(value)) > floor[kind]:
                return
            own = kept[kind]
            own[value] = place
            if len(own) >= 2 * most:
                least = sorted(own.items(), key=lambda x: (x[1], x[0]))[:most]
                kept[kind], floor[kind] = dict(least), least[-1][1]

        for batch in slices(batches, "text"):
            texts = strings(batch.column("text"))
            found = Found(texts)
            own, at = "", -1
            for text, kind, _, stop, credential in found.base.T.tolist():
                if text != at:
                    own, at = texts[text].as_py(), text
                offer(KINDS[kind], own[credential:stop].encode())
            raw = found.data.tobytes()
            for first, length in zip(found.runs[3].tolist(), (found.runs[2] - found.runs[1]).tolist(), strict=True):
                offer(PLAIN, raw[first : first + length])
        rows = [(k, p, v.decode()) for k, own in kept.items() for v, p in sorted(own.items(), key=lambda x: (x[1], x[0]))[:most]]
        names, kinds = ["kind", "place", "value"], [pa.string(), pa.int64(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    documents.select("text").mapInArrow(run, SAMPLE).distinct().write.parquet(folder := work_dir(spark, "secret-examples"))
    sample = spark.read.schema(SAMPLE).parquet(folder)
    # A histogram of the hashes tells below which the smallest lie, so no task gets what all others found.
    sample = sample.withColumn("step", F.floor(F.log2(F.col("place") + 1.0) * 16))
    below = Window.partitionBy("kind").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = sample.groupBy("kind", "step").agg(F.count("*").alias("n"))
    low = steps.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))).where(F.col("before") < most)
    order = Window.partitionBy("kind").orderBy("place", "value")
    few = sample.join(low.select("kind", "step"), ["kind", "step"], "left_semi")
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("kind", "place", "value")


def fit(spark: SparkSession, documents: DataFrame) -> Formats:
    """Formats of the credentials in the documents: EXAMPLES a kind at most come to the driver."""
    found: dict[str, list[str]] = {}
    for row in examples(spark, documents).collect():
        found.setdefault(row.kind, []).append(row.value)
    return learned(found)


def scan(spark: SparkSession, documents: DataFrame, formats: Formats | None = None) -> DataFrame:
    """SPANS: one row per document, its secrets by start and then kind.

    documents: doc_id, text; other columns are dropped. Kinds are KINDS for matches of the patterns,
    each taken leftmost and without overlap, and INFERRED followed by one of them for runs whose format
    speaks for it, with its gain in nats; such a run overlaps no match. Places count characters. A
    null text is empty and has no spans; repeated rows get equal rows; empty tables none. `formats`
    is learned from the documents themselves unless given.
    """
    formats = formats or fit(spark, documents)
    # The model is bounded: a kept state was reached by two examples at least.
    sent = spark.sparkContext.broadcast(formats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = list(model.kinds)
        for batch in slices(batches, "text"):
            texts = strings(batch.column("text"))
            found = Found(texts)
            spans: list[list[dict]] = [[] for _ in range(len(texts))]
            for text, kind, start, stop, _ in found.base.T.tolist():
                spans[text].append({"kind": KINDS[kind], "start": start, "end": stop, "gain": None})
            kinds, gains = model.gains(*found.coded_runs())
            for k in np.flatnonzero(kinds >= 0).tolist():
                text, start, stop, _ = (int(x[k]) for x in found.runs)
                kind = INFERRED + names[kinds[k]]
                spans[text].append({"kind": kind, "start": start, "end": stop, "gain": float(gains[k])})
            for own in spans:  # base matches stand in order, and an inferred span never begins with one
                own.sort(key=lambda s: s["start"])
            one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gain", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(one))], names=["doc_id", "spans"]
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SPANS)
