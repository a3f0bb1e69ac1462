"""Language-model scoring by a probabilistic suffix tree over bytes.

The tree holds contexts of up to DEPTH bytes. Counts of all contexts come from every byte of
all training texts. A context is kept where its next-byte distribution differs from that of
the context one byte shorter: its count times the Kullback-Leibler divergence must reach
GAIN nats. Kept contexts bring their suffixes along, so each state is a suffix of the next.
A state's distribution is smoothed by the state one byte shorter, down to a root that gives
every byte and the end of a text some mass: probabilities of all texts add up to one.

A text is scored by the longest kept suffix of what came before each byte. The tree is a table
and only the divergence test bounds it. Contexts travel once for each part of the documents they
occur in, and those of the tree come back to them with their counts. A filter of fixed size
tells most others apart before they travel; it never loses one of the tree.

Beside it stands a base score from word counts. Words travel in the same way, and come back
with their count in the whole corpus.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.langid import held_out
from salesloom.llm.substring import discard
from salesloom.llm.textops import Words, as_signed, lower_ascii, mixed, slices, strings
from salesloom.plans.session import work_dir

DEPTH = 6
#: Nats that a context must explain beyond its suffix.
GAIN = 20.0
#: Weight of the shorter context in a distribution, in counts.
BACKOFF = 2.0
#: Mass of a symbol never seen, in counts of the root.
UNSEEN = 0.5

END, START = 256, 257
SYMBOLS = 257  # bytes and the end can come next
BITS = 9
SYMBOL = (1 << BITS) - 1
KEY_BITS = 56  # a context's length stands above its codes
#: Distinct grams that a task merges before it sends them on.
MERGE = 3 << 20
#: Lengths of contexts that one pass over the texts counts.
LEVELS = 2
#: Bytes of text whose codes are held at once: each byte takes up to 40 bytes of arrays.
CODE_BYTES = 2 << 20
#: Bytes of text of a slice, the unit that words travel for.
SLICE_BYTES = 8 << 20
#: Slices of a part, the unit that contexts travel for: most slices ask for much the same ones.
PART_SLICES = 4
#: Bits of the filter of contexts; more contexts let more others pass and lose none.
FILTER_BITS = 26
#: Runs of the tree whose chances are worked out at once.
NODE_ROWS = 1 << 20


def byte_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each text and its end, as codes, with the bounds of texts."""
    raw, offsets = joined_bytes(texts)
    bounds = offsets + np.arange(len(offsets))
    codes = np.full(bounds[-1], END, dtype=np.int16)
    places = np.arange(len(raw)) + np.repeat(np.arange(len(texts)), np.diff(offsets))
    codes[places] = raw
    return codes, bounds


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, with the bounds of texts."""
    values = texts.cast(pa.large_binary()).to_pylist()
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in values], dtype=np.int64)))
    return np.frombuffer(b"".join(values), dtype=np.uint8), offsets


def grams(codes: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """A packed number for each code and the `depth` codes before it, START before a text.

    The code just before stands highest, the code itself lowest: sorted numbers have equal contexts,
    and contexts with equal ends, next to each other.
    """
    texts = len(bounds) - 1
    padded = np.full(len(codes) + depth * texts, START, dtype=np.int64)
    places = np.arange(len(codes)) + depth * (np.repeat(np.arange(texts), np.diff(bounds)) + 1)
    padded[places] = codes
    packed = np.zeros(max(len(padded) - depth, 0), dtype=np.int64)
    for back in [*range(1, depth + 1), 0]:
        packed <<= BITS
        packed |= padded[depth - back : len(padded) - back]
    return packed[places - depth]


def ends(packed: np.ndarray, length: int, depth: int = DEPTH) -> np.ndarray:
    """The last `length` codes of each context of `packed` runs."""
    return packed >> (BITS * (depth - length + 1))


def first_of(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([len(values) > 0], values[1:] != values[:-1])))


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter `words` may hold each key."""
    at = _filter_places(keys)
    return (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each number once, with the sum of its counts."""
    keys, places = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(places, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def counted(training: DataFrame, depth: int, known: int = 0, words=None) -> DataFrame:
    """gram, n: packed runs of depth + 1 codes in the texts of `training` (text), merged in each task.

    With a filter `words` (a broadcast), only runs whose context's last `known` codes pass it.
    """
    most = MERGE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "text", CODE_BYTES):
            codes, bounds = byte_codes(lower_ascii(strings(batch.column("text"))))
            packed = grams(codes, bounds, depth)
            if words is not None:
                packed = packed[may_hold(words.value, (known << KEY_BITS) | ends(packed, known, depth))]
            held.append(np.unique(packed, return_counts=True))
            size += len(held[-1][0])
            if size > most:
                held = [merged(held)]
                size = len(held[0][0])
                if size > most // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["gram", "n"])
                    size = 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], names=["gram", "n"])

    return training.select("text").mapInArrow(run, "gram long, n long")


def extendable(gain: float) -> int:
    """The count from which a context may have longer ones that gain `gain`; see `candidates`."""
    return math.ceil(gain * math.e - 1e-6)


CANDIDATES = "key long, total long, passed boolean, next binary"


def tested(counts: DataFrame, known: int, depth: int, gain: float) -> DataFrame:
    """Contexts of more than `known` codes, up to `depth`, that pass the divergence test or can be extended.

    counts: runs of depth + 1 codes. All runs whose contexts share their last `known` codes meet in one
    task; there are 257 ** (depth - known + 1) at most, whatever the corpus. The empty context is among
    the contexts where `known` is 0.
    """
    most = MERGE
    group = F.shiftright("gram", BITS * (depth - known + 1)) if known else F.lit(0).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([column.to_numpy() for column in batch.columns])
            size += batch.num_rows
            if size > most:
                groups, grams_, counts_ = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = np.searchsorted(groups, groups[-1])  # the last group may go on
                held, size = [[groups[whole:], grams_[whole:], counts_[whole:]]], 0
                if whole:
                    yield from candidates(grams_[:whole], counts_[:whole], known, depth, gain)
        if held:
            _, grams_, counts_ = (np.concatenate(x) for x in zip(*held, strict=True))
            yield from candidates(grams_, counts_, known, depth, gain)

    # Summed before they meet, so that a group has one row for each of its runs.
    sums = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    rows = sums.select(group.alias("part"), "gram", "n").repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(run, CANDIDATES)


def candidates(
    grams_: np.ndarray, counts: np.ndarray, known: int, depth: int, gain: float
) -> Iterator[pa.RecordBatch]:
    """The rows of `tested` for whole groups of runs.

    A context seen t times, its suffix S times, gains t * log(S / t) at most, which is S / e where t is
    best: below gain * e, a context can't be extended.
    """
    order = np.argsort(grams_)
    keys, n = grams_[order], counts[order]
    for length in range(depth, known if known else -1, -1):
        whole = keys >> BITS
        begins = first_of(whole)
        contexts, sizes = whole[begins], np.diff(np.append(begins, len(keys)))
        owner = np.repeat(np.arange(len(contexts)), sizes)
        totals = np.bincount(owner, weights=n)
        passed = np.zeros(len(contexts), dtype=bool)
        if length:
            without_oldest = ((whole >> BITS) << BITS) | (keys & SYMBOL)
            short, at = np.unique(without_oldest, return_inverse=True)
            short_n = np.bincount(at, weights=n).astype(np.int64)
            _, short_owner = np.unique(short >> BITS, return_inverse=True)
            short_totals = np.bincount(short_owner, weights=short_n)
            ratio = n * short_totals[short_owner[at]] / (totals[owner] * short_n[at])
            passed = np.bincount(owner, weights=n * np.log(ratio)) >= gain
        kept = passed | (totals >= extendable(gain)) if length else np.ones(len(contexts), dtype=bool)
        chosen = kept[owner]  # runs are in the order of their contexts
        bounds = np.concatenate(([0], np.cumsum(sizes[kept]))) * 8
        runs = (n[chosen] << BITS) | (keys[chosen] & SYMBOL)
        packed = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(runs)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((length << KEY_BITS) | contexts[kept]),
                pa.array(totals[kept].astype(np.int64)),
                pa.array(passed[kept]),
                pa.Array.from_buffers(pa.binary(), len(bounds) - 1, packed),
            ],
            names=["key", "total", "passed", "next"],
        )
        if length:
            keys, n = short, short_n


def stored(rows: DataFrame, path: str) -> DataFrame:
    """The rows, written and read again; what was shuffled for them is deleted once they are written."""
    conf, name = rows.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        rows.write.options(compression="zstd").parquet(path)
    finally:
        conf.set(name, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def learned(spark: SparkSession, training: DataFrame, depth: int = DEPTH, gain: float = GAIN) -> DataFrame:
    """key, next: the kept contexts (length << KEY_BITS | codes), each with its runs (n << BITS | symbol, of 8 bytes each).

    Contexts are counted from short to long, LEVELS lengths in one pass over the texts. A pass counts
    only below contexts that can be extended: a filter of fixed size lets all of those through, and a
    few others, which the test then drops. No text at all gives an empty tree.
    """
    folder = work_dir(spark, "pst")
    known, words, parts = 0, None, []
    for deepest in [*range(LEVELS, depth, LEVELS), depth]:
        found = tested(counted(training, deepest, known, words), known, deepest, gain)
        parts.append(stored(found, f"{folder}/to={deepest}"))
        if deepest < depth:
            longest = parts[-1].where((F.shiftright("key", KEY_BITS) == deepest) & (F.col("total") >= extendable(gain)))
            known, words = deepest, spark.sparkContext.broadcast(context_filter(longest))
    rows = reduce(DataFrame.unionByName, parts)
    # Kept contexts bring their suffixes along, the empty one among them: all can be extended.
    # The oldest code stands lowest.
    length = F.shiftright("key", KEY_BITS)
    codes = F.col("key").bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    suffixes = F.transform(
        F.sequence(F.lit(0).cast("long"), length),
        lambda k: F.shiftleft(k, KEY_BITS).bitwiseOR(F.call_function("shiftright", codes, (BITS * (length - k)).cast("int"))),
    )
    chosen = rows.where("passed").select(F.explode(suffixes).alias("key"))
    chosen = chosen.unionByName(spark.range(1).select(F.col("id").alias("key"))).distinct()
    tree = stored(rows.join(chosen, "key", "left_semi").select("key", "next"), f"{folder}/tree")
    for deepest in [*range(LEVELS, depth, LEVELS), depth]:  # nothing reads them again
        discard(spark, f"{folder}/to={deepest}")
    return tree


def _filter_places(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def context_filter(tree: DataFrame) -> np.ndarray:
    """A bit for the hash of each context of the tree, in 64-bit words; the size is fixed."""
    size = 1 << (FILTER_BITS - 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size, dtype=np.uint64)
        for batch in batches:
            at = _filter_places(batch.column("key").to_numpy())
            np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(as_signed(words[used]))], names=["word", "bits"])

    parts = tree.select("key").mapInArrow(run, "word long, bits long")
    found = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most `size` rows
    words = np.zeros(size, dtype=np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return words


def tree_contexts(packed: np.ndarray, words: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Keys of the contexts in `packed` runs that may be in the tree, each once."""
    alive = np.sort(packed >> BITS)
    alive = alive[first_of(alive)]
    found = [np.zeros(1, dtype=np.int64)]
    for length in range(1, depth + 1):  # a context stands in the tree only with its suffixes
        keys = (length << KEY_BITS) | (alive >> (BITS * (depth - length)))
        begins = first_of(keys)
        passed = may_hold(words, keys[begins])
        found.append(keys[begins][passed])
        alive = alive[np.repeat(passed, np.diff(np.append(begins, len(keys))))]
    return np.concatenate(found)


def _gram_parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Packed runs of the texts, of CODE_BYTES at once, with their bounds."""
    for part in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", CODE_BYTES):
        codes, bounds = byte_codes(strings(part.column("text")))
        yield grams(codes, bounds, DEPTH), bounds


class Nodes:
    """Contexts of the tree with their suffixes, and the chance of each symbol that followed them.

    keys; runs: n << BITS | symbol of the context keys[owner].
    """

    def __init__(self, keys: np.ndarray, owner: np.ndarray, runs: np.ndarray):
        if not (keys == 0).any():  # nothing was learned
            keys = np.append(keys, 0)
        order = np.argsort(keys)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.keys = keys[order]
        del order
        # A part's tree has tens of millions of runs: temporaries are let go as soon as they are used.
        pairs = rank[owner]
        pairs <<= BITS
        pairs |= runs & SYMBOL
        order = np.argsort(pairs)
        pairs = pairs[order]
        counts = runs[order]
        del order
        counts >>= BITS
        counts = counts.astype(float)
        owner, symbols = pairs >> BITS, (pairs & SYMBOL).astype(np.int16)
        totals = np.bincount(owner, weights=counts, minlength=len(keys))
        lengths = self.keys >> KEY_BITS
        codes = self.keys & ((1 << KEY_BITS) - 1)
        shorter = np.maximum(lengths - 1, 0) << KEY_BITS | codes >> BITS  # the oldest code stands lowest
        self.suffix = np.searchsorted(self.keys, shorter)
        self.left = BACKOFF / (totals + BACKOFF)  # what a context leaves to its suffix
        self.never = UNSEEN / (totals[0] + UNSEEN * SYMBOLS)
        self.pairs = pairs = np.append(pairs, np.iinfo(np.int64).max)
        self.chances = np.zeros(len(self.pairs))
        edges = np.searchsorted(owner, np.searchsorted(lengths, np.arange(lengths[-1] + 2)))
        self.chances[: edges[1]] = (counts[: edges[1]] + UNSEEN) / (totals[0] + UNSEEN * SYMBOLS)
        for start, stop in zip(edges[1:], edges[2:], strict=False):  # shorter contexts are done
            for first in range(start, stop, NODE_ROWS):  # each run on its own: pieces of a level
                last = min(first + NODE_ROWS, stop)
                at = owner[first:last]
                place = np.searchsorted(pairs, (self.suffix[at] << BITS) | symbols[first:last])
                below = np.where(place < start, self.chances[place], 0.0)  # as before this level was begun
                self.chances[first:last] = (counts[first:last] + BACKOFF * below) / (totals[at] + BACKOFF)

    def chance(self, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Of each symbol after the context keys[at]."""
        out = np.full(len(at), self.never)
        left, open_ = np.ones(len(at)), np.arange(len(at))
        while len(open_):
            wanted = (at << BITS) | symbols[open_]
            place = np.searchsorted(self.pairs, wanted)
            found = self.pairs[place] == wanted
            out[open_[found]] = self.chances[place[found]]
            open_, at = open_[~found], at[~found]
            deep = at > 0  # the root has no suffix
            open_, at = open_[deep], at[deep]
            left[open_] *= self.left[at]
            at = self.suffix[at]
        return out * left


def run_scores(packed: np.ndarray, nodes: Nodes, depth: int = DEPTH) -> np.ndarray:
    """log10 of the probability of each of `packed` runs; `nodes` holds all of their contexts in the tree."""
    own, places = np.unique(packed, return_inverse=True)
    begins = first_of(own >> BITS)
    contexts, sizes = own[begins], np.diff(np.append(begins, len(own)))
    longest, alive = np.zeros(len(contexts), dtype=np.int64), np.arange(len(contexts))
    for length in range(1, depth + 1):
        wanted = (length << KEY_BITS) | ends(contexts[alive], length, depth)
        at = np.minimum(np.searchsorted(nodes.keys, wanted), len(nodes.keys) - 1)
        there = nodes.keys[at] == wanted
        alive = alive[there]
        longest[alive] = at[there]
    return np.log10(nodes.chance(np.repeat(longest, sizes), own & SYMBOL))[places]


SLICES = (
    "part long, doc_ids binary, id_known binary, held_out binary, texts binary, offsets binary, "
    "vocabulary binary, train_counts binary, contexts binary"
)
RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def sliced(documents: DataFrame, words) -> DataFrame:
    """One row for each slice of documents: texts and vocabulary, as hashes; and one for each part, of
    PART_SLICES slices: vocabulary with counts in training texts, and contexts that pass the filter.

    A word is known by a 64-bit hash of its bytes. Under 10**9 different words the chance that
    any two of them share one is below 3 %, and such a pair would add up their counts.
    """
    most, together = SLICE_BYTES, PART_SLICES
    names = [field.split()[0] for field in SLICES.split(", ")]
    new_name = lambda: uuid.uuid4().int >> 65

    def row(part: int, **values) -> pa.RecordBatch:
        binary = [pa.array([bytes(values[name]) if name in values else None], pa.binary()) for name in names[1:]]
        return pa.RecordBatch.from_arrays([pa.array([part]), *binary], names=names)

    def whole(part: int, vocabularies: list, contexts: list) -> pa.RecordBatch:
        words_, counts = merged(vocabularies)
        return row(part, vocabulary=words_.data, train_counts=counts.data, contexts=np.unique(np.concatenate(contexts)).data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, vocabularies, contexts = new_name(), [], []
        for batch in slices(batches, "text", most):
            texts = lower_ascii(strings(batch.column("text")))
            own = Words(texts)
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            trains = np.repeat(~held, own.counts)
            doc_ids = batch.column("doc_id")
            raw, offsets = joined_bytes(texts)
            hashes = as_signed(own.vocabulary_hashes())
            yield row(
                part,
                doc_ids=doc_ids.fill_null(0).to_numpy(),
                id_known=doc_ids.is_valid().to_numpy(zero_copy_only=False),
                held_out=held,
                texts=pa.compress(raw, "zstd"),  # it travels once
                offsets=offsets,
                vocabulary=hashes,
            )
            vocabularies.append((hashes, np.bincount(own.ids[trains], minlength=len(own.vocabulary))))
            contexts.append(np.concatenate([tree_contexts(packed, words.value) for packed, _ in _gram_parts(texts)]))
            if len(contexts) == together:
                yield whole(part, vocabularies, contexts)
                part, vocabularies, contexts = new_name(), [], []
        if contexts:
            yield whole(part, vocabularies, contexts)

    return documents.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(run, SLICES)


def word_uses(parts: DataFrame) -> DataFrame:
    """part, word, n: each word of each part once, with its training count there."""
    rows = parts.where("contexts IS NOT NULL").select("part", "vocabulary", "train_counts")
    return _unpacked(rows, ["part", "word", "n"])


def context_uses(parts: DataFrame) -> DataFrame:
    """part, key: each context of each part once."""
    return _unpacked(parts.where("contexts IS NOT NULL").select("part", "contexts"), ["part", "key"])


def _unpacked(parts: DataFrame, names: list[str]) -> DataFrame:
    """The first column with each number of the others, which are packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                columns = [np.frombuffer(x, dtype=np.int64) for x in packed]
                arrays = [np.full(len(columns[0]), part), *columns]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names)

    return parts.mapInArrow(run, ", ".join(f"{name} long" for name in names))


WORD, NODE, SLICE = range(3)


def scored(parts: DataFrame, known: DataFrame, nodes: DataFrame, texts: int, words: int, distinct: int) -> DataFrame:
    """The result rows of all slices.

    known: part, word, c; nodes: part, key, next. They come to the slices of their part row by row,
    sorted before them, so that no row holds more than one context and each is sent once a part.
    """
    tokens, types = words + texts, distinct + (texts > 0)

    def answered(slice_: pa.RecordBatch, found: np.ndarray, found_counts: np.ndarray, tree: Nodes) -> pa.RecordBatch:
        array = lambda name, kind: np.frombuffer(slice_.column(name)[0].as_buffer(), dtype=kind)
        doc_ids, held = array("doc_ids", np.int64), array("held_out", bool)
        offsets, own = array("offsets", np.int64), array("vocabulary", np.int64)
        text = pa.decompress(slice_.column("texts")[0].as_buffer(), int(offsets[-1]), "zstd")
        lines = pa.Array.from_buffers(pa.large_string(), len(held), [None, pa.py_buffer(offsets), text])
        split = Words(lines)  # the same numbers as when the vocabulary was written
        bounds, ids = split.bounds, split.ids
        at = np.searchsorted(found, own)
        counts = np.where(found[at] == own, found_counts[at], 0)
        scores = [_run_sums(run_scores(packed, tree), ends_) for packed, ends_ in _gram_parts(lines)]
        below = np.log10(tokens + 0.5 * (types + 1))
        value = np.append(np.log10(counts + 0.5) - below, 0.0)
        seen = np.append(counts > 0, False)
        hits = np.concatenate(([0], np.cumsum(seen[ids])))
        end = np.log10(texts + 0.5) - below
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, mask=~array("id_known", bool)),
                pa.array(held),
                pa.array(np.diff(bounds) + 1),
                pa.array(np.diff(hits[bounds]) + (texts > 0)),
                pa.array(np.full(len(held), tokens, dtype=np.int64)),
                pa.array(_run_sums(value[ids], bounds) + end),
                pa.array(np.concatenate(scores)),
            ],
            names=[field.split()[0] for field in RESULT.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ready, none = None, None, np.empty(0, dtype=np.int64)
        for batch in batches:
            owners, kinds = (batch.column(name).to_numpy() for name in ("part", "kind"))
            begins = np.union1d(first_of(owners), first_of(kinds))
            for first, last in zip(begins, np.append(begins[1:], len(owners)), strict=True):
                rows, kind = batch.slice(first, last - first), kinds[first]
                if owners[first] != part:
                    part, ready = owners[first], None
                    own_words, own_nodes = [(none, none)], [(none, none, none)]
                if kind == WORD:
                    own_words.append((rows.column("key").to_numpy(), rows.column("c").to_numpy()))
                elif kind == NODE:
                    following = rows.column("next").to_pylist()
                    sizes = np.array([len(x) for x in following]) >> 3
                    own_nodes.append((rows.column("key").to_numpy(), sizes, np.frombuffer(b"".join(following), dtype=np.int64)))
                else:
                    if ready is None:  # all that the part asked for has come
                        found, counts = (np.concatenate(x) for x in zip(*own_words, strict=True))
                        order = np.argsort(found)
                        found = np.append(found[order], np.iinfo(np.int64).max)
                        keys, sizes, runs = (np.concatenate(x) for x in zip(*own_nodes, strict=True))
                        own_words, own_nodes = [], []
                        tree = Nodes(keys, np.repeat(np.arange(len(keys)), sizes), runs)
                        del keys, sizes, runs  # the tree holds what it needs
                        ready = found, np.append(counts[order], 0), tree
                    for k in range(rows.num_rows):
                        yield answered(rows.slice(k, 1), *ready)

    columns = ["doc_ids", "id_known", "held_out", "texts", "offsets", "vocabulary"]
    rows = parts.where("texts IS NOT NULL").select("part", F.lit(SLICE).alias("kind"), *columns)
    words_ = known.select("part", F.lit(WORD).alias("kind"), F.col("word").alias("key"), "c")
    contexts = nodes.select("part", F.lit(NODE).alias("kind"), "key", "next")
    joined = words_.unionByName(contexts, True).unionByName(rows, True)
    return joined.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, RESULT)


def _run_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of each run, each over its own values, so that nothing cancels."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.bincount(owner, weights=values, minlength=len(bounds) - 1)


def score(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    documents: doc_id, text; a null text is empty. Learns from the rows whose crc32 of the id as
    text doesn't leave 1 modulo 5. A-Z count as a-z. A text without words has one token, its end.
    Where nothing was learned, counts are 0. Repeated rows are learned and scored as often as they
    stand there.
    """
    folder = work_dir(spark, "lm-score")
    rows = documents.select("doc_id", "text", held_out("doc_id", 5, 1).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    tree = learned(spark, training)
    words = spark.sparkContext.broadcast(context_filter(tree))  # 2 ** (FILTER_BITS - 3) bytes
    parts = stored(sliced(rows, words), f"{folder}/slices")
    # A word has one row a part at most, so even the most frequent one is a small share.
    same = Window.partitionBy("word")
    uses = word_uses(parts).select("part", "word", "n", F.sum("n").over(same).alias("c"), F.count("*").over(same).alias("places"))
    uses = stored(uses.where("c > 0"), f"{folder}/words")
    by_places = uses.groupBy("places").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    size = by_places.agg(
        F.coalesce(F.sum(F.expr("rows div places")), F.lit(0)).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")
    ).first()
    # A context has one row a part at most, too.
    nodes = context_uses(parts).join(tree, "key")
    return scored(parts, uses, nodes, training.count(), int(size["words"]), int(size["distinct"]))
