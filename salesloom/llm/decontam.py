"""Benchmark decontamination by templates.

Texts are reduced to templates: numbers, names and units become typed placeholders, other
words lose case and punctuation. Windows of a template that occur both in a document and in a
benchmark item line the two up. Where a long enough run of windows lies on one line, the values
in the placeholders are compared: a re-parameterised question replaces each value by one other
value throughout, so the slots of a true match are consistent. Equal values need no such proof.

A capitalised word that begins a sentence may be a name or not. Windows are therefore made three
times: of templates, of templates where such words are names, and of plain words in lower case;
a place lines up where any of them meet. Items below the window meet as a whole, word for word.

The windows of the benchmark are sent to all tasks if they are at most MAX_WINDOWS. A larger
benchmark meets the documents in a hash join of windows, and only the pairs found there are
compared.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.textops import Words, as_signed, fresh, rolling, slices, strings

#: Words of a window, and words that must agree in a row (or all of a shorter item but one).
WINDOW = 6
RUN = 12
#: Share of the words of a run that must be words, not placeholders.
LITERAL = 0.4
#: Share of the slots of a run that must follow one replacement of values.
CONSISTENT = 0.8
#: Windows of a benchmark that are sent to all tasks at most (16 bytes each, and the items).
MAX_WINDOWS = 1 << 20

PAIRS = (
    "doc_id long, item_id long, first_word long, n_words long, item_words long, n_slots long, "
    "changed_slots long, exact boolean"
)

# Names of units.
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet yard yards "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons cup cups "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees kmh mph".split()
)
_EDGE = re.compile(r"^\W+|\W+$")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?$")
_NUMBER_UNIT = re.compile(r"([+-]?\d[\d.,]*)([a-z]+)$")
_WORD, _NUM, _UNIT = 0, 1, 2
_MARK = {kind: xxhash.xxh3_64_intdigest(mark) for kind, mark in ((_NUM, b"<num>"), (_UNIT, b"<unit>"))}
_NAME = xxhash.xxh3_64_intdigest(b"<name>")
_PLACEHOLDERS = np.array([*_MARK.values(), _NAME], dtype=np.uint64)
#: Places of windows that meet each other, in memory at once.
MEETINGS = 1 << 20


@dataclass
class Templates:
    """Template words of a slice of texts; words of punctuation alone are left out.

    values: a hash of the bare word in lower case. shapes: the same, or that of a placeholder.
    wide: shapes where a capitalised word that begins a sentence is a name, too.
    places: the number of the word in its text. bounds[i]:bounds[i + 1] are text i's.
    """

    values: np.ndarray
    shapes: np.ndarray
    places: np.ndarray
    bounds: np.ndarray
    wide: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Templates:
        words = Words(texts)
        own = words.vocabulary.to_pylist()
        value = np.zeros(len(own), dtype=np.uint64)
        shape = np.zeros(len(own), dtype=np.uint64)
        bare, titled, ends = (np.zeros(len(own), dtype=bool) for _ in range(3))
        for k, word in enumerate(own):
            core = _EDGE.sub("", word)
            ends[k] = word[-1] in ".?!:;" or word.rstrip("\"')]»”")[-1:] in (".", "?", "!")
            if not core:
                continue
            bare[k] = True
            low = core.lower()
            value[k] = xxhash.xxh3_64_intdigest(low)
            kind = _NUM if _NUMBER.match(low) else _UNIT if low in UNITS else _WORD
            if kind == _WORD and (both := _NUMBER_UNIT.match(low)) and both[2] in UNITS:
                kind = _NUM
            shape[k] = _MARK.get(kind, value[k])
            titled[k] = kind == _WORD and core[0].isupper() and core[1:] != core[1:].upper()
        ids = words.ids
        starts = np.ones(len(ids), dtype=bool)
        starts[1:] = ends[ids[:-1]]
        firsts = words.bounds[:-1]
        starts[firsts[firsts < len(ids)]] = True
        shapes = np.where(titled[ids] & ~starts, np.uint64(_NAME), shape[ids])
        wide = np.where(titled[ids], np.uint64(_NAME), shape[ids])
        keep = bare[ids] if len(ids) else np.empty(0, dtype=bool)
        places = np.arange(len(ids)) - np.repeat(words.bounds[:-1], words.counts)
        before = np.concatenate(([0], np.cumsum(keep)))
        return cls(value[ids][keep], shapes[keep], places[keep], before[words.bounds], wide[keep])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of WINDOW words within a text, each form once, and their places.

        A window of nothing but placeholders is left out, since it would meet any other: what it would
        line up is found from the windows beside it, or from the values themselves.
        """
        at = self._within(WINDOW)
        first = rolling(self.shapes, WINDOW)[at]
        wide, plain = rolling(self.wide, WINDOW)[at], rolling(self.values, WINDOW)[at]
        said, said_wide = self._has_words(self.shapes)[at], self._has_words(self.wide)[at]
        parts = [(first[said], at[said])]
        for own, new in ((wide, (wide != first) & said_wide), (plain, (plain != first) & (plain != wide))):
            parts.append((own[new], at[new]))
        return np.concatenate([h for h, _ in parts]), np.concatenate([x for _, x in parts])

    def _has_words(self, shapes: np.ndarray) -> np.ndarray:
        """Whether the window at each place has a word that is no placeholder."""
        words = np.concatenate(([0], np.cumsum(~np.isin(shapes, _PLACEHOLDERS))))
        return words[WINDOW:] > words[:-WINDOW] if len(words) > WINDOW else np.empty(0, dtype=bool)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `width` plain words within a text, and their places."""
        at = self._within(width)
        return rolling(self.values, width)[at], at

    def short(self) -> np.ndarray:
        """Numbers of the texts with words, but fewer than WINDOW."""
        counts = np.diff(self.bounds)
        return np.flatnonzero((counts > 0) & (counts < WINDOW))

    def _within(self, width: int) -> np.ndarray:
        owner = self.owners()
        n = max(0, len(owner) - width + 1)
        return np.flatnonzero(owner[:n] == owner[width - 1 : width - 1 + n])

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


@dataclass
class Benchmark:
    """Items as templates, with their windows sorted by hash."""

    item_ids: list[int | None]
    items: Templates

    def __post_init__(self):
        hashes, at = self.items.windows()
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.at = hashes[order], at[order]
        # A small table of leading bits tells most windows of documents apart at once.
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
        self.owner = self.items.owners()
        # Items below the window: width, then the hash of all their words, with the items' numbers.
        self.short: dict[int, dict[int, list[int]]] = {}
        for k in self.items.short().tolist():
            first, last = self.items.bounds[k : k + 2].tolist()
            whole = int(rolling(self.items.values[first:last], last - first)[0])
            self.short.setdefault(last - first, {}).setdefault(whole, []).append(k)


def compare(doc_ids: pa.Array, texts: pa.Array, bench: Benchmark) -> list[tuple]:
    """PAIRS of a slice of documents: for each document and item the longest true match."""
    docs = Templates.of(texts)
    hashes, at = docs.windows()
    likely = bench.maybe[(hashes >> np.uint64(44)).astype(np.int64)]
    hashes, at = hashes[likely], at[likely]
    order = np.argsort(at, kind="stable")
    hashes, at = hashes[order], at[order]
    low, high = np.searchsorted(bench.hashes, hashes, "left"), np.searchsorted(bench.hashes, hashes, "right")
    number = high - low
    best: dict[tuple[int, int], tuple] = {}
    # A run is found whole from any of its windows, so they can be taken a part at a time.
    part = np.cumsum(number) // MEETINGS
    for some in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
        doc, item, line, first, words = _runs(docs, bench, at[some], low[some], number[some])
        item_words = np.diff(bench.items.bounds)[item]
        longest = np.lexsort((line, first, -words))
        for k in longest[words[longest] >= np.minimum(RUN, item_words - 1)[longest]]:
            _kept(best, docs, bench, doc_ids, int(doc[k]), int(item[k]), int(first[k]), int(line[k]), int(words[k]))
    owner = docs.owners()
    for width, wholes in bench.short.items():
        hashes, at = docs.runs(width)
        for k in np.flatnonzero(np.isin(hashes, np.fromiter(wholes, dtype=np.uint64, count=len(wholes)))).tolist():
            first = int(at[k])
            for number in wholes[int(hashes[k])]:
                key = int(owner[first]), number
                own = docs.shapes[first : first + width] != docs.values[first : first + width]
                best.setdefault(key, (
                    doc_ids[key[0]].as_py(), bench.item_ids[number], int(docs.places[first]), width, width, int(own.sum()), 0, True,
                ))
    return [best[key] for key in sorted(best)]


def _runs(docs: Templates, bench: Benchmark, at, low, number) -> tuple[np.ndarray, ...]:
    """Runs of equal words around windows that meet: document, item, line, first word, words."""
    items = bench.items
    doc_at = np.repeat(at, number)
    inside = np.arange(len(doc_at)) - np.repeat(np.cumsum(number) - number, number)
    item_at = bench.at[np.repeat(low, number) + inside]
    doc, item, line = docs.owners()[doc_at], bench.owner[item_at], doc_at - item_at
    order = np.lexsort((doc_at, line, item, doc))
    doc, item, line, doc_at = doc[order], item[order], line[order], doc_at[order]
    new = np.ones(len(doc), dtype=bool)  # several forms of a window may meet at one place
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(line) != 0) | (np.diff(doc_at) > 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(doc)) - 1
    doc, item, line = doc[starts], item[starts], line[starts]
    first, last = doc_at[starts], doc_at[ends] + WINDOW if len(doc) else doc_at

    def grown(edge: np.ndarray, step: int, stop: np.ndarray) -> np.ndarray:
        """The edge moved on by `step` while the next words are equal in some form."""
        edge, open_ = edge.copy(), np.flatnonzero(edge != stop)
        while len(open_):
            a = edge[open_] if step > 0 else edge[open_] - 1
            b = a - line[open_]
            same = docs.shapes[a] == items.shapes[b]
            same |= (docs.wide[a] == items.wide[b]) | (docs.values[a] == items.values[b])
            open_ = open_[same]
            edge[open_] += step
            open_ = open_[edge[open_] != stop[open_]]
        return edge

    last = grown(last, 1, np.minimum(docs.bounds[1:][doc], items.bounds[1:][item] + line))
    first = grown(first, -1, np.maximum(docs.bounds[:-1][doc], items.bounds[:-1][item] + line))
    found = np.unique(np.array([doc, item, line, first, last - first]), axis=1)
    return tuple(found)


def _kept(best, docs, bench, doc_ids, doc: int, item: int, first: int, line: int, words: int) -> None:
    """Notes a run in `best` if it, or part of it, is a true match and longer than what is known."""
    key = doc, item
    item_words = int(bench.items.bounds[item + 1] - bench.items.bounds[item])
    if key in best and best[key][3] >= words:
        return
    there = first - line
    slots = _slots(docs, first, bench.items, there, words)
    if slots is None:  # part of the run may still be a copy
        ahead, words = _equal_run(docs.values[first : first + words] == bench.items.values[there : there + words])
        if words < min(RUN, item_words - 1) or key in best and best[key][3] >= words:
            return
        first, there = first + ahead, there + ahead
        slots = int((docs.shapes[first : first + words] != docs.values[first : first + words]).sum()), 0
    exact = bool((docs.values[first : first + words] == bench.items.values[there : there + words]).all())
    best[key] = (
        doc_ids[doc].as_py(), bench.item_ids[item], int(docs.places[first]), words, item_words, *slots, exact,
    )


def _equal_run(same: np.ndarray) -> tuple[int, int]:
    """Start and length of the longest run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return 0, 0
    longest = int(lengths.argmax())
    return int(starts[longest]), int(lengths[longest])


def _slots(docs: Templates, first: int, items: Templates, there: int, words: int) -> tuple[int, int] | None:
    """Slots of a run and how many changed their value; None where the run is no true match."""
    shapes = docs.shapes[first : first + words]
    ours, theirs = docs.values[first : first + words], items.values[there : there + words]
    slot = np.flatnonzero((shapes != ours) | (ours != theirs))
    if words - len(slot) < LITERAL * words and (ours != theirs).any():
        return None
    pairs = Counter(zip(theirs[slot].tolist(), ours[slot].tolist(), strict=True))
    usual: dict[int, int] = {}
    for (theirs_value, _), n in pairs.items():
        usual[theirs_value] = max(usual.get(theirs_value, 0), n)
    if sum(usual.values()) < CONSISTENT * len(slot):
        return None
    return len(slot), int((theirs[slot] != ours[slot]).sum())


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in PAIRS.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.bool_()]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def leaks(documents: DataFrame, benchmark: DataFrame, max_windows: int | None = None) -> DataFrame:
    """PAIRS: each document that holds an item or a long part of it, with the item.

    documents: doc_id, text; benchmark: item_id, text; other columns are dropped. Null and empty
    texts match nothing. Items shorter than WINDOW words match as a whole, word for word. A repeated document has its
    rows once each; of repeated items each has its row. `exact` means that no value changed.
    """
    max_windows = MAX_WINDOWS if max_windows is None else max_windows
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    # Words bound the windows; a sum over the benchmark is cheap beside reading the documents.
    if (items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0) > max_windows:
        return _joined(documents, items)
    rows = items.toArrow()
    bench = Benchmark(rows.column("item_id").to_pylist(), Templates.of(strings(rows.column("text").combine_chunks())))
    shared = documents.sparkSession.sparkContext.broadcast(bench)  # max_windows bound its size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield _pairs(compare(batch.column("doc_id"), strings(batch.column("text")), shared.value))

    return documents.mapInArrow(run, PAIRS)


def _joined(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The same with a hash join of windows in place of a benchmark in every task."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = Templates.of(strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.diff(own.bounds)[own.short()]))], names=["width"])

    # Lengths of items below the window: WINDOW - 1 numbers at most.
    widths = [row["width"] for row in items.select("text").mapInArrow(counts, "width long").distinct().collect()]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = Templates.of(strings(batch.column("text")))
            parts = [own.windows(), *(own.runs(width) for width in widths)]
            hashes, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            keys = np.unique(np.rec.fromarrays([own.owners()[at], hashes]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(keys["f0"])), pa.array(as_signed(np.ascontiguousarray(keys["f1"])))],
                names=["id", "window"],
            )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for k in range(batch.num_rows):
                item = pa.array([batch.column("item_text")[k].as_py()], pa.large_string())
                bench = Benchmark([batch.column("item_id")[k].as_py()], Templates.of(item))
                rows += compare(batch.column("doc_id").slice(k, 1), strings(batch.column("text").slice(k, 1)), bench)
            yield _pairs(rows)

    # A key made of id and text stands for rows that repeat both, and for null ids.
    keyed = documents.withColumn("id", F.xxhash64("doc_id", "text"))
    theirs = items.withColumn("id", F.xxhash64("item_id", "text"))
    ours = keyed.select("id", "text").mapInArrow(windows, "id long, window long")
    wanted = theirs.select("id", "text").mapInArrow(windows, "id long, window long")
    pairs = ours.join(wanted.withColumnRenamed("id", "item"), "window").select("id", "item").distinct()
    return (
        pairs.join(keyed, "id")
        .join(theirs.select(F.col("id").alias("item"), "item_id", F.col("text").alias("item_text")), "item")
        .select("doc_id", "text", "item_id", "item_text")
        .mapInArrow(verify, PAIRS)
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame, max_windows: int | None = None) -> DataFrame:
    """`documents`, all columns, without the rows whose text holds part of the benchmark.

    Each row is judged by its own text, also among rows that share an id or have none.
    """
    max_windows = MAX_WINDOWS if max_windows is None else max_windows
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    if (rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0) > max_windows:
        # A key made of id and text stands for the row, as in `_joined`.
        key = fresh(documents.columns, "row_key")
        keyed = documents.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
        found = leaks(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark, max_windows)
        found = found.select(F.col("doc_id").alias(key)).distinct()
        return keyed.join(found, key, "left_anti").select(*documents.columns)
    rows = rows.toArrow()
    bench = Benchmark(rows.column("item_id").to_pylist(), Templates.of(strings(rows.column("text").combine_chunks())))
    shared = documents.sparkSession.sparkContext.broadcast(bench)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            numbers = pa.array(np.arange(batch.num_rows))
            hit = {row[0] for row in compare(numbers, strings(batch.column("text")), shared.value)}
            yield batch.filter(pa.array([k not in hit for k in range(batch.num_rows)], pa.bool_()))

    return documents.mapInArrow(run, T.StructType(documents.schema.fields))

