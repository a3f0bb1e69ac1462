"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shape statistics of the line and of its two
neighbours; a chain joins the labels of neighbouring lines. For training, the lines of a
labelled document take the document's label. A document's quality is the mean of its lines'
forward-backward marginals of being good, weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.langid import held_out
from salesloom.llm.textops import Words, fresh, slices, strings

#: Labelled documents of each label that the fit reads at most, chosen by a hash of the id; those with
#: more lines are not drawn. All others are read whole.
SAMPLE_ROWS = 3_000
SAMPLE_LINES = 400
#: Lines whose features are in memory at once, and lines of a text that are walked in one piece.
BLOCK_LINES = 50_000
PIECE_LINES = 4_096
#: Bytes of text that are scored at once.
SLICE = 4 << 20
#: Error of the log-odds that a walk in pieces may leave.
EXACT = 1e-12
ROUNDS = 150
STEP = 0.1
PENALTY = 1e-3
#: Documents are rejected below this score.
THRESHOLD = 0.3

OWN = 16
FEATURES = 3 * OWN + 3
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

# Byte classes, as bits.
_LETTER, _UPPER, _DIGIT, _SYMBOL, _BLANK, _STOP, _CALL = (1 << k for k in range(7))


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for byte in range(256):
        char = chr(byte)
        if byte >= 128 or char.isalpha():
            table[byte] = _LETTER | (_UPPER if "A" <= char <= "Z" else 0)
        elif char.isdigit():
            table[byte] = _DIGIT
        elif char in " \t\r\n\v\f":
            table[byte] = _BLANK
        elif char in ".?":
            table[byte] = _STOP
        elif char == "!":
            table[byte] = _CALL
        elif char not in ",;:'\"-()":
            table[byte] = _SYMBOL
    return table


_CLASSES = _byte_classes()


class Lines:
    """The lines of a slice of texts; bounds[i]:bounds[i + 1] are text i's."""

    def __init__(self, texts: pa.Array):
        split = pc.split_pattern(texts, "\n")
        self.bounds = split.offsets.to_numpy().astype(np.int64)
        self.bounds = self.bounds - self.bounds[0]
        self.lines = split.flatten()
        self.weights = pc.binary_length(self.lines).to_numpy(zero_copy_only=False) + 1.0

    @property
    def features(self) -> np.ndarray:
        return np.concatenate([self._block(*block) for block in self._blocks()] or [np.empty((0, FEATURES), np.float32)])

    def emissions(self, field: Field) -> np.ndarray:
        """The field's log-odds of each line; features of BLOCK_LINES at most are in memory."""
        return np.concatenate([field.emissions(self._block(*block)) for block in self._blocks()] or [np.empty(0)])

    def _blocks(self) -> list[tuple[int, int]]:
        return [(first, min(first + BLOCK_LINES, len(self.lines))) for first in range(0, len(self.lines), BLOCK_LINES)]

    def _block(self, first: int, last: int) -> np.ndarray:
        # A line's features hold those of its neighbours, and theirs whether they repeat the line before.
        low, high = max(first - 2, 0), min(last + 1, len(self.lines))
        lines = self.lines.slice(low, high - low).take(pa.array(np.arange(high - low)))
        lengths = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
        filled = np.diff(self.bounds) > 0
        starts, ends = self.bounds[:-1][filled], self.bounds[1:][filled] - 1
        within = lambda at: at[(at >= low) & (at < high)] - low
        out = self._with_neighbours(self._own(lines, lengths), within(starts), within(ends))
        return out[first - low : last - low]

    def _own(self, lines: pa.Array, lengths: np.ndarray) -> np.ndarray:
        raw = np.frombuffer(b"".join(lines.cast(pa.large_binary()).to_pylist()), dtype=np.uint8)
        edges = np.concatenate(([0], np.cumsum(lengths)))
        kinds = _CLASSES[raw]

        def count(bit: int) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum((kinds & bit) > 0)))[edges]).astype(float)

        letters, upper, digits, symbols, stops, calls = (
            count(bit) for bit in (_LETTER, _UPPER, _DIGIT, _SYMBOL, _STOP, _CALL)
        )
        solid = np.maximum(lengths - count(_BLANK), 1.0)
        words = Words(lines)
        number = words.counts.astype(float)
        some = np.maximum(number, 1.0)
        owner = np.repeat(np.arange(len(lines)), words.counts)
        per_line = lambda values: np.bincount(owner, weights=values, minlength=len(lines))
        again = np.zeros(len(words.ids))
        if len(words.ids):
            again[1:] = (words.ids[1:] == words.ids[:-1]) & (owner[1:] == owner[:-1])
        pairs = np.unique(owner.astype(np.int64) << 32 | words.ids)
        distinct = np.bincount(pairs >> 32, minlength=len(lines)).astype(float)
        odd_word = np.array([_odd(w) for w in words.vocabulary.cast(pa.large_binary()).to_pylist()], dtype=np.uint8)
        odd = odd_word[words.ids] if len(words.ids) else np.empty(0, dtype=np.uint8)
        first = np.zeros(len(lines), dtype=np.uint8)
        last = np.zeros(len(lines), dtype=np.uint8)
        full = lengths > 0
        first[full], last[full] = kinds[edges[:-1][full]], kinds[edges[1:][full] - 1]
        coded = lines.dictionary_encode().indices.to_numpy()
        same = np.zeros(len(lines))
        same[1:] = coded[1:] == coded[:-1]
        return np.column_stack(
            [
                np.log1p(number) / 5,
                letters / solid,
                upper / np.maximum(letters, 1.0),
                digits / solid,
                symbols / solid,
                calls / solid,
                stops / some,
                solid / some / 10,
                per_line(again) / some,
                np.log1p(distinct) / np.log1p(some),
                per_line(odd & 1) / some,
                per_line(odd >> 1 & 1) / some,
                (last & (_STOP | _CALL)) > 0,
                (first & _UPPER) > 0,
                same,
                number == 0,
            ]
        ).astype(np.float32)

    def _with_neighbours(self, own: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros((len(own), FEATURES), dtype=np.float32)
        out[:, :OWN] = own
        out[1:, OWN : 2 * OWN] = own[:-1]
        out[:-1, 2 * OWN : 3 * OWN] = own[1:]
        out[starts, OWN : 2 * OWN] = 0
        out[ends, 2 * OWN : 3 * OWN] = 0
        out[starts, 3 * OWN] = 1
        out[ends, 3 * OWN + 1] = 1
        out[:, 3 * OWN + 2] = 1
        return out


def _odd(word: bytes) -> int:
    """Bit 0: one symbol alone. Bit 1: a symbol at the end."""
    end = _CLASSES[word[-1]] & (_SYMBOL | _CALL)
    return (len(word) == 1 and end > 0) | (end > 0) << 1


@dataclass(frozen=True)
class Field:
    """Log-odds of a line being good, w.x; moves[i, j] is the weight of label j after label i."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.spread) @ self.weights


def chains(bounds: np.ndarray) -> list[np.ndarray]:
    """For each step the first places of the documents that still have a line there.

    Documents stand in descending number of lines, so those of a step are a prefix.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    starts, ordered = bounds[:-1][order], lengths[order]
    ends = np.searchsorted(-ordered, -np.arange(1, (ordered[0] if len(ordered) else 0) + 1), side="right")
    return [starts[:n] + t for t, n in enumerate(ends)]


def marginals(odds: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) of each line, the log-odds of the messages from the left and from the right."""
    steps = chains(bounds)
    left, right = np.zeros(len(odds)), np.zeros(len(odds))
    for t, at in enumerate(steps):
        if t:
            a = left[at - 1] + odds[at - 1]
            left[at] = np.logaddexp(a + moves[1, 1], moves[0, 1]) - np.logaddexp(a + moves[1, 0], moves[0, 0])
    for t in range(len(steps) - 1, 0, -1):
        at = steps[t]
        b = right[at] + odds[at]
        right[at - 1] = np.logaddexp(b + moves[1, 1], moves[1, 0]) - np.logaddexp(b + moves[0, 1], moves[0, 0])
    return _sigmoid(odds + left + right), left, right


def walked(odds: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(good) of each line, as `marginals` has it, with long texts in pieces that are walked side by side.

    A message forgets where it began: with d = |m11 + m00 - m10 - m01|, two messages come nearer by
    tanh(d / 4) with each line, and none is further than d from another. So many lines are walked
    before and after a piece that what is left of its false start is below EXACT.
    """
    lengths = np.diff(bounds)
    if lengths.max(initial=0) <= PIECE_LINES:
        return marginals(odds, bounds, moves)[0]
    apart = abs(moves[1, 1] + moves[0, 0] - moves[1, 0] - moves[0, 1])
    nearer = np.tanh(apart / 4)
    lead = 1 if nearer < EXACT else min(int(np.ceil(np.log(EXACT / max(apart, EXACT)) / np.log(nearer))) + 1, int(lengths.max()))
    piece = max(PIECE_LINES, lead)
    parts = -(-lengths // piece)
    owner = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = bounds[:-1][owner] + number * piece
    last = np.minimum(first + piece, bounds[1:][owner])
    out = np.empty(len(odds))
    for some in np.array_split(np.arange(len(owner)), max(1, -(-int((last - first).sum()) // BLOCK_LINES))):
        low = np.maximum(first[some] - lead, bounds[:-1][owner[some]])
        high = np.minimum(last[some] + lead, bounds[1:][owner[some]])
        edges = np.concatenate(([0], np.cumsum(high - low)))
        places = np.arange(edges[-1]) + np.repeat(low - edges[:-1], high - low)
        chance = marginals(odds[places], edges, moves)[0]
        core = (places >= np.repeat(first[some], high - low)) & (places < np.repeat(last[some], high - low))
        out[places[core]] = chance[core]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def pair_marginals(odds, bounds, moves, left, right) -> np.ndarray:
    """Expected number of each pair of labels in a row (2 x 2)."""
    inner = np.ones(len(odds), dtype=bool)
    inner[bounds[:-1][np.diff(bounds) > 0]] = False
    at = np.flatnonzero(inner)
    a, b = left[at - 1] + odds[at - 1], right[at] + odds[at]
    scores = np.stack([np.stack([i * a + j * b + moves[i, j] for j in (0, 1)]) for i in (0, 1)])
    scores -= scores.max(axis=(0, 1))
    chance = np.exp(scores)
    return (chance / chance.sum(axis=(0, 1))).sum(axis=2)


def fit_field(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Field:
    """Maximises the penalised likelihood of the labels of all lines (Adam, whole batch)."""
    mean, spread = features.mean(axis=0), features.std(axis=0)
    fixed = spread < 1e-6
    mean, spread = np.where(fixed, 0.0, mean), np.where(fixed, 1.0, spread)
    x = (features - mean) / spread
    good = np.repeat(labels, np.diff(bounds)).astype(float)
    inner = np.ones(len(x), dtype=bool)
    inner[bounds[:-1]] = False
    pairs = np.zeros((2, 2))
    for k in (0, 1):
        pairs[k, k] = (inner & (good == k)).sum()
    values = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, ROUNDS + 1):
        odds, moves = x @ values[:FEATURES], values[FEATURES:].reshape(2, 2)
        chance, left, right = marginals(odds, bounds, moves)
        slope = np.concatenate((x.T @ (good - chance), (pairs - pair_marginals(odds, bounds, moves, left, right)).ravel()))
        slope = slope / len(x) - PENALTY * values
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        values += STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(mean, spread, values[:FEATURES], values[FEATURES:].reshape(2, 2))


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> Field | None:
    """Fits on labelled documents that aren't held out; None where there are none.

    documents: doc_id, text. labels: doc_id, quality (0 or 1; others and nulls are no label; of
    several labels of an id the smallest counts). At most SAMPLE_ROWS ids of each label are read, of
    rows that repeat an id one, and none with SAMPLE_LINES line breaks or more: that bounds the
    broadcast of the join, and what comes to the driver by 2 * SAMPLE_ROWS * SAMPLE_LINES lines.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("doc_id", 5, 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("label"))
    )
    # The first rows of each label by hash: each task sends SAMPLE_ROWS rows at most.
    first = lambda label: known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    chosen = first(0).unionByName(first(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines = Lines(strings(batch.column("text")))
            features = lines.features
            rows = [features[a:b].tobytes() for a, b in zip(lines.bounds[:-1], lines.bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
                names=["doc_id", "label", "features"],
            )

    text = F.coalesce("text", F.lit(""))
    few_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) < SAMPLE_LINES
    rows = (
        documents.where(few_lines)
        .select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .mapInArrow(run, "doc_id long, label int, features binary")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("label", "ascending")])
    )
    parts = [np.frombuffer(x, dtype=np.float32).reshape(-1, FEATURES) for x in rows.column("features").to_pylist()]
    if not parts:
        return None
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return fit_field(np.vstack(parts).astype(float), bounds, rows.column("label").to_numpy())


def scores(texts: pa.Array, field: Field | None) -> np.ndarray:
    """Quality of each text, 0 to 1."""
    if field is None:
        return np.full(len(texts), 0.5)
    lines = Lines(texts)
    chance = walked(lines.emissions(field), lines.bounds, field.moves)
    owner = np.repeat(np.arange(len(texts)), np.diff(lines.bounds))
    total = np.bincount(owner, weights=lines.weights, minlength=len(texts))
    return np.clip(np.bincount(owner, weights=chance * lines.weights, minlength=len(texts)) / total, 0.0, 1.0)


def with_scores(documents: DataFrame, field: Field | None, column: str = "quality_score") -> DataFrame:
    """All columns and rows of `documents` and the quality of `text` in one more column.

    A null text is scored as an empty one. A column of that name is replaced.
    """
    documents = documents.drop(*(name for name in documents.columns if name.lower() == column.lower()))
    shared = documents.sparkSession.sparkContext.broadcast(field)  # FEATURES numbers
    names = [*documents.columns, column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            own = pa.array(scores(strings(batch.column("text")), shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=names)

    schema = T.StructType([*documents.schema.fields, T.StructField(column, T.DoubleType())])
    return documents.mapInArrow(run, schema)


def without_rejects(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`documents`, all columns, without those that score below THRESHOLD."""
    own = fresh(documents.columns, "quality_score")
    scored = with_scores(documents, fit(spark, documents, labels), own)
    return scored.where(F.col(own) >= THRESHOLD).drop(own)


def score(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document; without labels every score is 0.5."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out("doc_id", 5, 0).alias("held_out"))
    return with_scores(rows, fit(spark, documents, labels), "score").select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
