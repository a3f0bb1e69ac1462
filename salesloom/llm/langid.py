"""Language identification by cross-parsing.

For each language a suffix automaton is built over labelled text of it. A text is parsed
greedily against each automaton: a phrase is the longest match found anywhere in the
language's text, and the next phrase begins at the letter that broke it. The fewer phrases,
the closer the text. With m letters of reference and n letters of text, phrases * log2(m) / n
estimates the cross entropy in bits a letter; the language of the smallest estimate wins.

Texts are reduced to lower-case letters, with one blank for any run of other characters, so
digits, symbols and markup take no side. Parsing is cut every SEGMENT letters, which adds
one phrase at most to each piece, in every language alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.lockstep import SEGMENT, Segments
from salesloom.llm.textops import Letters, slices, strings

#: Rows of a language that are read for its reference at most, and characters taken of them.
SAMPLE_ROWS = 60
SAMPLE_CHARS = 4_000
#: Letters of reference text of a language.
REFERENCE = 24_000
#: Letters that get a code of their own; the rarer share one.
ALPHABET = 120
PAD = 255

_NO_LETTERS = re.compile(r"[\W\d_]+")
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


class SuffixAutomaton:
    """All substrings of a sequence of codes, as a dense table of transitions (-1: none)."""

    def __init__(self, codes: list[int], size: int):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for code in codes:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and code not in self.next[at]:
                self.next[at][code] = new
                at = link[at]
            if at >= 0:
                target = self.next[at][code]
                if length[target] == length[at] + 1:
                    link[new] = target
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    link[target] = link[new] = copy
                    while at >= 0 and self.next[at].get(code) == target:
                        self.next[at][code] = copy
                        at = link[at]
            last = new
        self.size = size

    def table(self) -> np.ndarray:
        out = np.full((len(self.next), self.size), -1, dtype=np.int32)
        for state, moves in enumerate(self.next):
            out[state, list(moves)] = list(moves.values())
        return out


@dataclass(frozen=True)
class Model:
    alphabet: str
    languages: list[str]
    #: For each language the moves, 2 * (state * width) + 1 where a move begins a new phrase.
    tables: list[np.ndarray]
    #: log2 of the letters of reference.
    bits: list[float]


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves `remainder`; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


def fit(labelled: DataFrame) -> Model:
    """A model of the languages in `labelled` (text, lang, doc_id).

    The fit reads SAMPLE_ROWS rows of each language, chosen by a hash of the id, and up to
    SAMPLE_CHARS characters of each: it grows with the number of languages, not of rows.
    Rows with a null text or language are no sample.
    """
    rank = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "text")
    sample = (
        labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
        .select("lang", "doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .withColumn("n", F.row_number().over(rank))
        .where(F.col("n") <= SAMPLE_ROWS)
        .orderBy("lang", "n")
        .collect()
    )
    texts: dict[str, dict[str, None]] = {}
    for row in sample:
        texts.setdefault(row["lang"], {})[_folded(row["text"])] = None
    pieces = {lang: "".join(own)[: REFERENCE] for lang, own in texts.items()}
    pieces = {lang: text for lang, text in sorted(pieces.items()) if text.strip()}
    counts = Counter("".join(pieces.values()).replace(" ", ""))
    alphabet = "".join(sorted(c for c, _ in counts.most_common(ALPHABET)))
    letters = Letters(alphabet)
    tables, bits = [], []
    for text in pieces.values():
        codes = letters.codes(text)
        tables.append(moves(SuffixAutomaton(codes.tolist(), letters.size).table()))
        bits.append(float(np.log2(len(codes) + 1)))
    return Model(alphabet, list(pieces), tables, bits)


def _folded(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower()).strip() + " "


def moves(table: np.ndarray) -> np.ndarray:
    """The table with failed moves replaced by the first move of a new phrase, and flagged."""
    width = table.shape[1] + 1  # the last column is the pad
    root = np.maximum(table[0], 0)
    failed = table < 0
    out = np.where(failed, root[None, :], table).astype(np.int64) * width * 2 + failed
    stay = np.arange(len(table), dtype=np.int64)[:, None] * width * 2
    return np.hstack((out, stay)).astype(np.int32).ravel()


def phrases(segments: Segments, table: np.ndarray) -> np.ndarray:
    """Phrases of each run of codes."""
    matrix = segments.matrix
    at = np.zeros(matrix.shape[1], dtype=np.int32)
    count = np.zeros(matrix.shape[1], dtype=np.int32)
    for row in matrix:
        move = table.take((at >> 1) + row)
        count += move & 1
        at = move & ~np.int32(1)
    return segments.per_run(count + (at > 0))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of `documents` (doc_id, text, held_out).

    score is the second best entropy over the sum of it and the best one, so 0.5 is a tie and
    1 certainty; with one language it is 1. A text that is null or without letters, and any
    text where nothing was learned, is `und` with score 0. Ties go to the first language in
    alphabetical order.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # SAMPLE_ROWS bound its size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        letters = Letters(known.alphabet)
        for batch in slices(batches, "text"):
            best, score = classify(strings(batch.column("text")), known, letters)
            names = pa.array([*known.languages, "und"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), names.take(pa.array(best)), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return documents.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(run, SCHEMA)


def classify(texts: pa.Array, model: Model, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Positions in model.languages (their number: `und`) and scores."""
    codes, bounds = reduced(texts, letters)
    lengths = np.diff(bounds)
    number = len(model.languages)
    some = (np.add.reduceat(np.append(codes > 0, False), bounds[:-1]) > 0) & (lengths > 0)
    if not number:
        return np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
    width = letters.size
    segments = Segments(codes, bounds, pad=width, length=SEGMENT)
    bits = np.vstack(
        [phrases(segments, table) * b for table, b in zip(model.tables, model.bits, strict=True)]
    ) / np.maximum(lengths, 1)
    order = np.sort(bits, axis=0)
    second = order[1] if number > 1 else np.full(len(texts), np.inf)
    with np.errstate(invalid="ignore"):
        score = np.where(np.isinf(second), 1.0, second / np.maximum(second + order[0], 1e-12))
    return np.where(some, bits.argmin(axis=0), number), np.where(some, score, 0.0)


def reduced(texts: pa.Array, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, runs of anything but letters as one 0, and the bounds of texts."""
    joined = "\n".join(texts.to_pylist())
    codes = letters.codes(joined)
    ends = np.cumsum([len(text) + 1 for text in texts.to_pylist()])
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    before = np.concatenate(([0], np.cumsum(keep)))
    bounds = before[np.minimum(np.concatenate(([0], ends)), len(codes))]
    return codes[keep], bounds


def identify(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Fits on the labelled rows that aren't held out and predicts all rows."""
    rows = documents.select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id", 4, 2))
    return predict(rows, fit(rows.where(~F.col("held_out"))))
