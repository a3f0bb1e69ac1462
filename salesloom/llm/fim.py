"""Fill-in-the-middle: a text cut in three, its middle moved to the end.

Cuts lie between tokens `[A-Za-z]+|[^A-Za-z]`, so no word is cut. Where the c-th token begins
is not found by splitting the text: the bytes of a slice of texts become character classes,
and a wavelet matrix over the classes answers how many of a class stand before any place. Two
such ranks combine into the number of tokens before a place (a byte inside a letter, or inside a
run of letters, begins none), and bisection on that count finds the cuts of all texts at once.
Another rank turns places of bytes into places of characters.

A row depends on its own text and id only: nothing is shuffled or collected. A slice holds
SLICE_BYTES of text or one longer text, of which about seven times the bytes are in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.textops import Bits, slices, strings

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Shares in percent: of texts that are cut, and of those whose suffix comes first.
CUT_SHARE, SPM_SHARE = 90, 20

#: Classes of bytes: inside a character, a letter inside a run of letters, and what begins a token.
INNER, IN_RUN, RUN, DIGIT, BLANK, SIGN, OTHER = range(7)
LEVELS = 3

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class WaveletMatrix:
    """Counts of symbols below 2**levels before any place of a sequence.

    Each level holds one bit of every symbol, highest first; symbols with a 0 move before those
    with a 1 for the next level, and keep their order.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        self.size = len(symbols)
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1
            zeros = symbols[bits == 0]
            self.levels.append((level, Bits(bits), len(zeros)))
            symbols = np.concatenate((zeros, symbols[bits == 1]))

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How many of a symbol stand before each place."""
        first, last = np.zeros(1, dtype=np.int64), places
        for level, bits, zeros in self.levels:
            if symbol >> level & 1:
                first, last = zeros + bits.rank(first), zeros + bits.rank(last)
            else:
                first, last = first - bits.rank(first), last - bits.rank(last)
        return last - first


def _byte_classes() -> np.ndarray:
    classes = np.full(256, SIGN, dtype=np.uint8)
    classes[0x80:0xC0] = INNER
    classes[0xC0:] = OTHER
    for first, last, own in (("A", "Z", RUN), ("a", "z", RUN), ("0", "9", DIGIT), ("\t", "\r", BLANK), (" ", " ", BLANK)):
        classes[ord(first) : ord(last) + 1] = own
    return classes


BYTE_CLASSES = _byte_classes()


class Boundaries:
    """Tokens and characters of texts that lie one after the other in an array of UTF-8 bytes.

    Text i has the bytes bounds[i]:bounds[i + 1].
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        classes = BYTE_CLASSES[data]
        letter = classes == RUN
        goes_on = letter[1:] & letter[:-1]
        starts = bounds[1:-1]
        goes_on[starts[(starts > 0) & (starts < len(data))] - 1] = False  # a text begins a run of its own
        classes[1:][goes_on] = IN_RUN
        self.bounds = bounds
        self.matrix = WaveletMatrix(classes, LEVELS)

    def characters_before(self, places: np.ndarray) -> np.ndarray:
        return places - self.matrix.rank(INNER, places)

    def tokens_before(self, places: np.ndarray) -> np.ndarray:
        return self.characters_before(places) - self.matrix.rank(IN_RUN, places)

    def counts(self) -> np.ndarray:
        """Tokens of each text."""
        return np.diff(self.tokens_before(self.bounds))

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """The byte after the first tokens[i] tokens of each text i."""
        low, high = self.bounds[:-1].copy(), self.bounds[1:].copy()
        wanted = self.tokens_before(low) + tokens
        while (low < high).any():
            middle = (low + high + 1) // 2
            not_beyond = self.tokens_before(middle) <= wanted
            low, high = np.where(not_beyond, middle, low), np.where(not_beyond, high, middle - 1)
        return low


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 for a document; a null id is an empty text here."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(found[k : k + 4], "big") for k in (0, 4, 8, 12)]


def transform(
    documents: DataFrame,
    seed: int = 1,
    cut_share: int = CUT_SHARE,
    spm_share: int = SPM_SHARE,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """SCHEMA: one row per document, with the text for training in `output`.

    documents: doc_id, text; other columns are dropped. `n` counts the tokens of the text. Form
    `psm` is prefix, suffix, middle, each after its sentinel; `spm` puts the suffix first; `plain`
    is the text as it was. Texts that are empty, null, or hold a sentinel stay plain. Rows that
    repeat an id have the same draws, each over its own text; a null id draws like any other.
    Empty tables give no rows.
    """
    marks = [s.encode() for s in sentinels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield _transformed(batch, seed, cut_share, spm_share, sentinels, marks)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def _transformed(batch, seed, cut_share, spm_share, sentinels, marks) -> pa.RecordBatch:
    texts = strings(batch.column("text"))
    ids = batch.column("doc_id").to_pylist()
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    found = Boundaries(data, bounds)
    n = found.counts()
    h1, h2, h3, h4 = np.array([draws(seed, i) for i in ids], dtype=np.int64).reshape(-1, 4).T
    one, other = h1 % (n + 1), h2 % (n + 1)
    first, second = found.places(np.minimum(one, other)), found.places(np.maximum(one, other))
    plain = (n == 0) | (h3 % 100 >= cut_share)
    for mark in sentinels:
        plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    spm = h4 % 100 < spm_share
    characters = found.characters_before(np.concatenate((bounds[:-1], first, second))).reshape(3, -1)
    raw = data.tobytes()
    p, s, m = marks
    output = []
    for k in range(len(ids)):
        begin, cut, back, end = int(bounds[k]), int(first[k]), int(second[k]), int(bounds[k + 1])
        if plain[k]:
            output.append(raw[begin:end])
        elif spm[k]:
            output.append(b"".join((s, raw[back:end], p, raw[begin:cut], m, raw[cut:back])))
        else:
            output.append(b"".join((p, raw[begin:cut], s, raw[back:end], m, raw[cut:back])))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(n),
            pa.array(np.where(plain, PLAIN, np.where(spm, SPM, PSM)), pa.string()),
            pa.array(characters[1] - characters[0], pa.int64(), mask=plain),
            pa.array(characters[2] - characters[1], pa.int64(), mask=plain),
            pa.array(output, pa.binary()).cast(pa.string()),
        ],
        names=[field.split()[0] for field in SCHEMA.split(", ")],
    )


def restored(transformed: DataFrame, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """The rows with `restored`: the text as it was, rebuilt from `form` and `output` alone."""
    p, s, m = sentinels

    def parts(first: str, second: str):
        body = F.expr(f"substring(output, {len(first) + 1})")
        return F.split(body, f"{re.escape(second)}|{re.escape(m)}", -1)

    psm, spm = parts(p, s), parts(s, p)
    text = (
        F.when(F.col("form") == PSM, F.concat(psm[0], psm[2], psm[1]))
        .when(F.col("form") == SPM, F.concat(spm[1], spm[2], spm[0]))
        .otherwise(F.col("output"))
    )
    return transformed.withColumn("restored", text)
