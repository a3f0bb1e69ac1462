"""Whole-array text helpers used inside Arrow tasks: slicing by size, words, rolling hashes.

All functions work on one bounded slice of rows, so that the memory of a task depends on
the slice limit and on its longest single text, never on the number of rows it reads.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text handled at once in a task; one longer text makes a slice of its own.
SLICE_BYTES = 8 << 20

_U64 = np.uint64
#: An odd multiplier of rolling hashes and its inverse modulo 2**64.
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, regrouped into slices of at most `limit` bytes of `column`.

    A slice holds one row at least. Small batches are joined, large ones cut.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = int(np.searchsorted(ends, before + limit - size, side="right"))
            if last <= first and size == 0:
                last = first + 1
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(ends[last - 1]) - before
                first = last
            if first < batch.num_rows or size >= limit:
                yield _joined(held)
                held, size = [], 0
                # What the slice took goes back to the machine: a worker lives through many tasks.
                pa.default_memory_pool().release_unused()
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def strings(column: pa.Array) -> pa.Array:
    """A string column with nulls as empty texts and 64-bit offsets, in buffers of its own.

    A part of a batch shares the whole's buffers, which some Arrow functions on strings misread
    (`ascii_lower` keeps offsets that don't fit what it returns), so the texts are copied.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    return texts.take(pa.array(np.arange(len(texts))))


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z in lower case; no other character changes."""
    return pc.ascii_lower(texts)


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a slice of texts.

    bounds[i]:bounds[i + 1] are the words of text i; ids index into `vocabulary`.
    """

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        flat = split.flatten()
        there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        if not there.all():  # blanks at the ends of a text leave empty words
            before = np.concatenate(([0], np.cumsum(there)))
            bounds = before[bounds]
            flat = flat.filter(pa.array(there))
        coded = flat.dictionary_encode()
        self.bounds: np.ndarray = bounds
        self.ids: np.ndarray = coded.indices.to_numpy()
        self.vocabulary: pa.Array = coded.dictionary
        self.flat = flat

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def vocabulary_hashes(self) -> np.ndarray:
        words = self.vocabulary.cast(pa.large_binary()).to_pylist()
        return np.fromiter(
            (xxhash.xxh3_64_intdigest(word) for word in words), dtype=_U64, count=len(words)
        )

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, in order."""
        return self.vocabulary_hashes()[self.ids]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = values.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of `width` consecutive hashes; equal runs get equal values."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=_U64)
    sums = _prefix_sums(hashes)
    return mixed((sums[width:] - sums[:-width]) * _powers(_R_INVERSE, n))


def _prefix_sums(hashes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, dtype=_U64)
    np.cumsum(hashes * _powers(_R, len(hashes)), out=sums[1:])
    return sums


def spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run hashes[starts[i]:ends[i]], of any length."""
    sums = _prefix_sums(hashes)
    value = (sums[ends] - sums[starts]) * _powers(_R_INVERSE, len(hashes) + 1)[starts]
    return mixed(value ^ mixed((ends - starts).astype(_U64)))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, 1 << 16), base, dtype=_U64)
        known[0] = 1
        known = np.cumprod(known, dtype=_U64)
        _POWERS[base] = known
    return known[:count]


class Bits:
    """A bit for each place, and how many are set before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def fresh(columns: list[str], name: str) -> str:
    """`name`, with underscores before it until no column is called so in any case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """Of every code point; made once in a worker."""
    kinds = (unicodedata.category(chr(point)) for point in range(0x110000))
    return np.fromiter((kind[0] == "L" for kind in kinds), dtype=bool, count=0x110000)


class Letters:
    """Characters of texts as small codes: 0 for anything but letters, else one per letter.

    Letters are folded to lower case. Codes are given to the letters of an alphabet chosen
    when a model is fitted; other letters get the code len(alphabet) + 1.
    """

    def __init__(self, alphabet: str):
        self.alphabet = alphabet
        self.table = np.where(_is_letter(), np.uint8(len(alphabet) + 1), np.uint8(0))
        for code, letter in enumerate(alphabet, 1):
            self.table[ord(letter)] = code
            upper = letter.upper()
            if len(upper) == 1:
                self.table[ord(upper)] = code

    @property
    def size(self) -> int:
        return len(self.alphabet) + 2

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return self.table[points]
