"""Packing of token sequences by vector bin packing.

Items have several sizes at once: tokens, segments, loss-bearing tokens. A bin holds items
while no sum passes its limit. An item goes to the open bin with the largest dot product of
the item's sizes and the bin's room, both as shares of the limits: items lean towards bins
that have room where they need it. Large items come first.

Documents are cut freely. Full pieces fill a sequence alone; what is left of each document is
an item. Bins that stay part-filled are topped up by cutting the pieces of the emptiest ones. A bin
that has all its segments before it is full, and the last bin of a task, are cut to lengths that are
powers of two, which need no padding; so what a task holds back is less than one bin.
Everything happens inside the task that reads the documents: nothing is shuffled or collected.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesloom.llm.textops import slices, strings

SEQUENCE = 1024
#: Segments of a sequence at most.
SEGMENTS = 64
#: The id between documents, put at the end of each.
SEPARATOR = 0
#: Items that are packed together, and bins among which an item is placed.
BATCH_ITEMS = 4_096
OPEN_BINS = 256
#: A task's sequences are numbered from its partition number times 2**TASK_BITS.
TASK_BITS = 40

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "ids array<int>"
)
PLACED = "item_id long, tokens long, segments long, loss_tokens long, sequence_id long, position int"


class Ids:
    """Token ids of texts by the byte-level vocabulary of the files at `json` and `ranks`.

    Strings of special tokens are ordinary text. Both files hold one vocabulary; the faster
    library takes texts of which it is sure to cut as the other does: Latin letters and common
    signs, without very long words. All other texts go to `tokenizers`.
    """

    SURE = re.compile(r"[\t\n\r\x20-\x7E\xA1-ɏ‐-…€]*\Z")
    LONG = re.compile(r"[^\s]{2000}|\s{2000}")

    def __init__(self, json: str | None = None, ranks: str | None = None):
        self.tokenizer = Tokenizer.from_file(json or public_tokenizers.path("byte_bpe_50k.json"))
        self.tokenizer.encode_special_tokens = True
        self.fast = _ranked(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))

    def of(self, text: str) -> np.ndarray:
        if self.fast is not None and self.SURE.match(text) and not self.LONG.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def _ranked(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def place(sizes: np.ndarray, limits: Sequence[float]) -> list[list[int]]:
    """Bins of rows of `sizes` (items by dimensions), none of whose sums passes a limit.

    Raises where an item alone passes a limit. Ties go to the bin opened first.
    """
    limits = np.asarray(limits, dtype=float)
    shares = sizes / limits
    if len(shares) and shares.max() > 1:
        raise ValueError("an item is larger than a sequence may be")
    room = np.empty((0, len(limits)))
    open_bins: list[int] = []
    bins: list[list[int]] = []
    least = shares.min(axis=0) if len(shares) else None
    for item in np.lexsort((np.arange(len(shares)), -shares.max(axis=1))) if len(shares) else ():
        need = shares[item]
        fits = (room >= need - 1e-12).all(axis=1)
        if fits.any():
            best = int(np.argmax(np.where(fits, room @ need, -1.0)))
        else:
            if len(open_bins) >= OPEN_BINS:  # the fullest bin closes
                full = int(np.argmin(room.min(axis=1)))
                room = np.delete(room, full, axis=0)
                del open_bins[full]
            best = len(open_bins)
            open_bins.append(len(bins))
            bins.append([])
            room = np.vstack((room, np.ones(len(limits))))
        bins[open_bins[best]].append(int(item))
        room[best] -= need
        if (room[best] < least - 1e-12).any():  # nothing fits any more
            room = np.delete(room, best, axis=0)
            del open_bins[best]
    return bins


class DocumentPacker:
    """Pieces (number of a document, first id, length) of documents, by sequence."""

    def __init__(self, sequence: int = SEQUENCE, segments: int = SEGMENTS):
        self.sequence, self.segments = sequence, segments
        self.items: list[tuple[int, int, int]] = []

    def add(self, document: int, length: int) -> Iterator[list[tuple[int, int, int]]]:
        """Takes the ids of a document and gives the sequences that are full."""
        for first in range(0, length - self.sequence + 1, self.sequence):
            yield [(document, first, self.sequence)]
        if rest := length % self.sequence:
            self.items.append((document, length - rest, rest))
        if len(self.items) >= BATCH_ITEMS:
            yield from self._pack(last=False)

    def finish(self) -> Iterator[list[tuple[int, int, int]]]:
        yield from self._pack(last=True)

    def _pack(self, last: bool) -> Iterator[list[tuple[int, int, int]]]:
        lengths = np.array([n for _, _, n in self.items], dtype=float)
        # Every token of running text bears loss; each piece is a segment.
        sizes = np.column_stack((lengths, np.ones(len(lengths)), lengths)) if len(lengths) else np.empty((0, 3))
        bins = [[self.items[k] for k in own] for own in place(sizes, (self.sequence, self.segments, self.sequence))]
        self.items = []
        bins.sort(key=lambda own: (-sum(n for _, _, n in own), own))
        total = [sum(n for _, _, n in own) for own in bins]
        tail = len(bins)
        for k in range(len(bins)):
            # The emptiest bins are cut up to fill the others to the brim.
            while total[k] < self.sequence and tail - 1 > k and len(bins[k]) < self.segments:
                source = bins[tail - 1]
                if not source:
                    tail -= 1
                    continue
                document, first, length = source.pop()
                taken = min(length, self.sequence - total[k])
                bins[k].append((document, first, taken))
                total[k] += taken
                total[tail - 1] -= taken
                if taken < length:
                    source.append((document, first + taken, length - taken))
        for k, own in enumerate(bins):
            if not own:
                continue
            if total[k] == self.sequence:
                yield own
            elif last or len(own) >= self.segments:  # no later item can fill it
                yield from powers_of_two(own)
            else:
                self.items += own


def powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces cut and dealt to sequences whose lengths are different powers of two."""
    left = sum(n for _, _, n in pieces)
    queue = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        own = []
        while size:
            document, first, length = queue.pop()
            taken = min(length, size)
            own.append((document, first, taken))
            size -= taken
            if taken < length:
                queue.append((document, first + taken, length - taken))
        yield own


def pack_documents(
    documents: DataFrame,
    sequence: int = SEQUENCE,
    segments: int = SEGMENTS,
    json: str | None = None,
    ranks: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece: PIECES, with the ids themselves where `with_ids` is set.

    documents: doc_id, text; other columns are dropped. A null text is empty, so it is its
    SEPARATOR alone. Repeated rows are packed once each. `offset` counts from 0 in a sequence,
    without gaps. Sequences have `sequence` ids or a power of two of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(json, ranks)
        packer = DocumentPacker(sequence, segments)
        base = TaskContext.get().partitionId() << TASK_BITS
        made = 0
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        left: dict[int, int] = {}

        def rows(found: Iterator[list[tuple[int, int, int]]]) -> list[tuple]:
            nonlocal made
            out = []
            for own in found:
                offset = 0
                for document, first, length in own:
                    doc_id, ids = held[document]
                    piece = ids[first : first + length]
                    crc = zlib.crc32(piece.astype("<u4").tobytes())
                    out.append((doc_id, first, length, crc, len(ids), base + made, offset, piece if with_ids else None))
                    offset += length
                    left[document] -= length
                    if not left[document]:
                        del held[document], left[document]
                made += 1
            return out

        number = 0
        for batch in slices(batches, "text"):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
                ids = np.append(encode.of(text.as_py()), np.uint32(SEPARATOR))
                held[number], left[number] = (doc_id, ids), len(ids)
                out += rows(packer.add(number, len(ids)))
                number += 1
            yield _pieces(out)
        yield _pieces(rows(packer.finish()))

    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
    return found if with_ids else found.drop("ids")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def pack_items(items: DataFrame, tokens: int, segments: int, loss_tokens: int) -> DataFrame:
    """Whole items, for instruction data: PLACED, one row for each item with its sequence.

    items: item_id, tokens, segments, loss_tokens; nulls of sizes count as 0. An item that alone
    passes a limit is an error. Items are placed BATCH_ITEMS at a time inside their task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << TASK_BITS, 0
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_ITEMS):
                batch = whole.slice(first, BATCH_ITEMS)
                sizes = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]).astype(float)
                sequence_id = np.empty(batch.num_rows, dtype=np.int64)
                position = np.empty(batch.num_rows, dtype=np.int32)
                for own in place(sizes, (tokens, segments, loss_tokens)):
                    sequence_id[own], position[own] = base + made, np.arange(len(own))
                    made += 1
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(sequence_id), pa.array(position)],
                    names=[field.split()[0] for field in PLACED.split(", ")],
                )

    size = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(0)).alias(name)
    return items.select(
        F.col("item_id").cast("long"), size("tokens"), size("segments"), size("loss_tokens")
    ).mapInArrow(run, PLACED)
