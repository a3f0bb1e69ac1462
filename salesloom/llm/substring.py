"""Substring dedup: documents factored against every indexed block of the corpus.

The reference of the parse is the corpus itself, cut into blocks by its content. Among the
hashes of KGRAM words inside a window of `width` words the smallest is the window's anchor;
consecutive windows with one anchor form a block. Equal windows have equal anchors at equal
places, so wherever a text repeats, the blocks inside the repeat are equal too, whatever
stands around it. Blocks are about an eighth as many as words.

The index maps anchors to blocks. Blocks whose anchor occurs once in the corpus hold nothing
that repeats and leave at once. A block that is equal to another is a factor as a whole. Only
at the boundaries of factors, where blocks share an anchor but not their content, are single
windows compared, one copy of each different block. Neighbouring blocks and windows with the
same place in the same reference document are joined into one factor: the greedy parse.

Nothing is compared pairwise: all steps are counts by hash, so a passage in a third of the
documents costs as much as many different ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.textops import Words, as_signed, fresh, rolling, slices, sliding_min, spans, strings
from salesloom.plans.session import work_dir

#: Words of a window: factors of fewer words are no duplicates.
WIDTH = 35
#: Words of an anchor.
KGRAM = 8

BLOCKS = "doc_id long, text_key long, start int, n int, occurrences int, anchor long, content long"
WINDOWS = "anchor long, content long, position int, window long, single boolean"
RESULT = (
    "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string, kept string, "
    "factors array<struct<start:int,length:int,ref_doc_id:long,ref_start:int>>"
)


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, text: rows that repeat id and text share a key, and so their factors."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def anchored(hashes: np.ndarray, bounds: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Blocks of all runs hashes[bounds[i]:bounds[i + 1]].

    first and last: first and last window start of a block, in `hashes`; owner: its run; anchor:
    its value; occurrences: how often the anchor stands in the block.
    """
    grams = rolling(hashes, KGRAM)
    inner = width - KGRAM + 1
    if len(grams) < inner:
        none = np.empty(0, dtype=np.int64)
        return {k: none for k in ("first", "last", "owner", "anchor", "occurrences")}
    least = sliding_min(grams, inner)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    valid = owner[: len(least)] == owner[width - 1 :]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (owner[1 : len(least)] != owner[: len(least) - 1])
    first = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | new[1:]
    last = np.flatnonzero(stop)
    anchor = least[first]
    # A place is an occurrence where its gram is the smallest of a window around it.
    padded = np.zeros(len(grams) + inner - 1, dtype=np.uint64)
    padded[inner - 1 : inner - 1 + len(least)] = np.where(valid, least, 0)
    most = ~sliding_min(~padded, inner)
    places = np.flatnonzero((most == grams) & (most > 0))
    # Of the blocks around a place one at most has its gram as anchor.
    block = np.searchsorted(last, places - inner + 1, side="left")
    found = np.full(len(places), -1)
    open_ = np.arange(len(places))
    while len(open_):
        near = (block[open_] < len(first)) & (first[np.minimum(block[open_], len(first) - 1)] <= places[open_])
        open_ = open_[near]
        hit = anchor[block[open_]] == grams[places[open_]]
        found[open_[hit]] = block[open_[hit]]
        open_ = open_[~hit]
        block[open_] += 1
    occurrences = np.bincount(found[found >= 0], minlength=len(first))
    return {"first": first, "last": last, "owner": owner[first], "anchor": anchor, "occurrences": occurrences}


def blocks(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """BLOCKS of the rows of `documents` (doc_id, text_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(strings(batch.column("text")))
            hashes = words.hashes()
            found = anchored(hashes, words.bounds, width)
            first, last, owner = found["first"], found["last"], pa.array(found["owner"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(owner),
                    batch.column("text_key").take(owner),
                    pa.array((first - words.bounds[found["owner"]]).astype(np.int32)),
                    pa.array((last - first + 1).astype(np.int32)),
                    pa.array(found["occurrences"].astype(np.int32)),
                    pa.array(as_signed(found["anchor"].astype(np.uint64))),
                    pa.array(as_signed(spans(hashes, first, last + width))),
                ],
                names=[field.split()[0] for field in BLOCKS.split(", ")],
            )

    return documents.mapInArrow(run, BLOCKS)


def _windows(documents: DataFrame, width: int) -> DataFrame:
    """WINDOWS of the blocks listed in `wanted` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(strings(batch.column("text")))
            hashes = words.hashes()
            listed = batch.column("wanted")
            owner = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
            rows = listed.flatten()
            start, n = rows.field("start").to_numpy().astype(np.int64), rows.field("n").to_numpy().astype(np.int64)
            which = np.repeat(np.arange(len(n)), n)
            offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            at = (words.bounds[owner] + start)[which] + offset
            which = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.field("anchor").take(which),
                    rows.field("content").take(which),
                    pa.array(offset.astype(np.int32)),
                    pa.array(as_signed(rolling(hashes, width)[at])) if len(at) else pa.array([], pa.int64()),
                    rows.field("single").take(which),
                ],
                names=[field.split()[0] for field in WINDOWS.split(", ")],
            )

    return documents.select("text", "wanted").mapInArrow(run, WINDOWS)


def repeats(spark: SparkSession, documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, parts: runs of windows that repeat, with a place where they also stand.

    documents: doc_id, text_key, text. parts: array of (start, n, ref_doc_id, ref_start).
    """
    folder = work_dir(spark, "substring")
    kept = {"compression": "zstd"}
    blocks(documents, width).write.options(**kept).parquet(f"{folder}/blocks")
    all_blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")

    # The index: anchors that occur more than once, counted before they are shuffled.
    shared = all_blocks.groupBy("anchor").agg(F.sum("occurrences").alias("seen")).where("seen > 1").select("anchor")
    all_blocks.join(shared, "anchor").write.options(**kept).parquet(f"{folder}/candidates")
    candidates = spark.read.schema(BLOCKS).parquet(f"{folder}/candidates")
    discard(spark, f"{folder}/blocks")

    # Equal contents are equal blocks: the hash of a content covers its length too.
    place = F.struct("doc_id", "start", "text_key")
    candidates.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"),
        F.first("n").alias("n"),
        F.max("occurrences").alias("occurrences"),
        F.min(place).alias("low"),
        F.max(place).alias("high"),
    ).write.options(**kept).parquet(f"{folder}/contents")
    contents = spark.read.parquet(f"{folder}/contents")

    # Boundaries: anchors with a block that has no equal, but has others with its anchor, or
    # its anchor twice.
    uneven = (
        contents.groupBy("anchor")
        .agg(
            F.count("*").alias("different"),
            F.min("copies").alias("copies"),
            F.max(F.when(F.col("copies") == 1, F.col("occurrences"))).alias("occurrences"),
        )
        .where("copies = 1 AND (different > 1 OR occurrences > 1)")
        .select("anchor")
    )
    wanted = (
        contents.join(uneven, "anchor", "left_semi")
        .groupBy(F.col("low.doc_id").alias("doc_id"), F.col("low.text_key").alias("text_key"))
        .agg(
            F.collect_list(
                F.struct(F.col("low.start").alias("start"), "n", "anchor", "content", (F.col("copies") == 1).alias("single"))
            ).alias("wanted")
        )
    )
    same = [documents["doc_id"].eqNullSafe(wanted["doc_id"]), documents["text_key"] == wanted["text_key"]]
    listed = documents.join(wanted, same).select(documents["text"], wanted["wanted"])
    # A row that stands there twice gives its windows twice, but then its blocks have copies too.
    _windows(listed, width).write.options(**kept).parquet(f"{folder}/windows")
    windows = spark.read.schema(WINDOWS).parquet(f"{folder}/windows")
    other = F.struct("content", "position")
    again = (
        windows.groupBy("anchor", "window")
        .agg(F.count("*").alias("times"), F.min(other).alias("low"), F.max(other).alias("high"))
        .where("times > 1")
    )
    # Written first, so that the join below can split a window that very many blocks hold.
    again.write.options(**kept).parquet(f"{folder}/again")
    again = spark.read.schema(again.schema).parquet(f"{folder}/again")
    # Of blocks that are no factor as a whole, the windows that repeat, with another place.
    inside = windows.where("single").join(again, ["anchor", "window"])
    own = (F.col("low.content") == F.col("content")) & (F.col("low.position") == F.col("position"))
    inside = inside.select(
        "anchor", "content", "position", F.when(own, F.col("high")).otherwise(F.col("low")).alias("other")
    ).select("anchor", "content", "position", F.col("other.content").alias("there"), F.col("other.position").alias("shift"))
    places = contents.select("anchor", F.col("content").alias("there"), "low")
    inside = inside.join(places, ["anchor", "there"]).select(
        "anchor", "content", "position", F.lit(1).alias("run"), F.col("low.doc_id").alias("ref_doc_id"),
        (F.col("low.start") + F.col("shift")).alias("ref_start"),
    )
    inside = inside.groupBy("anchor", "content").agg(
        F.collect_list(F.struct("position", "run", "ref_doc_id", "ref_start")).alias("repeated")
    )
    single = (
        candidates.join(inside, ["anchor", "content"])
        .select("doc_id", "text_key", "start", F.explode("repeated").alias("r"))
        .select(
            "doc_id", "text_key",
            F.struct((F.col("start") + F.col("r.position")).alias("start"), F.col("r.run").alias("n"), "r.ref_doc_id", "r.ref_start").alias("part"),
        )
    )
    # The reference of a whole block is its first place, or for that one its last.
    whole = candidates.join(
        contents.where("copies > 1").select("anchor", "content", "low", "high"), ["anchor", "content"]
    )
    first = F.col("low.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("low.start") == F.col("start"))
    ref = F.when(first, F.col("high")).otherwise(F.col("low"))
    whole = whole.select(
        "doc_id", "text_key",
        F.struct("start", "n", ref["doc_id"].alias("ref_doc_id"), ref["start"].alias("ref_start")).alias("part"),
    )
    return single.unionByName(whole).groupBy("doc_id", "text_key").agg(F.collect_set("part").alias("parts"))


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes an intermediate of this operator that no later step reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def factored(
    spark: SparkSession, documents: DataFrame, width: int = WIDTH, with_text: bool = True
) -> DataFrame:
    """RESULT, one row for each row of `documents` (doc_id, text; others are dropped).

    Every word covered by a window of `width` words that also starts anywhere else, in the same
    document too, is removed; windows are judged on the input. Null and empty texts, and texts
    shorter than a window, have no factors. Rows that repeat id and text repeat each other. A
    window is known by two 64-bit hashes, of its anchor and of all its words.
    """
    rows = keyed(documents)
    found = repeats(spark, rows, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(strings(batch.column("text")))
            texts, listed = words.flat.to_pylist(), batch.column("parts").to_pylist()
            n_removed, digests, kept, factors = [], [], [], []
            for k in range(batch.num_rows):
                own = texts[words.bounds[k] : words.bounds[k + 1]]
                merged = parse(listed[k] or (), width)
                rest, at = [], 0
                for start, end in covered(merged):
                    rest += own[at:start]
                    at = end
                rest += own[at:]
                text = " ".join(rest)
                n_removed.append(len(own) - len(rest))
                digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                kept.append(text if with_text and merged else None)
                factors.append(merged if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(words.counts),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digests),
                    pa.array(kept, pa.string()),
                    pa.array(factors, _FACTORS),
                ],
                names=["doc_id", "text_key", "n_words", "n_removed", "kept_sha256", "kept", "factors"],
            )

    same = [rows["doc_id"].eqNullSafe(found["doc_id"]), rows["text_key"] == found["text_key"]]
    joined = rows.join(found, same, "left").select(rows["doc_id"], rows["text_key"], rows["text"], found["parts"])
    return joined.mapInArrow(run, RESULT)


_FACTORS = pa.list_(
    pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc_id", pa.int64()), ("ref_start", pa.int32())])
)


def parse(parts, width: int) -> list[tuple[int, int, int | None, int]]:
    """Factors (start, words, reference document, place there): parts that go on are joined."""
    out: list[list] = []
    for part in sorted(parts, key=lambda p: (p["start"], -p["n"])):
        start, end = part["start"], part["start"] + part["n"] + width - 1
        if out:
            last = out[-1]
            goes_on = part["ref_doc_id"] == last[2] and part["ref_start"] - start == last[3] - last[0]
            if end <= last[1]:
                continue
            if goes_on and start <= last[1] - width + 1:
                last[1] = end
                continue
        out.append([start, end, part["ref_doc_id"], part["ref_start"]])
    return [(start, end - start, doc, there) for start, end, doc, there in out]


def covered(factors) -> Iterator[tuple[int, int]]:
    """Disjoint ranges of words under factors, which are sorted by start."""
    begin = stop = None
    for start, length, _, _ in factors:
        if stop is None or start > stop:
            if stop is not None:
                yield begin, stop
            begin, stop = start, start + length
        else:
            stop = max(stop, start + length)
    if stop is not None:
        yield begin, stop


def without_repeats(spark: SparkSession, documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """`documents`, all columns and rows, with repeated passages cut out of `text`.

    Texts without a factor stay as they are, null ones too; of others the kept words are joined
    by one blank, and n_chars, if there is such a column, follows.
    """
    names = documents.columns
    own_id, own_key, own_parts = (fresh(names, name) for name in ("own_id", "own_key", "own_parts"))
    long_id = F.col("doc_id").cast("long")
    rows = documents.withColumns({own_id: long_id, own_key: F.xxhash64(long_id, F.coalesce("text", F.lit("")))})
    found = repeats(spark, keyed(documents), width)
    joined = rows.join(
        found, [rows[own_id].eqNullSafe(found["doc_id"]), rows[own_key] == found["text_key"]], "left"
    ).select(*(rows[c] for c in names), found["parts"].alias(own_parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(strings(batch.column("text")))
            flat = words.flat.to_pylist()
            texts = batch.column("text").to_pylist()
            for k, parts in enumerate(batch.column(own_parts).to_pylist()):
                if parts:
                    own, rest, at = flat[words.bounds[k] : words.bounds[k + 1]], [], 0
                    for start, end in covered(parse(parts, width)):
                        rest += own[at:start]
                        at = end
                    texts[k] = " ".join(rest + own[at:])
            columns = [
                pa.array(texts, batch.schema.field("text").type) if name == "text" else batch.column(name) for name in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = joined.mapInArrow(run, T.StructType(documents.schema.fields))
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out
