"""WARC archives with an index: records are written once, then read back by byte ranges.

Writing comes first and gives an index: for each record the archive, the offset and length
of its bytes, its URL and its payload digest. Reading takes a selection of index rows, sorts
them by archive and offset, joins neighbouring ranges into one read and cuts the records out.

Each record is a gzip member of its own, as WARC files have them, so any range of the index
can be opened without the bytes before it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.textops import slices
from salesloom.plans.session import work_dir

#: Size at which a task begins another archive.
ARCHIVE_BYTES = 1 << 30
#: Ranges are joined into one read when the gap between them is not larger than this ...
MAX_GAP = 64 << 10
#: ... and the read not longer than this.
MAX_READ = 16 << 20
#: Ranges of this many bytes of an archive are read by one task group.
RANGE_BYTES = 16 << 20
WARC_DATE = "2024-01-01T00:00:00Z"

INDEX_SCHEMA = (
    "archive string, offset long, length long, record_id long, url string, "
    "payload_digest string, payload_bytes long, record_type string, refers_to long"
)
READ_SCHEMA = (
    "record_id long, url string, payload_digest string, payload_bytes long, "
    "record_type string, refers_to long, block binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def classified(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload_digest, payload_bytes, record_type and refers_to.

    records: record_id long, url string, payload string or binary; other columns are dropped.
    Of records with equal payloads of `min_bytes` or more, the one with the smallest id is
    a response and the others revisit it; all smaller ones are responses. A null payload
    counts as empty. A null id is kept as a response and never referred to. A repeated
    smallest id stays a response in each of its rows.

    Copies are counted before they are shuffled, and only digests of groups with two or
    more members are joined, so a page copied into a third of the rows splits as any
    skewed join does.
    """
    with_digest = records.select(
        "record_id", "url", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload")
    ).mapInArrow(
        _digests,
        "record_id long, url string, payload binary, payload_digest string, payload_bytes long",
    )
    firsts = (
        with_digest.where((F.col("payload_bytes") >= min_bytes) & F.col("record_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.min("record_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "first_id")
    )
    revisit = (
        F.col("first_id").isNotNull()
        & F.col("record_id").isNotNull()
        & (F.col("record_id") != F.col("first_id"))
        & (F.col("payload_bytes") >= min_bytes)
    )
    return with_digest.join(firsts, "payload_digest", "left").select(
        "record_id",
        "url",
        "payload",
        "payload_digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "payload"):
        payloads = [x.as_buffer() for x in batch.column("payload")]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array([digest(x) for x in payloads], pa.string()),
                pa.array([x.size for x in payloads], pa.int64()),
            ],
            names=[*batch.schema.names, "payload_digest", "payload_bytes"],
        )


def write_archives(records: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes a WARC record for every row into `folder` and returns the index.

    An attempt of a task writes archives under names of its own, and the index, written
    last, names only archives of tasks that ended well: what a lost executor leaves behind
    is never read. An empty table gives an empty index. `folder` must be reachable from
    all executors; it is opened through pyarrow's file systems (file, hdfs, s3, gs).
    """
    index = f"{folder}/index"
    classified(records, min_bytes).mapInArrow(_writer(folder), INDEX_SCHEMA).write.parquet(index)
    return records.sparkSession.read.schema(INDEX_SCHEMA).parquet(index)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if not urlparse(folder).scheme:
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), urlparse(folder).path
    return fs.FileSystem.from_uri(folder)


def record_bytes(row: dict) -> bytes:
    """One record as a gzip member."""
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else row["payload"]
    name = "" if row["record_id"] is None else str(row["record_id"])
    # A line break would end a header line early.
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:record:{name}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {url}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:record:{row['refers_to']}>")
    else:
        lines.append("Content-Type: text/html; charset=utf-8")
    lines.append(f"Content-Length: {len(block)}")
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def parsed(member: bytes) -> dict:
    """The record in a gzip member; raises where the bytes aren't one whole record."""
    head, sep, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if first != "WARC/1.1" or not sep or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    claimed = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest(rest[:size]) != claimed:
        raise ValueError("the payload is not what its digest says")
    number = lambda name: int(x) if (x := fields[name][len("<urn:record:") : -1]) else None
    return {
        "record_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_digest": claimed,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To") if "WARC-Refers-To" in fields else None,
        "block": rest[:size],
    }


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        schema = pa.schema(
            [
                ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                ("record_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
                ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ]
        )
        out, name, at = None, "", 0
        try:
            for batch in slices(batches, "payload"):
                rows = []
                for row in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        system.create_dir(f"{base}/archives", recursive=True)
                        name, at = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    member = record_bytes(row)
                    out.write(member)
                    rows.append(row | {"archive": name, "offset": at, "length": len(member)})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        finally:
            if out is not None:
                out.close()

    return write


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that `index` selects, parsed from their byte ranges in the archives.

    Rows are dealt by archive and range of RANGE_BYTES, so a group is bounded however many
    records an archive holds; inside, ranges are sorted and neighbours read at once.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        schema = pa.schema(
            [
                ("record_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
                ("payload_bytes", pa.int64()), ("record_type", pa.string()),
                ("refers_to", pa.int64()), ("block", pa.binary()),
            ]
        )
        for batch in batches:
            for archive, first, last, offsets, lengths in coalesced(batch):
                with system.open_input_file(f"{base}/{archive}") as source:
                    source.seek(first)
                    data = source.read(last - first)
                rows = [parsed(data[o - first : o - first + n]) for o, n in zip(offsets, lengths, strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    wanted = index.select(
        "archive", "offset", "length", F.floor(F.col("offset") / RANGE_BYTES).alias("part")
    )
    total = wanted.agg(F.sum("length")).first()[0] or 0
    # A stated number: the rows are small, but what they make a task read is not.
    tasks = max(1, total // RANGE_BYTES * 2, index.sparkSession.sparkContext.defaultParallelism)
    dealt = wanted.repartition(tasks, "archive", "part").sortWithinPartitions("archive", "offset")
    return dealt.drop("part").mapInArrow(read, READ_SCHEMA)


def coalesced(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, list[int], list[int]]]:
    """Reads (archive, first byte, last byte, offsets, lengths) of rows sorted by offset."""
    archives = batch.column("archive").to_pylist()
    offsets = batch.column("offset").to_numpy()
    lengths = batch.column("length").to_numpy()
    begin = 0
    for k in range(1, len(archives) + 1):
        if k < len(archives) and archives[k] == archives[begin]:
            gap = offsets[k] - (offsets[k - 1] + lengths[k - 1])
            if 0 <= gap <= MAX_GAP and offsets[k] + lengths[k] - offsets[begin] <= MAX_READ:
                continue
        if begin < k:
            yield (
                archives[begin], int(offsets[begin]), int(np.max(offsets[begin:k] + lengths[begin:k])),
                offsets[begin:k].tolist(), lengths[begin:k].tolist(),
            )
        begin = k


def pages_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes `pages` (page_id, url, html) as archives, reads them back by the index."""
    folder = work_dir(spark, "warc")
    records = pages.select(
        F.col("page_id").cast("long").alias("record_id"), "url", F.col("html").alias("payload")
    )
    index = write_archives(records, folder, min_bytes)
    back = read_records(index, folder)
    return back.select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "url",
        F.length("block").alias("block_bytes"),
    )
