"""Records of quoted CSV files whose fields hold line breaks, found in many tasks.

Whether a line break ends a record depends on all quotes before it in the file. Spark cuts files into
blocks, and gives each line to the block in which it begins, so a survey first counts each block's
quotes: if their number is odd, the block turns inside into outside. A running sum over the blocks
of a file then says for each whether it begins inside a field. With that, every block joins its
lines into records on its own, in the order in which they are scanned. Only the end of a record
that began in another block is moved: one piece per block at most.

Quotes in a field are doubled and a field with quotes stands in quotes, as `write_csv` and dataframe
tools write them; a lone quote in an unquoted field would turn the rest of its file around.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.plans.session import work_dir

SPLITS = "spark.sql.files.minPartitionNum"
# The place of a block: its file, first byte and length.
BLOCK = ["file", "block", "length"]
HEAD, TAIL = 0, 1


def lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files with their block and a number that rises within it."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"),
        meta["file_block_length"].alias("length"),
        F.monotonically_increasing_id().alias("n"),
        "value",
    )


@dataclass(frozen=True)
class Survey:
    """What the quotes of a folder's blocks say.

    blocks: one row per block: BLOCK, begins_inside, ends_inside. broken: whether any record has
    more than one line. crossing: whether any record goes on after its block.
    """

    blocks: DataFrame
    broken: bool
    crossing: bool


def survey(spark: SparkSession, path: str) -> Survey:
    """Counts quotes; one row per block is written and read back, one row comes to the driver.

    Later reads must cut the files alike. The number of parts that Spark aims at follows the cores it
    has, so it is set for the session unless it is; a read that is cut otherwise all the same fails.
    """
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    per_block = lines(spark, path).groupBy(*BLOCK).agg(F.sum(odd).alias("odd_lines"))
    so_far = F.sum("odd_lines").over(Window.partitionBy("file").orderBy("block"))
    per_block.select(
        *BLOCK,
        "odd_lines",
        ((so_far - F.col("odd_lines")) % 2 == 1).alias("begins_inside"),
        (so_far % 2 == 1).alias("ends_inside"),
    ).write.parquet(folder := work_dir(spark, "csv-blocks"))
    blocks = spark.read.parquet(folder)
    found = blocks.agg(F.max("odd_lines").alias("odd"), F.bool_or("ends_inside").alias("crossing")).first()
    return Survey(blocks.drop("odd_lines"), bool(found.odd), bool(found.crossing))


def records(spark: SparkSession, path: str, known: Survey) -> DataFrame:
    """first (whether it is the first of its file) and record, with the line breaks inside fields.

    A field that is still open at the end of its file ends there.
    """
    # A read that is cut into other blocks than the survey saw would mix up records.
    other = F.raise_error(F.lit("the files are cut into other blocks than before; read them again"))
    placed = lines(spark, path).join(known.blocks.select(*BLOCK, "begins_inside"), BLOCK, "left")
    placed = placed.withColumn("begins_inside", F.coalesce("begins_inside", other.cast("boolean")))
    whole = _pieces(placed, False).select("first", "record")
    if not known.crossing:
        return whole
    cut = known.blocks.where("begins_inside OR ends_inside").select(*BLOCK, "begins_inside")
    return whole.unionByName(_joined(_pieces(lines(spark, path).join(cut, BLOCK), True)))


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from their pieces: a tail, and the heads of the blocks after it."""
    in_file = Window.partitionBy("file").orderBy("block", "kind")
    chain = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(in_file)
    pieces = pieces.withColumn("chain", chain)
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "record")))
    return pieces.groupBy("file", "chain").agg(
        F.bool_or("first").alias("first"),
        F.array_join(F.transform(parts, lambda part: part["record"]), "\n").alias("record"),
    ).select("first", "record")


def _pieces(found: DataFrame, cut: bool) -> DataFrame:
    """file, block, kind, first, record: records inside one block, or the pieces of those that are `cut`.

    A HEAD goes on with a record of an earlier block, a TAIL begins one that goes on in later ones.
    found: lines with begins_inside, in any order.
    """
    head, tail = HEAD, TAIL

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        inside, is_head, fresh = False, False, False
        pending: list[str] = []

        def piece(text: str) -> pa.RecordBatch:
            columns = [[at[0]], [at[1]], [head if is_head else tail], [fresh], [text]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        def whole(texts: pa.Array, first: bool) -> pa.RecordBatch:
            flags = np.zeros(len(texts), dtype=bool)
            flags[0] = first
            none = [pa.nulls(len(texts), kind) for kind in kinds[:3]]
            return pa.RecordBatch.from_arrays([*none, pa.array(flags), texts], names=names)

        names = ["file", "block", "kind", "first", "record"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        for batch in batches:
            if not batch.num_rows:
                continue
            files, starts, insides, value = (batch.column(k) for k in range(4))
            odd = pc.count_substring(value, '"').to_numpy() % 2
            place, codes = starts.to_numpy(), files.dictionary_encode().indices.to_numpy()
            turns = np.flatnonzero((np.diff(place) != 0) | (np.diff(codes) != 0)) + 1
            for low, high in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                here = (files[low].as_py(), int(place[low]))
                if here != at:
                    if inside and cut:
                        yield piece("\n".join(pending))
                    at, pending, fresh = here, [], here[1] == 0
                    inside = is_head = insides[low].as_py()
                own = value.slice(low, high - low)
                after = (int(inside) + np.cumsum(odd[low:high])) % 2
                ends = np.flatnonzero(after == 0) + 1
                inside = bool(after[-1])
                if not len(ends):
                    pending += own.to_pylist()
                    continue
                done = 0
                if pending or is_head:  # the end of what was begun before this batch
                    done = int(ends[0])
                    text = "\n".join([*pending, *own.slice(0, done).to_pylist()])
                    if is_head and cut:
                        yield piece(text)
                    elif not is_head and not cut:
                        yield whole(pa.array([text]), fresh)
                    fresh = fresh and is_head
                    is_head, ends = False, ends[1:]
                if len(ends):
                    if not cut:
                        offsets = pa.array(np.concatenate(([0], ends - done)), pa.int32())
                        lists = pa.ListArray.from_arrays(offsets, own.slice(done, int(ends[-1]) - done))
                        yield whole(pc.binary_join(lists, "\n"), fresh)
                    fresh, done = False, int(ends[-1])
                pending = own.slice(done).to_pylist()
        if inside and cut:
            yield piece("\n".join(pending))

    return (
        found.sortWithinPartitions("file", "block", "n")
        .select("file", "block", "begins_inside", "value")
        .mapInArrow(run, "file string, block long, kind int, first boolean, record string")
    )
