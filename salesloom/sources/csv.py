"""CSV with a header: typed reading, and export that loses nothing.

Export keeps blanks at the ends of texts and line breaks inside quotes, writes NULL as nothing and
an empty text as a pair of quotes. Read such files back with `exported=True`: large files are read
in many tasks whether their records have line breaks or not; see `records.py`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.text import typed
from salesloom.schema import TableDef
from salesloom.sources.records import Survey, records, survey

# Quotes are doubled inside quoted fields, as spreadsheet and dataframe tools write them.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# What export writes, and reading it back takes.
KEEPING = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Stands for an empty text between Spark's parser, which takes both for NULL, and the reader below.
EMPTY_MARK = "\x01empty\x01"
ROWS_PER_FILE = 10_000_000
SPLIT_FROM = 128 << 20


def read_strings(
    spark: SparkSession, path: str, exported: bool = False, split_from: int = SPLIT_FROM, **options: str
) -> DataFrame:
    """Every column of the header as text. Files whose header differs are refused.

    `exported` reads what `write_csv` wrote, as it was. Files of up to `split_from` bytes are then a
    task each. If any is larger, its quotes are counted first: without a line break in a field Spark
    splits the files by lines, else records are found block by block.

    Otherwise a field without text is NULL, as dataframe tools write it, and records end at line
    breaks, so that large files split.
    """
    reader = spark.read.options(**CSV_OPTIONS).options(enforceSchema="false")
    if not exported:
        return reader.options(**options).csv(path)
    kept = {**KEEPING, "emptyValue": EMPTY_MARK, **options}
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    known = survey(spark, path) if largest is not None and largest > split_from else None
    if known is None:
        found = reader.options(**kept, multiLine="true", lineSep="\n").csv(path)
    elif known.broken:
        found = _parsed(spark, path, known, kept)
    else:
        found = reader.options(**kept, lineSep="\n").csv(path)
    column = lambda name: F.col(f"`{name}`")
    return found.select(*[F.when(column(c) == EMPTY_MARK, "").otherwise(column(c)).alias(c) for c in found.columns])


def _parsed(spark: SparkSession, path: str, known: Survey, options: dict[str, str]) -> DataFrame:
    """The records that were found, as columns; the first one of each file is its header."""
    names = spark.read.options(**CSV_OPTIONS).options(**options, multiLine="true", lineSep="\n").csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    fields = F.from_csv("record", schema.toDDL(), {**CSV_OPTIONS, **options, "header": "false"})
    # A generator is computed once a record; the fields of a struct would each parse it again.
    starts = next(f"first{k}" for k in range(len(names) + 1) if f"first{k}" not in {n.lower() for n in names})
    found = records(spark, path, known).where(F.trim("record") != "")
    found = found.select(F.col("first").alias(starts), F.inline(F.array(fields)))
    same = reduce(Column.__and__, [F.col(f"`{name}`").eqNullSafe(F.lit(name)) for name in names])
    refused = F.raise_error(F.lit("the header of a file differs")).cast("boolean")
    return found.where(F.when(~F.col(starts), True).when(same, False).otherwise(refused)).drop(starts)


def conform(strings: DataFrame, table: TableDef) -> DataFrame:
    """The table's columns in their types; other columns are dropped, bad text becomes NULL."""
    missing = [name for name in table.schema.names if name not in strings.columns]
    if missing:
        raise ValueError(f"{table.name}: columns {missing} are missing from the source")
    return strings.select(*[typed(f.name, f.dataType) for f in table.schema.fields])


def read_table(
    spark: SparkSession, path: str, table: TableDef, exported: bool = False, **options: str
) -> DataFrame:
    return conform(read_strings(spark, path, exported, **options), table)


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """One folder of CSV files, each with the header and without a row index.

    Rows are rebalanced first: as many tasks write as there are rows for, and none a file without end.
    """
    spread = df.hint("rebalance")
    spread.write.options(**CSV_OPTIONS, **KEEPING, maxRecordsPerFile=rows_per_file).mode(mode).csv(path)


def export_tables(frames: dict[str, DataFrame], folder: str, mode: str = "errorifexists") -> None:
    for name, df in frames.items():
        write_csv(df, f"{folder}/{name}", mode)
