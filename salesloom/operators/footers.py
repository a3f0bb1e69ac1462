"""Row counts, least and largest values of Parquet partitions, from file footers alone.

Spark answers COUNT, MIN and MAX by partition from the footers if its second data source reads the
files and nothing else is asked. No row group is opened then. Files are dealt to tasks by number,
not by size, since a footer costs the same whatever the file holds.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.plans.session import session_conf, work_dir

#: Footers that a task reads.
FILES_PER_TASK = 200
# Types whose footers always hold both ends; those of texts may be cut off, NaN leaves none.
ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def partition_stats(
    spark: SparkSession,
    paths: list[str],
    base_path: str,
    schema: T.StructType,
    partitions: list[str],
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per partition: `partitions`, record_count, and least_<c> and largest_<c> of `columns`.

    schema: the files' columns and all partition columns; `partitions` must name the latter. A
    column must be in every file under its name, as a whole number or a date. The footer of a file
    that holds nothing but NULL has no ends; `columns` are then read after all. The result is
    written and read back, since Spark decides on the footers while it runs: one row a partition.
    """
    columns = columns or []
    for name in columns:
        if not isinstance(schema[name].dataType, ORDERED):
            raise ValueError(f"{name}: footers have no sure ends of {schema[name].dataType.simpleString()}")
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    share = 1 << 36  # larger than any file, so that files are dealt by number
    settings = {
        "spark__sql__sources__useV1SourceList": "",
        "spark__sql__parquet__aggregatePushdown": "true",
        "spark__sql__files__openCostInBytes": str(share),
        "spark__sql__files__maxPartitionBytes": str(share * FILES_PER_TASK),
        "spark__sql__files__minPartitionNum": "1",
    }

    def written() -> DataFrame:
        found = spark.read.schema(plain).option("basePath", base_path).parquet(*paths)
        ends = [(F.min(c).alias(f"least_{c}"), F.max(c).alias(f"largest_{c}")) for c in columns]
        stats = found.groupBy(*partitions).agg(F.count("*").alias("record_count"), *[e for pair in ends for e in pair])
        stats.write.parquet(folder := work_dir(spark, "footers"))
        return spark.read.schema(stats.schema).parquet(folder)

    try:
        with session_conf(spark, **settings):
            return written()
    except Py4JJavaError:
        if not columns:
            raise
        return written()  # some file's footer has no ends: its columns are read
