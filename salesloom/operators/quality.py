"""Key checks, load verification and reports of text that did not parse."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.text import parsed
from salesloom.operators.rollup import SALE_ROWS, is_pre_aggregated, row_count
from salesloom.plans.session import work_dir
from salesloom.schema import TableDef


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their number of rows."""
    return (
        df.groupBy(F.col(key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where((F.col("row_count") > 1) | F.col("key_value").isNull())
    )


def pk_summary(df: DataFrame, key: str, table: str) -> DataFrame:
    """One row: how many key values repeat, how many rows they hold, how many keys are NULL."""
    bad = pk_violations(df, key)
    repeated = F.col("key_value").isNotNull()
    return bad.agg(
        F.lit(table).alias("table_name"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("row_count"))), F.lit(0).cast("bigint")).alias(
            "repeated_rows"
        ),
        F.coalesce(F.sum(F.when(~repeated, F.col("row_count"))), F.lit(0).cast("bigint")).alias(
            "null_rows"
        ),
    )


def fk_orphans(fact: DataFrame, fact_key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    """Fact key values without a dimension row. NULL refers to nothing and is no orphan."""
    # Counted per key first: the anti join then moves keys, not sales.
    used = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("key_value"))
        .agg(row_count(fact).alias("row_count"))
    )
    known = dimension.select(F.col(dim_key).alias("key_value"))
    return used.join(known, "key_value", "left_anti")


def fk_summary(
    fact: DataFrame, fact_key: str, dimension: DataFrame, dim_key: str, dim_name: str
) -> DataFrame:
    """One row: number of orphan key values, and of the fact rows that hold them."""
    return fk_orphans(fact, fact_key, dimension, dim_key).agg(
        F.lit(fact_key).alias("fact_key"),
        F.lit(dim_name).alias("dimension"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("orphan_rows"),
    )


def fk_report(
    fact: DataFrame,
    dimensions: dict[str, DataFrame],
    table: TableDef,
    more: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """The summary of each foreign key of the table whose column and dimension are given.

    `more` names further keys as table.foreign_keys does: column -> (dimension, its key). The fact is
    read once: grouping sets fold it to one row per key and value in each task, before anything is
    shuffled, so a value in a third of the rows is one row of each task. Keys keep their types. The
    folded keys are written, a folder for each key, and each is compared with its own dimension.
    """
    keys = {
        key: place
        for key, place in {**table.foreign_keys, **(more or {})}.items()
        if place[0] in dimensions and key in fact.columns
    }
    names = list(keys)
    sets = [[F.col(name)] for name in names]
    used = fact.groupingSets(sets, *names).agg(F.grouping_id().alias("_set"), row_count(fact).alias("row_count"))
    used.write.partitionBy("_set").parquet(folder := work_dir(fact.sparkSession, "fk-keys"))
    used = fact.sparkSession.read.schema(used.schema).parquet(folder)
    # In the set of the k-th key all other keys are folded: their bits are set.
    every = (1 << len(names)) - 1
    found = []
    for k, (key, (dim, dim_key)) in enumerate(keys.items()):
        own = used.where(F.col("_set") == every - (1 << (len(names) - 1 - k))).where(F.col(key).isNotNull())
        known = dimensions[dim].select(F.col(dim_key).alias(key))
        orphans = own.select(key, "row_count").join(known, key, "left_anti")
        found.append(
            orphans.agg(
                F.lit(key).alias("fact_key"),
                F.lit(dim).alias("dimension"),
                F.count(F.lit(1)).alias("orphan_keys"),
                F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("orphan_rows"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def load_profile(sales: DataFrame) -> DataFrame:
    """Row count, distinct days and date range of a loaded fact, in one pass."""
    return sales.agg(
        row_count(sales).alias("row_count"),
        F.countDistinct("order_date").alias("distinct_days"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def parsed_once(strings: DataFrame, table: TableDef) -> DataFrame:
    """The strings with `typed`, the table's columns in their types, and `rejected_columns`.

    Each text is parsed once: a text that is present and gives no value is a reject. Both come out of
    one generator, which Spark computes once a row, so values and rejects can be written from one pass.
    """
    fields = table.schema.fields
    missing = [f.name for f in fields if f.name not in strings.columns]
    if missing:
        raise ValueError(f"{table.name}: columns {missing} are missing from the source")
    values = F.struct(*[parsed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    once = strings.select("*", F.inline(F.array(F.struct(values.alias("typed")))))
    failed = F.array_compact(
        F.array(
            *[F.when(F.col(f"`{f.name}`").isNotNull() & F.col("typed")[f.name].isNull(), F.lit(f.name)) for f in fields]
        )
    )
    return once.withColumn("rejected_columns", failed)


def _entries(fields: list[T.StructField]) -> Column:
    """One row per column, from counts named after the columns."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("target_type"),
                    F.col(f"`{f.name}`").alias("rejects"),
                )
                for f in fields
            ]
        )
    )


def _counts(fields: list[T.StructField]) -> list[Column]:
    return [F.count_if(F.array_contains("rejected_columns", f.name)).alias(f.name) for f in fields]


def cast_rejects(strings: DataFrame, table: TableDef) -> DataFrame:
    """Per column: number of texts that are present but do not parse as the column's type."""
    fields = table.schema.fields
    return parsed_once(strings, table).agg(*_counts(fields)).select(_entries(fields))


def rejected_rows(strings: DataFrame, table: TableDef) -> DataFrame:
    """Source rows with at least one such text, and the names of the columns concerned."""
    return parsed_once(strings, table).where(F.size("rejected_columns") > 0).drop("typed")


def load_with_rejects(
    strings: DataFrame, table: TableDef, path: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loads a source in one pass: its typed rows, its rejected rows, and the rejects of each column.

    The source is read and parsed once. Rows go to two folders below `path`: all of them with their
    values, where a reject is NULL, by whether they have any; those that do also keep their texts.
    Counts are taken by the writing stage, so no second read is needed, and a retried task counts once.
    """
    fields = table.schema.fields
    spark = strings.sparkSession
    counter = Observation(f"{table.name}-rejects-{uuid.uuid4().hex[:12]}")
    source = F.struct(*[F.col(f"`{c}`") for c in strings.columns])
    rows = parsed_once(strings, table).observe(counter, F.count(F.lit(1)).alias("rows loaded"), *_counts(fields))
    flawed = F.size("rejected_columns") > 0
    stored = rows.select(
        "typed",
        F.when(flawed, source).alias("source"),
        F.when(flawed, F.col("rejected_columns")).alias("rejected_columns"),
        flawed.alias("flawed"),
    )
    stored.write.partitionBy("flawed").parquet(path)
    kept = T.StructType([f for f in stored.schema.fields if f.name != "flawed"] + [T.StructField("flawed", T.BooleanType())])
    written = spark.read.schema(kept).parquet(path)
    found = counter.get
    counts = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), int(found[f.name])) for f in fields],
        "column_name string, target_type string, rejects bigint",
    )
    return (
        written.select("typed.*"),
        written.where("flawed").select("source.*", "rejected_columns"),
        counts,
    )
