"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str, master: str | None = None, **options: str) -> SparkSession:
    """A session with the settings the library relies on; options use __ for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    settings.update({key.replace("__", "."): value for key, value in options.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings for reading versioned tables; safe to apply to any session."""
    # Columns are found by field id where a schema carries ids, else by name.
    spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
    # Small writes into many directories: with Spark's 1 MB all days would queue behind one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    # The default lists each directory in a task of its own: one task per day and
    # commit. A few waves over the cluster's cores list the same directories faster.
    waves = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(waves))
    return spark


@contextmanager
def session_conf(spark: SparkSession, **options: str) -> Iterator[None]:
    """Settings that hold for the actions inside the block; names use __ for dots."""
    wanted = {key.replace("__", "."): value for key, value in options.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="salesloom-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for written intermediates that every executor can reach.

    It lies in the folder named by spark.checkpoint.dir. Only a local session may
    go without that setting; it then gets a temporary folder of this machine.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
