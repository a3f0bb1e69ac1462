"""Makes this library importable in the Python workers of a session."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import salesloom

ARCHIVE = "salesloom_library.zip"


def ship(spark: SparkSession) -> None:
    """Adds the library to the session's Python files, once.

    Workers then need neither a copy installed on each machine nor a certain working folder.
    """
    context = spark.sparkContext
    if any(name.endswith(ARCHIVE) for name in context.listFiles):
        return
    package = Path(salesloom.__file__).parent
    folder = Path(tempfile.mkdtemp(prefix="salesloom-ship-"))
    made = shutil.make_archive(str(folder / ARCHIVE.removesuffix(".zip")), "zip", package.parent, package.name)
    context.addPyFile(made)
