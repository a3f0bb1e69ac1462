"""Full refresh of a set of tables, parents loaded before the fact that refers to them."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame

from salesloom.schema import LOAD_ORDER
from salesloom.tables.lake import Lake


class Sink(Protocol):
    def clear(self, name: str, like: DataFrame) -> None: ...

    def load(self, name: str, rows: DataFrame) -> None: ...


class LakeSink:
    """Tables of a lake; partitioning is given per table as (column, granularity)."""

    def __init__(self, lake: Lake, partitioning: dict[str, tuple[str, str]] | None = None):
        self.lake = lake
        self.partitioning = partitioning or {}

    def clear(self, name: str, like: DataFrame) -> None:
        column, granularity = self.partitioning.get(name, (None, "day"))
        self.lake.create(name, like.schema, column, granularity, or_replace=True)

    def load(self, name: str, rows: DataFrame) -> None:
        self.lake.append(name, rows)


class JdbcSink:
    """Existing tables of a database. Credentials come with the properties, never from here."""

    def __init__(self, url: str, properties: dict[str, str], connections: int = 8):
        self.url = url
        self.properties = {**properties, "numPartitions": str(connections)}

    def clear(self, name: str, like: DataFrame) -> None:
        # Overwriting with no rows and truncate on keeps the table's definition and keys.
        options = {**self.properties, "truncate": "true", "cascadeTruncate": "true"}
        like.limit(0).write.jdbc(self.url, name, mode="overwrite", properties=options)

    def load(self, name: str, rows: DataFrame) -> None:
        rows.write.jdbc(self.url, name, mode="append", properties=self.properties)


def refresh_all(
    frames: dict[str, DataFrame], sink: Sink, report: Callable[[str], None] | None = None
) -> None:
    """Clear every table, the fact first, then load the dimensions and last the fact."""
    order = [table.name for table in LOAD_ORDER if table.name in frames]
    for name in reversed(order):
        sink.clear(name, frames[name])
    for name in order:
        sink.load(name, frames[name])
        if report is not None:
            report(name)
