"""A namespace of versioned tables.

    <root>/<table>/commit=N-<unique>/[<partition>=D/]part-*.parquet

A commit writes its files into a folder of its own and its log row last. A reader
takes the log's word for which folders belong to the table and opens only those,
with the schema the table had at that snapshot.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import asdict
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.calendar import DateLike
from salesloom.operators.compare import row_changes, row_changes_within
from salesloom.operators.footers import partition_stats
from salesloom.operators.partitions import partition_value, where_range
from salesloom.plans.session import tune
from salesloom.tables import log
from salesloom.tables.log import FIELD_ID, Partition, TableState

COMMIT = "commit"


class Lake:
    def __init__(self, spark: SparkSession, root: str, namespace: str = "db"):
        self.spark = tune(spark)
        self.namespace = namespace
        self.root = f"{root.rstrip('/')}/{namespace}"

    # -- definitions ------------------------------------------------------

    def exists(self, name: str) -> bool:
        return log.is_live(self._rows(name, may_be_new=True))

    def create(
        self,
        name: str,
        schema: T.StructType | str,
        partition_by: str | None = None,
        granularity: str = "day",
        if_not_exists: bool = False,
        or_replace: bool = False,
        committed_at: dt.datetime | None = None,
    ) -> None:
        """Define an empty table. The partition column may be a date or a timestamp.

        A date with day granularity names its directories itself, so a plain filter
        on it prunes. Otherwise a hidden column is derived; `read` hides it again.
        """
        rows = self._rows(name, may_be_new=True)
        if log.is_live(rows):
            if if_not_exists:
                return
            if not or_replace:
                raise ValueError(f"table {name} already exists")
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        with_ids, partition = self._defined(name, schema, partition_by, granularity)
        self._log(rows, name, "create", committed_at, log.encode_fields(with_ids), 0, partition)

    def _defined(
        self, name: str, schema: T.StructType, partition_by: str | None, granularity: str
    ) -> tuple[T.StructType, Partition | None]:
        """The schema with field ids, and the partition, of a table to be."""
        with_ids = T.StructType(
            [
                T.StructField(f.name, f.dataType, True, {FIELD_ID: i})
                for i, f in enumerate(schema.fields, start=1)
            ]
        )
        partition = None
        if partition_by is not None:
            partition_value(partition_by, granularity, with_ids[partition_by].dataType.simpleString())
            field = with_ids[partition_by]
            own_name = granularity == "day" and isinstance(field.dataType, T.DateType)
            directory = partition_by if own_name else f"{partition_by}_{granularity}"
            if not own_name and directory in schema.names:
                raise ValueError(f"{directory} is taken by the partition of {name}")
            partition = Partition(field.metadata[FIELD_ID], directory, granularity)
        return with_ids, partition

    def drop(
        self, name: str, if_exists: bool = False, committed_at: dt.datetime | None = None
    ) -> None:
        """End the table and its history. Its files are no longer read by anyone."""
        rows = self._rows(name, may_be_new=True)
        if not log.is_live(rows):
            if if_exists:
                return
            raise log.TableNotFound(f"table {name} does not exist")
        self._log(rows, name, "drop", committed_at, [], 0, None)

    def add_column(
        self, name: str, column: str, data_type: str, committed_at: dt.datetime | None = None
    ) -> None:
        """Add a column; rows written before read NULL. No file is touched, no snapshot made."""
        rows = self._rows(name)
        state = log.state_of(rows, name)
        if column in state.schema.names:
            raise ValueError(f"{name} already has a column {column}")
        added = T.StructField(
            column, T.DataType.fromDDL(data_type), True, {FIELD_ID: state.next_field_id}
        )
        self._alter(rows, state, T.StructType([*state.schema.fields, added]), committed_at)

    def rename_column(
        self, name: str, column: str, new_name: str, committed_at: dt.datetime | None = None
    ) -> None:
        """Rename a column. Files keep the old name and are matched by field id."""
        rows = self._rows(name)
        state = log.state_of(rows, name)
        if column not in state.schema.names or new_name in state.schema.names:
            raise ValueError(f"cannot rename {column} to {new_name} in {name}")
        fields = [
            T.StructField(new_name if f.name == column else f.name, f.dataType, True, f.metadata)
            for f in state.schema.fields
        ]
        self._alter(rows, state, T.StructType(fields), committed_at)

    # -- writes -----------------------------------------------------------

    def append(
        self, name: str, rows: DataFrame, committed_at: dt.datetime | None = None
    ) -> int:
        return self._commit(name, rows, "append", committed_at)

    def overwrite(
        self, name: str, rows: DataFrame, committed_at: dt.datetime | None = None
    ) -> int:
        """Replace the content. Earlier snapshots stay readable."""
        return self._commit(name, rows, "overwrite", committed_at)

    def insert(self, name: str, *values: Any, committed_at: dt.datetime | None = None) -> int:
        """Append one row of literals, one per column of the current schema."""
        schema = self.state(name).schema
        if len(values) != len(schema):
            raise ValueError(f"{name} has {len(schema)} columns, got {len(values)} values")
        row = self.spark.createDataFrame([tuple(values)], schema)
        return self._commit(name, row, "append", committed_at)

    def replace(
        self,
        name: str,
        rows: DataFrame,
        partition_by: str | None = None,
        granularity: str = "day",
        committed_at: dt.datetime | None = None,
    ) -> int:
        """Create the table from the rows; one of that name is gone with its history.

        Definition and rows become visible in one step, after the rows are written: until
        then, and if writing fails, the old table stays.
        """
        entries = self._rows(name, may_be_new=True)
        with_ids, partition = self._defined(name, rows.schema, partition_by, granularity)
        state = log.new_state(entries, name, with_ids, partition)
        return self._commit_to(entries, state, rows, "append", committed_at, {log.NEW_LIFE: "true"})

    # -- reads ------------------------------------------------------------

    def state(
        self,
        name: str,
        snapshot_id: int | None = None,
        as_of: dt.datetime | None = None,
    ) -> TableState:
        rows = self._rows(name)
        if as_of is not None:
            if snapshot_id is not None:
                raise ValueError("give a snapshot or a time, not both")
            snapshot_id = log.snapshot_at(rows, name, as_of)
        return log.state_of(rows, name, snapshot_id)

    def read(
        self,
        name: str,
        snapshot_id: int | None = None,
        as_of: dt.datetime | None = None,
        between: tuple[DateLike | None, DateLike | None] | None = None,
        on: str | None = None,
    ) -> DataFrame:
        """The table now, at a snapshot, or at a time (UTC, naive).

        `between` keeps rows whose partition column is in [low, high) and prunes
        directories whatever their granularity. For a table without partitions,
        or for another column, name it with `on`; then files are filtered inside.
        """
        state = self.state(name, snapshot_id, as_of)
        frame = self._scan(state, state.folders.values())
        if between is not None:
            part = state.partition
            column = on or (None if part is None else self._partition_column(state))
            if column is None:
                raise ValueError(f"{name} is not partitioned; name a column with on=")
            if part is None or column != self._partition_column(state):
                frame = where_range(frame, column, *between)
            else:
                hidden = None if part.directory not in frame.columns else part.directory
                frame = where_range(frame, column, *between, hidden, part.granularity)
        return frame.select(*state.schema.names)

    def added_since(self, name: str, since: int, until: int | None = None) -> DataFrame:
        """Rows appended after one snapshot up to another (default: the current one).

        Only the folders of the commits in between are read. An overwrite in
        between makes this undefined; compare the two reads with `row_changes` then.
        """
        old, new = self.state(name, since), self.state(name, until)
        if not old.folders.keys() <= new.folders.keys():
            raise ValueError(f"{name} was overwritten after snapshot {since}")
        later = [path for version, path in new.folders.items() if version not in old.folders]
        return self._scan(new, later).select(*new.schema.names)

    def changes(self, name: str, old: int, new: int | None = None) -> DataFrame:
        """Rows whose number of copies differs between two snapshots, as `row_changes` has them.

        Folders that both snapshots show cancel out and are not opened: between two appends only
        the later commits are read.
        """
        before, after = self.state(name, old), self.state(name, new)
        only = lambda a, b: [path for version, path in a.folders.items() if version not in b.folders]
        # Both sides in the later schema: a column added in between is NULL in older rows.
        added, gone = self._scan(after, only(after, before)), self._scan(after, only(before, after))
        part, names = after.partition, after.schema.names
        if part is None or before.folders.keys() <= after.folders.keys():
            return row_changes(added.select(*names), gone.select(*names))
        # After an overwrite both sides hold rows, most of them often equal: days or months with
        # equal fingerprints leave before any row of them is shuffled.
        hidden = part.directory in added.columns and part.directory not in names
        by = part.directory if hidden else self._partition_column(after)
        return row_changes_within(added, gone, by).select(*names, "copies")

    def scan_with_files(self, name: str, snapshot_id: int | None = None) -> DataFrame:
        """The table with its partition directory column, for reports on files."""
        state = self.state(name, snapshot_id)
        return self._scan(state, state.folders.values())

    # -- metadata ---------------------------------------------------------

    def tables(self) -> DataFrame:
        """Existing tables, with the columns of SHOW TABLES."""
        last = log.read_log(self.spark, self.root).groupBy("table_name").agg(
            F.max_by("operation", "entry").alias("operation")
        )
        return (
            last.where("operation <> 'drop'")
            .select(
                F.lit(self.namespace).alias("namespace"),
                F.col("table_name").alias("tableName"),
                F.lit(False).alias("isTemporary"),
            )
            .orderBy("tableName")
        )

    def snapshots(self, name: str) -> DataFrame:
        """Snapshots of the table, oldest first."""
        return (
            self._life(name)
            .where(F.col("operation").isin(*log.DATA_OPERATIONS))
            .select("committed_at", "snapshot_id", "parent_id", "operation", "summary", "schema_id")
            .orderBy("snapshot_id")
        )

    def schema_history(self, name: str) -> DataFrame:
        """Each schema the table has had: schema id, position, field id, name and type."""
        first_use = (
            self._life(name)
            .groupBy("schema_id")
            .agg(F.min_by("fields", "entry").alias("fields"))
        )
        return (
            first_use.select("schema_id", F.posexplode("fields").alias("ordinal", "field"))
            .select("schema_id", "ordinal", "field.field_id", "field.name", "field.type")
            .orderBy("schema_id", "ordinal")
        )

    def schema_info(self, names: list[str] | None = None) -> DataFrame:
        """Columns and types of the tables; a missing table gets one row with an error text."""
        last = log.read_log(self.spark, self.root).groupBy("table_name").agg(
            F.max_by(F.struct("operation", "fields"), "entry").alias("last")
        )
        known = (
            last.where("last.operation <> 'drop'")
            .select("table_name", F.posexplode("last.fields").alias("ordinal", "field"))
            .select(
                "table_name",
                (F.col("ordinal") + 1).alias("ordinal"),
                F.col("field.name").alias("column_name"),
                F.col("field.type").alias("data_type"),
            )
        )
        if names is None:
            return known.withColumn("error", F.lit(None).cast("string"))
        asked = self.spark.createDataFrame([(n,) for n in names], "table_name string")
        missing = F.concat(F.lit("Error: table "), "table_name", F.lit(" does not exist"))
        return asked.join(known, "table_name", "left").withColumn(
            "error", F.when(F.col("column_name").isNull(), missing)
        )

    def files(self, name: str, snapshot_id: int | None = None) -> DataFrame:
        """Data files with partition, size and commit. Lists directories, opens no file."""
        state = self.state(name, snapshot_id)
        return self._listing(state, state.folders.values()).drop("directory")

    def file_counts(self, name: str, snapshot_id: int | None = None) -> DataFrame:
        """Data files with partition, number of rows, size and path. Only footers are read."""
        state = self.state(name, snapshot_id)
        scan = self._scan(state, state.folders.values())
        part = F.lit(None).cast("date") if state.partition is None else F.col(state.partition.directory)
        meta = F.col("_metadata")
        return scan.select(
            part.alias("partition"), meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size")
        ).groupBy("partition", "file_path", "file_size").agg(F.count("*").alias("record_count"))

    def partition_stats(
        self, name: str, columns: list[str] | None = None, snapshot_id: int | None = None
    ) -> DataFrame:
        """Per partition: record_count, and least and largest value of `columns`, from footers alone.

        A column must have its present name in all visible commits: footers know no field ids.
        """
        state = self.state(name, snapshot_id)
        part = state.partition
        stored = [f for f in state.schema.fields if not self._names_its_directory(state, f)]
        for field in (f for f in stored if f.name in (columns or [])):
            for row in log.last_life(self._rows(name), name):
                if row["folder"] in state.folders.values() and not any(
                    f["name"] == field.name and f["field_id"] == field.metadata[FIELD_ID] for f in row["fields"]
                ):
                    raise ValueError(f"{name}.{field.name} has not been in all commits under this name")
        keys = [] if part is None else [T.StructField(part.directory, T.DateType())]
        schema = T.StructType([*stored, *keys, T.StructField(COMMIT, T.StringType())])
        paths = [f"{self._data(name)}/{folder}" for folder in state.folders.values()]
        stats = partition_stats(
            self.spark, paths, self._data(name), schema, [k.name for k in keys] + [COMMIT], columns
        )
        by = F.lit(None).cast("date") if part is None else F.col(part.directory)
        merged = [
            (F.min(f"least_{c}").alias(f"least_{c}"), F.max(f"largest_{c}").alias(f"largest_{c}")) for c in columns or []
        ]
        return stats.groupBy(by.alias("partition")).agg(
            F.sum("record_count").alias("record_count"), *[end for pair in merged for end in pair]
        )

    def pruning_report(
        self, name: str, low: DateLike, high: DateLike, snapshot_id: int | None = None
    ) -> DataFrame:
        """Partitions in the table, partitions a range touches, and rows in the range."""
        state = self.state(name, snapshot_id)
        if state.partition is None:
            raise ValueError(f"{name} is not partitioned")
        first = F.lit(low).cast("date")
        if state.partition.granularity == "month":
            first = F.trunc(first, "MM")
        part = F.col("partition")
        touched = (part >= first) & (part < F.lit(high).cast("timestamp_ntz"))
        rows = self.read(name, snapshot_id, between=(low, high))
        listing = self._listing(state, state.folders.values())
        directories = listing.select("directory", "partition").distinct()
        return directories.agg(
            F.count(F.lit(1)).alias("partitions_total"),
            F.count_if(touched).alias("partitions_matched"),
        ).withColumn("rows_matched", rows.agg(F.count(F.lit(1))).scalar())

    # -- internals --------------------------------------------------------

    def _data(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _rows(self, name: str, may_be_new: bool = False) -> list[Row]:
        return log.table_rows(self.spark, self.root, name, may_be_new)

    def _life(self, name: str) -> DataFrame:
        rows = log.last_life(self._rows(name), name)
        entries = log.read_log(self.spark, self.root, name)
        return entries.where(F.col("entry") >= rows[0]["entry"])

    def _log(
        self,
        rows: list[Row],
        name: str,
        operation: str,
        committed_at: dt.datetime | None,
        fields: list[dict[str, Any]],
        schema_id: int,
        partition: Partition | None,
        snapshot_id: int | None = None,
        parent_id: int | None = None,
        folder: str | None = None,
        summary: dict[str, str] | None = None,
    ) -> None:
        values = {
            "committed_at": committed_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            "operation": operation,
            "snapshot_id": snapshot_id,
            "parent_id": parent_id,
            "folder": folder,
            "schema_id": schema_id,
            "fields": fields,
            "partition": None if partition is None else asdict(partition),
            "summary": summary or {},
        }
        entry = rows[-1]["entry"] + 1 if rows else 1
        log.write_entry(self.spark, self.root, name, entry, values)

    def _alter(
        self,
        rows: list[Row],
        state: TableState,
        schema: T.StructType,
        committed_at: dt.datetime | None,
    ) -> None:
        self._log(
            rows,
            state.name,
            "alter",
            committed_at,
            log.encode_fields(schema),
            state.next_schema_id,
            state.partition,
        )

    def _partition_column(self, state: TableState) -> str:
        """The current name of the column the table is partitioned by."""
        return next(
            f.name
            for f in state.schema.fields
            if f.metadata[FIELD_ID] == state.partition.field_id
        )

    def _names_its_directory(self, state: TableState, field: T.StructField) -> bool:
        """True for a date that is stored only in the directory names."""
        part = state.partition
        return (
            part is not None
            and field.metadata[FIELD_ID] == part.field_id
            and part.granularity == "day"
            and isinstance(field.dataType, T.DateType)
        )

    def _commit(
        self, name: str, rows: DataFrame, operation: str, committed_at: dt.datetime | None
    ) -> int:
        entries = self._rows(name)
        return self._commit_to(entries, log.state_of(entries, name), rows, operation, committed_at)

    def _commit_to(
        self,
        entries: list[Row],
        state: TableState,
        rows: DataFrame,
        operation: str,
        committed_at: dt.datetime | None,
        extra: dict[str, str] | None = None,
    ) -> int:
        name = state.name
        if sorted(rows.columns) != sorted(state.schema.names):
            raise ValueError(
                f"{name} has the columns {state.schema.names}, the rows have {rows.columns}"
            )
        version = state.next_snapshot_id
        # `to` checks types and reorders. The ids go onto aliases on top of it: put on
        # by `to` itself, the optimizer drops them before the file is written.
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema.fields])
        conformed = rows.to(plain).select(
            *[F.col(f.name).alias(f.name, metadata=f.metadata) for f in state.schema.fields]
        )
        folder = f"{COMMIT}={version}-{uuid.uuid4().hex[:12]}"
        added = self._write(state, conformed, folder)
        totals = dict(state.totals) if operation == "append" else {}
        summary = {f"added-{key}": str(value) for key, value in added.items()}
        for key in ("records", "data-files", "files-size"):
            summary[f"total-{key}"] = str(totals.get(f"total-{key}", 0) + added[key])
        summary["changed-partition-count"] = summary.pop("added-partitions")
        summary |= extra or {}
        self._log(
            entries,
            name,
            operation,
            committed_at,
            log.encode_fields(state.schema),
            state.schema_id,
            state.partition,
            version,
            state.snapshot_id,
            folder,
            summary,
        )
        return version

    def _write(self, state: TableState, rows: DataFrame, folder: str) -> dict[str, int]:
        """Write the files of one commit and measure them."""
        part = state.partition
        if part is not None:
            column = self._partition_column(state)
            kind = state.schema[column].dataType.simpleString()
            rows = rows.withColumns({part.directory: partition_value(column, part.granularity, kind)})
            if part.directory != column and self._names_its_directory(state, state.schema[column]):
                rows = rows.drop(column)
            # One shuffle brings the rows of a day together. Adaptive execution cuts
            # days above the advisory size into several tasks, so a hot day neither
            # stalls the job nor lands in one file. Whether small shuffle partitions are
            # merged is the session's choice: a setting changed here would change it for
            # all queries that run meanwhile.
            rows = rows.hint("rebalance", part.directory)
        # Counted in the writing stage itself: no second pass, and a retried task counts once.
        counter = Observation(f"{state.name}-{folder}")
        counted = rows.observe(counter, F.count(F.lit(1)).alias("records"))
        writer = counted.write.mode("errorifexists").option("compression", "zstd")
        if part is not None:
            writer = writer.partitionBy(part.directory)
        writer.parquet(f"{self._data(state.name)}/{folder}")
        sizes = self._listing(state, [folder]).agg(
            F.count(F.lit(1)).alias("data_files"),
            F.coalesce(F.sum("file_size"), F.lit(0)).alias("files_size"),
            F.countDistinct("directory").alias("partitions"),
        ).first()
        return {
            "records": counter.get["records"],
            "data-files": sizes["data_files"],
            "files-size": sizes["files_size"],
            "partitions": sizes["partitions"],
        }

    def _scan(self, state: TableState, folders: Iterable[str]) -> DataFrame:
        """The rows of some commits in the table's schema, plus the hidden partition column."""
        part = state.partition
        stored, output = [], []
        hidden = part is not None
        for field in state.schema.fields:
            if self._names_its_directory(state, field):
                output.append(F.col(part.directory).alias(field.name))
                hidden = False
            else:
                stored.append(field)
                output.append(F.col(field.name))
        if part is not None:
            stored.append(T.StructField(part.directory, T.DateType()))
        if hidden:
            output.append(F.col(part.directory))
        schema = T.StructType([*stored, T.StructField(COMMIT, T.StringType())])
        paths = [f"{self._data(state.name)}/{folder}" for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema).select(*output)
        reader = self.spark.read.schema(schema).option("basePath", self._data(state.name))
        return reader.parquet(*paths).select(*output)

    def _listing(self, state: TableState, folders: Iterable[str]) -> DataFrame:
        """Files of some commits. The content is not selected, so none is opened."""
        paths = [f"{self._data(state.name)}/{folder}" for folder in folders]
        if not paths:
            nothing = "path string, length bigint"
            empty = F.from_json(F.lit("{}"), nothing)
            found = self.spark.range(0).select(empty.alias("f")).select("f.*")
        else:
            reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            found = reader.option("recursiveFileLookup", "true").load(paths)
        part = state.partition
        directory = (
            F.lit(None).cast("string")
            if part is None
            else F.regexp_extract("path", f"/{part.directory}=([^/]*)/", 1)
        )
        return found.select(
            F.col("path").alias("file_path"),
            directory.try_cast("date").alias("partition"),
            directory.alias("directory"),
            F.col("length").alias("file_size"),
            F.regexp_extract("path", f"/{COMMIT}=([0-9]+)-", 1).cast("bigint").alias("snapshot_id"),
        )
