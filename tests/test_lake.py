from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom.operators.compare import row_changes
from salesloom.operators.partitions import files_report
from salesloom.plans.session import session_conf
from salesloom.tables.log import SnapshotNotFound, TableNotFound

SALES = "order_id bigint, order_date date, total_amount double"
D1, D2, D3 = dt.date(2026, 1, 5), dt.date(2026, 1, 6), dt.date(2026, 2, 1)
T1, T2, T3 = (dt.datetime(2026, 3, day) for day in (1, 2, 3))


def rows(spark, *values, ddl=SALES):
    return spark.createDataFrame(list(values), ddl)


def ids(df, column="order_id"):
    return sorted(r[column] for r in df.collect())


@pytest.fixture()
def sales(spark, lake):
    lake.create("sales", SALES, "order_date")
    lake.append("sales", rows(spark, (1, D1, 10.0), (2, D1, 20.0), (3, D2, 30.0)), T1)
    return lake


def test_snapshots_chain_and_count(spark, sales):
    sales.append("sales", rows(spark, (4, D3, 40.0)), T2)
    sales.overwrite("sales", rows(spark, (5, D3, 50.0)), T3)
    history = sales.snapshots("sales").collect()
    assert [(r["snapshot_id"], r["parent_id"], r["operation"]) for r in history] == [
        (1, None, "append"), (2, 1, "append"), (3, 2, "overwrite"),
    ]
    assert [r["summary"]["added-records"] for r in history] == ["3", "1", "1"]
    assert [r["summary"]["total-records"] for r in history] == ["3", "4", "1"]
    assert [r["summary"]["changed-partition-count"] for r in history] == ["2", "1", "1"]
    assert [ids(sales.read("sales", v)) for v in (1, 2, 3)] == [[1, 2, 3], [1, 2, 3, 4], [5]]
    assert ids(sales.read("sales")) == [5]


def test_reads_as_of_a_time(spark, sales):
    sales.append("sales", rows(spark, (4, D3, 40.0)), T3)
    assert ids(sales.read("sales", as_of=T1)) == [1, 2, 3]
    assert ids(sales.read("sales", as_of=T2)) == [1, 2, 3]
    assert ids(sales.read("sales", as_of=T3)) == [1, 2, 3, 4]
    with pytest.raises(SnapshotNotFound):
        sales.read("sales", as_of=T1 - dt.timedelta(seconds=1))
    with pytest.raises(SnapshotNotFound):
        sales.read("sales", snapshot_id=77)
    with pytest.raises(ValueError):
        sales.read("sales", snapshot_id=1, as_of=T1)


def test_files_without_a_log_row_are_invisible(spark, sales):
    orphan = f"{sales.root}/sales/commit=2-left-by-a-crash"
    rows(spark, (99, D1, 1.0)).write.partitionBy("order_date").parquet(orphan)
    assert ids(sales.read("sales")) == [1, 2, 3]
    assert sales.append("sales", rows(spark, (4, D3, 40.0))) == 2
    assert ids(sales.read("sales")) == [1, 2, 3, 4]


def test_a_second_writer_fails_and_harms_nothing(spark, sales, monkeypatch):
    from salesloom.tables import log

    before = log.table_rows(spark, sales.root, "sales")
    sales.append("sales", rows(spark, (4, D3, 40.0)))
    monkeypatch.setattr(sales, "_rows", lambda name: before)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sales.append("sales", rows(spark, (5, D3, 50.0)))
    monkeypatch.undo()
    assert ids(sales.read("sales")) == [1, 2, 3, 4]


def test_commit_times_keep_their_microseconds(spark, sales):
    at = dt.datetime(2026, 3, 2, 7, 8, 9, 123456)
    sales.append("sales", rows(spark, (4, D3, 40.0)), at)
    assert sales.snapshots("sales").collect()[-1]["committed_at"] == at
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    sales.append("sales", rows(spark, (5, D3, 40.0)))
    assert sales.snapshots("sales").collect()[-1]["committed_at"] >= before


def test_added_column_is_null_before_and_absent_from_old_snapshots(spark, sales):
    sales.add_column("sales", "discount", "double")
    assert [r["discount"] for r in sales.read("sales").collect()] == [None] * 3
    assert len(sales.snapshots("sales").collect()) == 1
    sales.insert("sales", 9, D3, 90.0, 1.5)
    now = {r["order_id"]: r["discount"] for r in sales.read("sales").collect()}
    assert now == {1: None, 2: None, 3: None, 9: 1.5}
    assert sales.read("sales", 1).columns == ["order_id", "order_date", "total_amount"]
    history = [
        (r["schema_id"], r["field_id"], r["name"]) for r in sales.schema_history("sales").collect()
    ]
    assert history == [
        (0, 1, "order_id"), (0, 2, "order_date"), (0, 3, "total_amount"),
        (1, 1, "order_id"), (1, 2, "order_date"), (1, 3, "total_amount"), (1, 4, "discount"),
    ]


def test_renamed_columns_are_found_by_field_id(spark, sales):
    sales.rename_column("sales", "total_amount", "amount")
    sales.rename_column("sales", "order_date", "sold_on")
    sales.append(
        "sales", rows(spark, (4, D3, 40.0), ddl="order_id bigint, sold_on date, amount double")
    )
    now = sales.read("sales")
    assert now.columns == ["order_id", "sold_on", "amount"]
    assert sorted((r["sold_on"], r["amount"]) for r in now.collect()) == [
        (D1, 10.0), (D1, 20.0), (D2, 30.0), (D3, 40.0),
    ]
    assert sales.read("sales", 1).columns == ["order_id", "order_date", "total_amount"]
    assert ids(sales.read("sales", between=("2026-01-06", "2026-02-02"))) == [3, 4]
    # The old name is free again and must not pick up the old values.
    sales.add_column("sales", "total_amount", "double")
    assert [r["total_amount"] for r in sales.read("sales").collect()] == [None] * 4


def test_writes_are_checked(spark, sales):
    with pytest.raises(ValueError, match="3 columns"):
        sales.insert("sales", 9, D3)
    with pytest.raises(Exception):
        sales.insert("sales", "nine", D3, 1.0)
    with pytest.raises(ValueError, match="columns"):
        sales.append("sales", rows(spark, (4, D3), ddl="order_id bigint, order_date date"))
    with pytest.raises(ValueError, match="columns"):
        sales.append("sales", rows(spark, (4, D3, 1.0, 2), ddl=f"{SALES}, extra int"))
    with pytest.raises(Exception):
        bad = "order_id bigint, order_date date, total_amount string"
        sales.append("sales", rows(spark, (4, D3, "much"), ddl=bad))
    reordered = rows(spark, (40.0, 4, D3), ddl="total_amount double, order_id int, order_date date")
    sales.append("sales", reordered)
    assert ids(sales.read("sales")) == [1, 2, 3, 4]


def test_create_drop_and_replace(spark, sales):
    with pytest.raises(ValueError):
        sales.create("sales", SALES)
    sales.create("sales", SALES, if_not_exists=True)
    assert ids(sales.read("sales")) == [1, 2, 3]
    sales.drop("sales")
    with pytest.raises(TableNotFound):
        sales.read("sales")
    with pytest.raises(TableNotFound):
        sales.drop("sales")
    sales.drop("sales", if_exists=True)
    assert sales.tables().count() == 0
    sales.replace("sales", rows(spark, (7, D1, 1.0)))
    assert ids(sales.read("sales")) == [7]
    assert len(sales.snapshots("sales").collect()) == 1
    with pytest.raises(SnapshotNotFound):
        sales.read("sales", snapshot_id=1)
    sales.replace("sales", rows(spark, (8,), ddl="order_id bigint"))
    assert ids(sales.read("sales")) == [8] and sales.read("sales").columns == ["order_id"]


def test_empty_tables_and_commits(spark, lake):
    lake.create("sales", SALES, "order_date")
    assert lake.read("sales").count() == 0 and lake.files("sales").count() == 0
    lake.append("sales", rows(spark, (1, D1, 1.0)).limit(0))
    assert lake.read("sales").count() == 0
    assert lake.snapshots("sales").first()["summary"]["total-records"] == "0"
    lake.append("sales", rows(spark, (1, None, 1.0), (2, D1, None)))
    assert {(r["order_id"], r["order_date"]) for r in lake.read("sales").collect()} == {
        (1, None), (2, D1),
    }


def test_only_added_rows_are_read(spark, sales):
    sales.append("sales", rows(spark, (4, D3, 40.0)))
    sales.append("sales", rows(spark, (5, D3, 50.0)))
    added = sales.added_since("sales", 1)
    assert ids(added) == [4, 5]
    assert ids(sales.added_since("sales", 1, 2)) == [4]
    assert all("/commit=1-" not in f for f in added.inputFiles())
    sales.overwrite("sales", rows(spark, (6, D3, 60.0)))
    with pytest.raises(ValueError, match="overwritten"):
        sales.added_since("sales", 1)


def test_row_changes_count_copies(spark):
    old = rows(spark, (1, D1, 1.0), (1, D1, 1.0), (2, D1, 2.0), (3, D1, None))
    new = rows(spark, (1, D1, 1.0), (2, D1, 2.0), (4, D1, 4.0), (4, D1, 4.0), (3, D1, None))
    changes = {(r["order_id"], r["copies"]) for r in row_changes(new, old).collect()}
    assert changes == {(1, -1), (4, 2)}


def test_listing_and_schema(spark, sales):
    sales.replace("other", rows(spark, ("x",), ddl="name string"))
    assert [(r["namespace"], r["tableName"]) for r in sales.tables().collect()] == [
        ("db", "other"), ("db", "sales"),
    ]
    info = sales.schema_info(["sales", "nowhere"]).collect()
    assert {(r["table_name"], r["ordinal"], r["column_name"], r["data_type"]) for r in info} == {
        ("sales", 1, "order_id", "bigint"),
        ("sales", 2, "order_date", "date"),
        ("sales", 3, "total_amount", "double"),
        ("nowhere", None, None, None),
    }
    assert [r["error"] for r in info if r["table_name"] == "nowhere"] == [
        "Error: table nowhere does not exist"
    ]


def files_read(df) -> int:
    df = df.select("*")  # a plan reports its files on the first run only
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = [plan]
    while scans:
        node = scans.pop()
        if node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numFiles").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            scans.append(node.executedPlan())
            continue
        children = node.children()
        scans += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no scan in the plan")


@pytest.mark.parametrize("day", ["2026-01-06", D2])
def test_a_plain_filter_on_the_date_skips_files(spark, sales, day):
    hit = sales.read("sales").where(F.col("order_date") == day)
    assert ids(hit) == [3]
    assert files_read(hit) == 1
    assert files_read(sales.read("sales")) == 2
    assert "PartitionFilters: [isnotnull(order_date" in hit._jdf.queryExecution().toString()


@pytest.mark.parametrize("granularity", ["day", "month"])
def test_ranges_on_timestamps_skip_files(spark, lake, granularity):
    stamps = [dt.datetime(2026, m, d, h) for m in (1, 2, 3) for d in (1, 2) for h in (0, 23)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "id bigint, ts timestamp_ntz")
    lake.create("events", frame.schema, "ts", granularity)
    lake.append("events", frame)
    assert lake.read("events").columns == ["id", "ts"]
    low, high = "2026-02-01 12:00:00", "2026-02-02 00:30:00"
    hit = lake.read("events", between=(low, high))
    assert hit.columns == ["id", "ts"]
    assert ids(hit, "id") == [5, 6]
    assert files_read(hit) == (2 if granularity == "day" else 1)
    report = lake.pruning_report("events", low, high).first()
    assert tuple(report) == ((6, 2, 2) if granularity == "day" else (3, 1, 2))


def test_ranges_without_partitions(spark, lake):
    lake.replace("plain", rows(spark, (1, D1, 10.0), (2, D2, 20.0)))
    with pytest.raises(ValueError, match="not partitioned"):
        lake.read("plain", between=("2026-01-06", "2026-01-07"))
    assert ids(lake.read("plain", between=("2026-01-06", "2026-01-07"), on="order_date")) == [2]


def test_files_report_counts_rows(spark, sales):
    report = files_report(sales.scan_with_files("sales"), "order_date").collect()
    assert {(r["partition"], r["record_count"]) for r in report} == {(D1, 2), (D2, 1)}
    assert {r["file_path"].split("/")[-2] for r in report} == {
        "order_date=2026-01-05", "order_date=2026-01-06",
    }
    listing = sales.files("sales").collect()
    assert {r["partition"] for r in listing} == {D1, D2}
    assert all(r["file_size"] > 0 and r["snapshot_id"] == 1 for r in listing)


def test_a_hot_day_is_split_and_kept_whole(spark, lake):
    hot = F.when(F.col("id") % 3 == 0, F.lit(D1)).otherwise(
        F.date_add(F.lit(D2), (F.col("id") % 40).cast("int"))
    )
    frame = spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("order_id"), hot.alias("order_date"), F.rand(1).alias("total_amount")
    )
    lake.create("sales", SALES, "order_date")
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="256k"):
        lake.append("sales", frame)
    files = {
        r["partition"]: r["count"] for r in lake.files("sales").groupBy("partition").count().collect()
    }
    assert files[D1] > 1
    assert lake.read("sales").count() == 300_000
    assert lake.read("sales").where(F.col("order_date") == D1).count() == 100_000
    assert lake.snapshots("sales").first()["summary"]["added-records"] == "300000"
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_a_lost_attempt_does_not_block_the_log(spark, sales, tmp_path):
    from pathlib import Path

    from salesloom.tables import log

    entry = log.table_rows(spark, sales.root, "sales")[-1]["entry"] + 1
    Path(f"{sales.root}/_log/table_name=sales/entry={entry}/attempt=lost/_temporary/0").mkdir(parents=True)
    sales.append("sales", rows(spark, (4, D3, 40.0)))
    assert ids(sales.read("sales")) == [1, 2, 3, 4]


def test_a_failed_replace_keeps_the_table(spark, sales):
    failing = rows(spark, (4, D3, 40.0)).withColumn("order_id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        sales.replace("sales", failing)
    assert ids(sales.read("sales")) == [1, 2, 3]
    sales.replace("sales", rows(spark, (7, D3, 40.0)))
    assert ids(sales.read("sales")) == [7] and sales.snapshots("sales").count() == 1


def test_changes_read_only_what_differs(spark, sales):
    before = sales.state("sales").snapshot_id
    sales.append("sales", rows(spark, (4, D3, 40.0)))
    found = sales.changes("sales", before)
    assert [(r["order_id"], r["copies"]) for r in found.collect()] == [(4, 1)]
    old = set(sales.read("sales", before).inputFiles())
    assert not old & set(found.inputFiles())


@pytest.mark.parametrize("granularity", ["day", "month"])
def test_timestamp_partitions_do_not_follow_the_session_zone(spark, lake, granularity):
    from salesloom.plans.session import session_conf

    moments = [f"2024-03-{d:02d}T{h:02d}:30:00Z" for d in (1, 15, 31) for h in (0, 5, 12, 23)]
    frame = spark.createDataFrame([(m,) for m in moments], "m string").select(F.to_timestamp("m").alias("at"))
    for n, writer in enumerate(("UTC", "Asia/Tokyo", "America/Los_Angeles")):
        with session_conf(spark, spark__sql__session__timeZone=writer):
            lake.replace(f"t{n}", frame, "at", granularity)
        for reader in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            with session_conf(spark, spark__sql__session__timeZone=reader):
                found = lake.read(f"t{n}", between=("2024-03-15T05:00:00Z", "2024-03-31T23:00:00Z"))
                assert found.count() == 6
