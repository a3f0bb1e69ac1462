from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesloom.operators import generate, quality
from salesloom.plans.session import session_conf, work_dir
from salesloom.schema import DIM_DATE, DIM_PRODUCT, FACT_SALES, LOAD_ORDER, TABLES
from salesloom.sources import records
from salesloom.sources.csv import read_strings, read_table, write_csv
from salesloom.sources.refresh import JdbcSink, LakeSink, refresh_all


def text_file(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content)
    return str(path)


def test_typed_csv(spark, tmp_path):
    path = text_file(
        tmp_path,
        "p.csv",
        "category,product_id,extra,price,product_name\n"
        'Toys,1,x,9.50,"Lamp, ""big"""\n'
        "Toys,one,x,cheap,\n"
        ",3,,,Kettle\n",
    )
    typed = read_table(spark, path, DIM_PRODUCT)
    assert typed.schema.simpleString() == (
        "struct<product_id:bigint,product_name:string,category:string,price:double>"
    )
    assert [tuple(r) for r in typed.collect()] == [
        (1, 'Lamp, "big"', "Toys", 9.5),
        (None, None, "Toys", None),
        (3, "Kettle", None, None),
    ]
    strings = read_strings(spark, path)
    rejects = {r["column_name"]: r["rejects"] for r in quality.cast_rejects(strings, DIM_PRODUCT).collect()}
    assert rejects == {"product_id": 1, "product_name": 0, "category": 0, "price": 1}
    bad = quality.rejected_rows(strings, DIM_PRODUCT).collect()
    assert [r["rejected_columns"] for r in bad] == [["product_id", "price"]]
    with pytest.raises(ValueError, match="date_key"):
        read_table(spark, path, DIM_DATE)


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    text_file(folder, "a.csv", "a,b\n1,2\n")
    text_file(folder, "b.csv", "b,a\n2,1\n")
    with pytest.raises(Exception):
        read_strings(spark, str(folder)).collect()


def test_csv_export_round_trip(spark):
    frame = spark.createDataFrame(
        [(1, 'a "b", c', None, 0.1), (2, None, "x\\y", 1e-9)],
        "product_id bigint, product_name string, category string, price double",
    )
    path = work_dir(spark, "csv")
    write_csv(frame, path)
    back = read_table(spark, path, DIM_PRODUCT)
    assert sorted(back.collect()) == sorted(frame.collect())


def generated(spark):
    return generate.star_schema(spark, 20, 5, 3, 300)


def test_default_sizes(spark):
    sizes = {name: df.count() for name, df in generate.star_schema(spark).items()}
    assert sizes == {
        "dim_customer": 100, "dim_product": 20, "dim_store": 5, "dim_date": 365, "fact_sales": 1000,
    }


def test_refresh_loads_parents_first_and_replaces(spark, lake):
    frames = generated(spark)
    for _ in range(2):
        loaded = []
        refresh_all(frames, LakeSink(lake, {"fact_sales": ("order_date", "month")}), loaded.append)
        assert loaded == [t.name for t in LOAD_ORDER] and loaded[-1] == "fact_sales"
    for name, df in frames.items():
        assert lake.read(name).count() == df.count()
        assert lake.read(name).schema.simpleString() == TABLES[name].schema.simpleString()
    orphans = quality.fk_report(
        lake.read("fact_sales"), {n: lake.read(n) for n in frames if n != "fact_sales"}, FACT_SALES
    ).collect()
    assert len(orphans) == 4 and all(r["orphan_rows"] == 0 for r in orphans)


class Recorder:
    """Stands in for a DataFrame and notes the writes asked of it."""

    def __init__(self, name, calls, limited=False):
        self.name, self.calls, self.limited = name, calls, limited

    def limit(self, n):
        assert n == 0
        return Recorder(self.name, self.calls, True)

    @property
    def write(self):
        return self

    def jdbc(self, url, table, mode, properties):
        assert table == self.name and url == "jdbc:x"
        self.calls.append((table, mode, "no rows" if self.limited else "rows", properties))


def test_database_refresh_clears_the_child_first():
    calls = []
    frames = {t.name: Recorder(t.name, calls) for t in LOAD_ORDER}
    refresh_all(frames, JdbcSink("jdbc:x", {"user": "u"}))
    names = [t.name for t in LOAD_ORDER]
    assert [c[0] for c in calls] == names[::-1] + names
    assert all(c[1:3] == ("overwrite", "no rows") for c in calls[:5])
    assert all(c[3]["truncate"] == "true" for c in calls[:5])
    assert all(c[1:3] == ("append", "rows") for c in calls[5:])


def test_generated_rows_are_repeatable_and_within_bounds(spark):
    first, second = generated(spark), generated(spark)
    for name in first:
        one = first[name].collect()
        assert sorted(one) == sorted(second[name].repartition(3).collect())
        assert first[name].schema.simpleString() == TABLES[name].schema.simpleString()
        assert quality.pk_violations(first[name], TABLES[name].primary_key).count() == 0
    for sale in first["fact_sales"].collect():
        assert 1 <= sale["quantity"] <= 5
        assert 10 <= sale["total_amount"] / sale["quantity"] <= 500
        assert dt.date(2026, 1, 1) <= sale["order_date"] <= dt.date(2026, 12, 31)
    days = [r["date_key"] for r in first["dim_date"].collect()]
    assert len(days) == 365 and min(days) == dt.date(2026, 1, 1) and max(days) == dt.date(2026, 12, 31)
    assert all(
        (r["day"], r["month"], r["year"], r["day_of_week"])
        == (r["date_key"].day, r["date_key"].month, r["date_key"].year, f"{r['date_key']:%A}")
        for r in first["dim_date"].collect()
    )


def test_hash_stays_in_range_for_any_id(spark):
    ids = [0, 1, -1, 2**31, 2**62, -(2**63), 2**63 - 1]
    frame = spark.createDataFrame([(i,) for i in ids], "id bigint")
    values = [r[0] for r in frame.select(generate.hashed(F.col("id"), 3, 7)).collect()]
    assert all(0 <= v < 7 for v in values)
    spread = spark.range(7000).groupBy(generate.hashed(F.col("id"), 2, 7)).count().collect()
    assert len(spread) == 7 and all(800 < r["count"] < 1200 for r in spread)


def test_key_checks_find_what_is_planted(spark):
    fact = spark.createDataFrame(
        [(1, 10), (1, 10), (2, 99), (None, None), (3, 99), (4, 10)], "order_id bigint, customer_id bigint"
    )
    dim = spark.createDataFrame([(10,), (11,)], "customer_id bigint")
    found = {(r["key_value"], r["row_count"]) for r in quality.pk_violations(fact, "order_id").collect()}
    assert found == {(1, 2), (None, 1)}
    summary = quality.pk_summary(fact, "order_id", "fact").first()
    assert tuple(summary) == ("fact", 1, 2, 1)
    orphans = quality.fk_orphans(fact, "customer_id", dim, "customer_id").collect()
    assert [tuple(r) for r in orphans] == [(99, 2)]


def test_foreign_keys_keep_their_types_and_read_the_fact_once(spark):
    day = dt.date(2026, 1, 5)
    rows = [(1, day, 10, 5, 1, 1, 1.0), (2, day, 99, 5, None, 1, 1.0), (3, None, 99, 6, 2, 1, 1.0), (4, dt.date(2027, 1, 1), None, 5, 1, 1, 1.0)]
    fact = spark.createDataFrame(rows, FACT_SALES.schema)
    dims = {
        "dim_customer": spark.createDataFrame([(10,)], "customer_id bigint"),
        "dim_product": spark.createDataFrame([(5,)], "product_id int"),
        "dim_store": spark.createDataFrame([(1,), (2,)], "store_id bigint"),
        "dim_date": spark.createDataFrame([(day,)], "date_key date"),
    }
    found = {r.fact_key: (r.dimension, r.orphan_keys, r.orphan_rows) for r in quality.fk_report(fact, dims, FACT_SALES).collect()}
    assert found == {
        "order_date": ("dim_date", 1, 1), "customer_id": ("dim_customer", 1, 2),
        "product_id": ("dim_product", 1, 1), "store_id": ("dim_store", 0, 0),
    }
    assert quality.fk_report(fact.limit(0), dims, FACT_SALES).agg(F.sum("orphan_rows")).first()[0] == 0


def test_a_load_writes_values_and_rejects_in_one_pass(spark, tmp_path):
    path = text_file(tmp_path, "p.csv", "product_id,product_name,category,price,more\n1,a,b,1.5,x\none,c,,cheap,y\n,d,e,2,z\n3,,,nope,\n")
    strings = read_strings(spark, path)
    rows, rejects, counts = quality.load_with_rejects(strings, DIM_PRODUCT, work_dir(spark, "one-pass"))
    key = lambda r: [(v is not None, v) for v in r]
    assert rows.schema.simpleString() == DIM_PRODUCT.schema.simpleString()
    assert sorted(rows.collect(), key=key) == sorted(read_table(spark, path, DIM_PRODUCT).collect(), key=key)
    assert sorted(tuple(r) for r in rejects.collect()) == [
        ("3", None, None, "nope", None, ["price"]), ("one", "c", None, "cheap", "y", ["product_id", "price"])
    ]
    assert {r.column_name: r.rejects for r in counts.collect()} == {"product_id": 1, "product_name": 0, "category": 0, "price": 2}
    assert sorted(counts.collect()) == sorted(quality.cast_rejects(strings, DIM_PRODUCT).collect())
    # One parse a column: the plan casts each text once.
    with session_conf(spark, spark__sql__debug__maxToStringFields="500"):
        plan = quality.rejected_rows(strings, DIM_PRODUCT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(price") == plan.count("try_cast(price") == 1
    with pytest.raises(ValueError, match="missing"):
        quality.load_with_rejects(strings.drop("price"), DIM_PRODUCT, work_dir(spark, "one-pass"))


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)


def test_exported_texts_come_back_as_they_were(spark):
    texts = ["  lead", "tail  ", "", None, "two\nlines", 'say "hi", ok', "a\r\nb", "a\rb", 'back\\slash\\"', "\t", '"', "\\N"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    path = work_dir(spark, "csv-exact")
    write_csv(frame, path)
    back = read_strings(spark, path, exported=True).collect()
    assert sorted((int(r["id"]), r["t"]) for r in back) == list(enumerate(texts))


ODD_TEXTS = ["  lead", "tail  ", "", None, "two\nlines", 'say "hi", ok', "a\r\nb", "a\rb", 'back\\slash\\"', "\t", '"', "\\N"]
ODD_TEXTS += ["\n\n\n", '"\n"', "x\n", "\ny", 'é"\n"中', "id,t", "plain"]


@pytest.fixture()
def small_blocks(spark):
    """Files cut into blocks of few bytes, so that records lie across them."""

    def cut(size: str):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["40", "333", "4000", "128m"])
def test_records_are_found_block_by_block(spark, small_blocks, size):
    chance = random.Random(1)
    rows = [(k, chance.choice(ODD_TEXTS), chance.choice(ODD_TEXTS)) for k in range(300)]
    rows += [(300, "long\n" * 200, '"\n' * 100)]
    frame = spark.createDataFrame(rows, "id int, t string, first0 string")
    path = work_dir(spark, "csv-blocks-test")
    write_csv(frame.coalesce(2), path)
    small_blocks(size)
    back = read_strings(spark, path, exported=True, split_from=0)
    if size != "128m":
        assert back.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    assert sorted((int(r.id), r.t, r.first0) for r in back.collect()) == sorted(rows)


def test_records_that_never_cross_need_no_survey_of_quotes(spark, small_blocks, tmp_path):
    text_file(tmp_path, "plain.csv", "id,t\n" + "".join(f'{k},"a ""b"" {k}"\n' for k in range(200)))
    small_blocks("100")
    known = records.survey(spark, str(tmp_path / "plain.csv"))
    assert not known.broken and not known.crossing
    back = read_strings(spark, str(tmp_path / "plain.csv"), exported=True, split_from=0)
    assert "MapInArrow" not in back._jdf.queryExecution().executedPlan().toString()
    assert sorted((int(r.id), r.t) for r in back.collect()) == [(k, f'a "b" {k}') for k in range(200)]


def test_a_survey_of_other_blocks_is_refused(spark, small_blocks):
    frame = spark.createDataFrame([(k, "two\nlines") for k in range(100)], "id int, t string")
    path = work_dir(spark, "csv-cut")
    write_csv(frame, path)
    small_blocks("60")
    back = read_strings(spark, path, exported=True, split_from=0)
    small_blocks("45")
    with pytest.raises(Exception, match="other blocks"):
        back.collect()


def test_a_header_that_differs_is_refused_block_by_block(spark, small_blocks, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    text_file(folder, "a.csv", 'a,b\n1,"x\ny"\n')
    text_file(folder, "b.csv", 'b,a\n1,"x\ny"\n')
    with pytest.raises(Exception, match="header"):
        read_strings(spark, str(folder), exported=True, split_from=0).collect()


def test_an_open_field_ends_with_its_file(spark, small_blocks, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    text_file(folder, "a.csv", 'a,b\n1,"x\ny\nz')
    text_file(folder, "b.csv", 'a,b\n2,"v\nw"\n')
    small_blocks("5")
    back = read_strings(spark, str(folder), exported=True, split_from=0)
    assert sorted((r.a, r.b.strip('"')) for r in back.collect()) == [("1", "x\ny\nz"), ("2", "v\nw")]


def test_an_export_is_many_files(spark):
    frame = spark.range(0, 1000, 1, 1).selectExpr("id", "'x' AS t")
    path = work_dir(spark, "csv-many")
    write_csv(frame, path, rows_per_file=100)
    assert len(spark.read.text(path).inputFiles()) >= 10
    assert read_strings(spark, path, exported=True).count() == 1000


def test_star_views_of_odd_names(spark, tmp_path):
    from salesloom.sources.star_views import StarViews

    tables = {
        "customer": ("c_custkey long, c_name string", [(1, "Customer#1"), (2, "Nameless"), (3, None)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey long", [(1, "S", 1), (2, "T", None)]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(1, "N", 9)]),
        "region": ("r_regionkey long, r_name string", [(1, "R")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    views = StarViews(spark, str(tmp_path))
    names = {r["customer_id"]: (r["first_name"], r["last_name"]) for r in views.customer().collect()}
    assert names == {1: ("Customer", "1"), 2: ("Nameless", ""), 3: (None, None)}
    assert {r["manager_name"] for r in views.store().collect()} == {None}


def test_generated_keys_reach_large_bounds(spark):
    ids = spark.range(200_000)
    big = ids.select(generate.hashed(F.col("id"), 2, 10**8).alias("k")).agg(F.max("k"), F.min("k")).first()
    assert 99_900_000 < big[0] < 10**8 and big[1] < 100_000
    two = spark.range(2).select((F.col("id") * 2**31).alias("id"))
    assert two.select(generate.hashed(F.col("id"), 1, 2**40)).distinct().count() == 2
