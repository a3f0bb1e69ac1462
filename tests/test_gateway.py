from __future__ import annotations

import datetime as dt

import pytest

from salesloom.plans.gateway import (
    ReadOnlySql,
    ReadOnlyViolation,
    check_read_only,
    code_of,
    records,
)
from salesloom.plans.loading import STAGES, loaded
from salesloom.plans.questions import QUESTIONS, ask

ALLOWED = [
    "SELECT 1",
    "  select * from fact_sales limit 5 ;",
    "(SELECT 1) UNION ALL (SELECT 2)",
    "WITH x AS (SELECT 1 AS a) SELECT * FROM x",
    "SHOW TABLES IN local.db",
    "DESCRIBE local.db.fact_sales",
    "desc fact_sales",
    "SELECT ' drop ' AS word, \"delete\" AS other, `update` FROM t",
    "SELECT 1 -- drop the rest\n",
    "SELECT /* insert nothing */ 1",
    "SELECT dropped, created_at, called FROM t",
    "SELECT r'\\' AS raw, 1",
]
REFUSED = [
    "DROP TABLE local.db.fact_sales",
    "insert into t values (1)",
    "",
    "-- only a comment",
    "EXPLAIN SELECT 1",
    "SELECT 1; DROP TABLE t",
    "SELECT 1\nUNION ALL\nDELETE\nFROM t",
    "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x",
    "WITH x AS (SELECT 1)INSERT INTO t SELECT * FROM x",
    "with x as (select 1) merge into t using x on true when matched then delete",
    "SELECT * FROM t WHERE a = 'x' update",
    "SHOW CREATE TABLE t",
    "SELECT reflect('java.lang.System', 'exit', 0)",
    "SELECT java_method ('java.lang.System', 'lineSeparator')",
    "WITH x AS (SELECT r'\\' AS a) INSERT INTO t SELECT ' ' FROM x",
    "SELECT 'it''s' ; CALL something()",
    "SELECTED",
]


@pytest.mark.parametrize("sql", ALLOWED)
def test_reading_is_allowed(sql):
    check_read_only(sql)


@pytest.mark.parametrize("sql", REFUSED)
def test_everything_else_is_refused(sql):
    with pytest.raises(ReadOnlyViolation):
        check_read_only(sql)


def test_strings_and_comments_are_not_code():
    assert "drop" not in code_of("SELECT 'a \\' drop' , \"drop\", `drop`, r'drop\\' -- drop")
    assert "hint" in code_of("SELECT /*+ hint */ 1")


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return loaded(spark, sf_dir, "staged")


@pytest.fixture(scope="module")
def sql(lake):
    return ReadOnlySql(lake)


def test_the_grammar_admits_only_a_query(spark, sql):
    # Even past the word check, a write cannot stand where a subquery is expected.
    spark.sql("CREATE TABLE IF NOT EXISTS target (a INT) USING parquet")
    try:
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            sql._execute("WITH x AS (SELECT 1) INSERT INTO target SELECT * FROM x")
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            sql._execute("SELECT 1) x; DROP TABLE target; SELECT * FROM (SELECT 1")
        assert spark.table("target").count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS target")


@pytest.mark.parametrize(
    "statement",
    [
        "SELECT TRANSFORM(order_id) USING 'cat' AS (x STRING) FROM fact_sales",
        "SELECT * FROM (MAP order_id USING 'cat' AS (x) FROM fact_sales)",
        "SELECT * FROM text.`/etc/hostname`",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/part.parquet`",
        "SELECT (SELECT max(value) FROM text.`/etc/hostname`) AS a FROM fact_sales",
        "SELECT 1 WHERE 1 IN (SELECT 1 FROM nowhere)",
        "WITH x AS (SELECT TRANSFORM(order_id) USING 'cat' AS (y STRING) FROM fact_sales) SELECT * FROM x",
        "SELECT * FROM fact_sales, LATERAL (SELECT * FROM text.`/etc/hostname`)",
        "SELECT `reflect`('java.lang.System', 'lineSeparator')",
        "SELECT * FROM IDENTIFIER('x')",
        "SELECT * FROM sql_keywords()",
        "DESCRIBE FUNCTION reflect",
        "SHOW DATABASES",
        "SHOW TABLES IN default",
    ],
)
def test_only_tables_of_the_lake_are_read(sql, statement):
    with pytest.raises(ReadOnlyViolation):
        sql.run(statement)


def test_common_tables_and_subqueries_are_fine(sql):
    assert sql.run(
        "WITH a AS (SELECT order_id FROM fact_sales), b AS (SELECT * FROM a) SELECT count(*) FROM b "
        "WHERE order_id IN (SELECT order_id FROM a) AND EXISTS (SELECT 1 FROM dim_store)"
    ).first()[0] > 0
    assert sql.run("SELECT sum(id) AS s FROM range(4)").first()["s"] == 6


def test_quoted_names_and_listing_patterns(sql):
    n = sql.run("SELECT count(*) FROM fact_sales").first()[0]
    assert sql.run("SELECT count(*) FROM `local`.`db`.`fact_sales`").first()[0] == n
    assert sql.run("SELECT count(*) FROM local.db.`fact_sales`").first()[0] == n
    assert sql.run("SELECT '`fact_sales`' AS a").first()["a"] == "`fact_sales`"
    names = [r["tableName"] for r in sql.run("SHOW TABLES IN local.db LIKE 'dim_d*|fact*'").collect()]
    assert names == ["dim_date", "fact_sales"]


def test_files_have_their_number_of_rows(sql):
    rows = sql.run("SELECT partition, record_count, file_path FROM local.db.fact_sales.files ORDER BY partition")
    assert sum(r["record_count"] for r in rows.collect()) == sql.run("SELECT count(*) FROM fact_sales").first()[0]


def test_lakes_do_not_mix(spark):
    from salesloom.plans.session import work_dir
    from salesloom.tables.lake import Lake

    gates = []
    for value in (1, 2):
        lake = Lake(spark, work_dir(spark, "two"))
        lake.replace("fact_sales", spark.range(1).selectExpr(f"{value}L AS a"))
        gates.append(ReadOnlySql(lake))
    frames = [gate.run("SELECT a FROM fact_sales") for gate in gates] + [g.run_at(1, "SELECT a FROM fact_sales") for g in gates]
    assert [f.first()["a"] for f in frames] == [1, 2, 1, 2]
    gates[0].lake.append("fact_sales", spark.range(1).selectExpr("5L AS a"))
    assert frames[0].count() == 1 and gates[0].run("SELECT a FROM fact_sales").count() == 2


def test_errors_of_snapshot_queries_as_text(sql):
    assert "no snapshot 99" in sql.run_at_or_error(99, "SELECT 1 FROM fact_sales").error
    assert sql.run_at_or_error("x", "SELECT 1 FROM fact_sales").error
    assert sql.run_at_or_error(1, "SELECT nothing FROM fact_sales").error
    with pytest.raises(ReadOnlyViolation):
        sql.run_at_or_error(1, "DELETE FROM fact_sales")


def test_preview_and_order(sql):
    assert sql.run("SELECT * FROM local.db.fact_sales LIMIT 5").count() == 5
    rows = sql.run("SELECT order_id FROM fact_sales ORDER BY order_id DESC LIMIT 3").collect()
    assert [r[0] for r in rows] == sorted((r[0] for r in rows), reverse=True)


def test_qualified_columns_and_joins(sql):
    joined = sql.run(
        "SELECT fact_sales.order_id, local.db.dim_product.category FROM local.db.fact_sales "
        "JOIN local.db.dim_product ON fact_sales.product_id = dim_product.product_id"
    )
    assert joined.columns == ["order_id", "category"]
    assert joined.count() == sql.run("SELECT order_id FROM fact_sales").count()


def test_nonfinite_results_are_null(sql):
    row = sql.run("SELECT double('NaN') AS a, double('Infinity') AS b, 1 AS c").first()
    assert tuple(row) == (None, None, 1)


def test_versions_times_and_metadata(sql, lake):
    counts = [lake.read("fact_sales", v).count() for v in (1, 2, 3)]
    assert counts[0] < counts[1] < counts[2]
    one = "SELECT COUNT(*) AS n FROM local.db.fact_sales"
    assert sql.run(one).first()["n"] == counts[2]
    assert sql.run(f"{one} VERSION AS OF 1").first()["n"] == counts[0]
    assert sql.run(f"{one} VERSION AS OF 2 WHERE order_id >= 0").first()["n"] == counts[1]
    assert sql.run(f"{one} TIMESTAMP AS OF '2026-01-25'").first()["n"] == counts[1]
    both = sql.run(
        "SELECT (SELECT COUNT(*) FROM fact_sales) AS now, "
        "(SELECT COUNT(*) FROM fact_sales VERSION AS OF 1) AS then"
    ).first()
    assert tuple(both) == (counts[2], counts[0])
    assert sql.run("SELECT * FROM local.db.fact_sales.snapshots").count() == 3
    assert sql.run("SELECT file_path, partition FROM local.db.fact_sales.files").count() > 3
    assert "fact_sales VERSION" in sql.run("SELECT 'local.db.fact_sales VERSION AS OF 1' AS t").first()["t"]


def test_listing_and_describe(sql):
    names = [r["tableName"] for r in sql.run("show tables in local.db").collect()]
    assert names == ["dim_customer", "dim_date", "dim_product", "dim_store", "fact_sales"]
    described = {r["col_name"]: r["data_type"] for r in sql.run("DESCRIBE local.db.dim_date").collect()}
    assert described["date_key"] == "date" and described["month"] == "int"


def test_schema_text(sql):
    texts = sql.schema_text(["dim_store", "fact_sales", "nowhere"])
    assert texts["dim_store"] == [
        "store_id: bigint", "store_name: string", "location: string", "manager_name: string",
    ]
    assert texts["fact_sales"][-1] == "discount_applied: double"
    assert texts["nowhere"].startswith("Error: ")


def test_errors_become_text_but_refusals_raise(sql):
    outcome = sql.run_or_error("SELECT nothing FROM local.db.fact_sales")
    assert outcome.rows is None and outcome.error.startswith("The query failed: ")
    assert "VERSION" not in sql.run_or_error("SELECT 1 AS a").rows.columns
    missing = sql.run_or_error("SELECT * FROM fact_sales VERSION AS OF 99")
    assert "no snapshot 99" in missing.error
    with pytest.raises(ReadOnlyViolation):
        sql.run_or_error("DROP TABLE local.db.fact_sales")


def test_streamed_rows_end_with_the_error(sql):
    assert list(sql.stream("SELECT 1 AS a")) == [{"a": 1}]
    (unknown,) = sql.stream("SELECT nothing FROM fact_sales")
    assert unknown["error"].startswith("The query failed: ")
    late = list(sql.stream("SELECT 1 DIV (order_id - order_id) AS a FROM fact_sales"))
    assert "DIVIDE_BY_ZERO" in late[-1]["error"]


def test_snapshot_queries(sql, lake):
    old = lake.read("fact_sales", 1).count()
    for name in ("local.db.fact_sales", "fact_sales", "historical_data", "HISTORICAL_DATA"):
        assert sql.run_at("1", f"SELECT COUNT(*) AS n FROM {name}").first()["n"] == old
    mixed = sql.run_at(
        1,
        "SELECT COUNT(*) AS n, 'fact_sales' AS label FROM historical_data h "
        "JOIN dim_product p ON p.product_id = h.product_id",
    ).first()
    assert tuple(mixed) == (old, "fact_sales")
    with pytest.raises(ReadOnlyViolation):
        sql.run_at(1, "DELETE FROM historical_data")
    # A snapshot view keeps its meaning when another snapshot is queried.
    first, second = (sql.run_at(v, "SELECT COUNT(*) AS n FROM fact_sales") for v in (1, 2))
    assert first.first()["n"] == old and second.first()["n"] > old
    products = sql.run_at(1, "SELECT COUNT(*) AS n FROM historical_data", table="dim_product")
    assert products.first()["n"] == lake.read("dim_product").count()


def test_records_are_plain_dictionaries(sql):
    rows = list(records(sql.run("SELECT 1 AS a, named_struct('x', array(1, 2)) AS s")))
    assert rows == [{"a": 1, "s": {"x": [1, 2]}}]


ARGUMENTS = {
    "top_products_last_month": {"anchor": dt.date(2001, 8, 1)},
    "orders_last_weekend": {"anchor": dt.date(2001, 8, 1)},
    "orders_now_vs_then": {"snapshot_id": 1},
    "orders_days_ago": {"now": STAGES[2][2]},
}


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_every_question_is_answered_from_its_tables(lake, name):
    answer = ask(lake, name, **ARGUMENTS.get(name, {}))
    assert answer.rows.count() >= (0 if name == "customers_without_sales" else 1)
    assert answer.source.startswith(("fact_sales", "fact_sales.snapshots"))


def test_questions_check_their_arguments(lake):
    with pytest.raises(KeyError):
        ask(lake, "weather")
    with pytest.raises(TypeError):
        ask(lake, "top_products", limit="5; DROP TABLE x")
    with pytest.raises(TypeError):
        ask(lake, "orders_last_weekend")
    with pytest.raises(TypeError):
        ask(lake, "total_orders", limit=3)
    assert ask(lake, "orders_now_vs_then", snapshot_id=2).source.endswith("snapshot 2)")
