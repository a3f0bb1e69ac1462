"""Run queries next to their SQL and compare rows, column names and types.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(kinds):
        return [f"columns {names} vs {sorted(kinds)}"]
    problems = []
    for field in df.schema.fields:
        want = SAME_TYPE.get(field.dataType.simpleString())
        if want != kinds[field.name]:
            problems.append(f"{field.name}: {field.dataType.simpleString()} vs {kinds[field.name]}")
    order = [list(kinds).index(n) for n in names]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in expected)
    ours = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    if ours != theirs:
        problems.append(
            f"{sum(ours.values())} rows vs {sum(theirs.values())}; "
            f"only here {list((ours - theirs).items())[:3]}, "
            f"only there {list((theirs - ours).items())[:3]}"
        )
    return problems


def main(folder: str, chosen: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    sql = contract.oracle_sql()
    for name, run in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                problems = differences(df, con, sql[name])
            else:
                problems = [] if df.count() >= 0 else ["no rows"]
        except Exception as error:  # a broken query must not hide the others
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {time.time() - start:7.2f}s {name}", *problems)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
