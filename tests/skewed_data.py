"""A copy of the tables in which keys are hot, missing, repeated or NULL."""

from __future__ import annotations

from pathlib import Path

import duckdb

COPIED = "region events documents embeddings pages benchmark labels conversations"

LINEITEM = """
SELECT * EXCLUDE (n) REPLACE (
    CASE WHEN n % 3 = 0 THEN 13                      -- a third of all lines in one order
         WHEN n % 101 = 0 THEN 900000000 + n         -- lines without an order
         WHEN n % 103 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,
    CASE WHEN n % 3 = 1 THEN 7                       -- and a third in one product
         WHEN n % 107 = 0 THEN 900000000
         WHEN n % 109 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
    CASE WHEN n % 3 = 2 THEN 2 WHEN n % 113 = 0 THEN 900000000 ELSE l_suppkey END AS l_suppkey,
    CASE WHEN n % 127 = 0 THEN NULL ELSE l_discount END AS l_discount
  )
FROM (SELECT *, row_number() OVER () AS n FROM '{folder}/lineitem.parquet')
"""
ORDERS = """
SELECT * REPLACE (
    CASE WHEN o_orderkey % 3 = 0 THEN 5 WHEN o_orderkey % 31 = 0 THEN 900000000
         WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '2000-01-01'   -- a third of all orders on one day
         WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate
  )
FROM '{folder}/orders.parquet'
"""
CUSTOMER = """
SELECT * REPLACE (CASE WHEN c_custkey % 5 = 0 THEN 'Nameless' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name)
FROM '{folder}/customer.parquet' WHERE c_custkey % 11 <> 0
"""
SUPPLIER = """
SELECT * REPLACE (CASE WHEN s_suppkey % 4 = 0 THEN 99 WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey END AS s_nationkey)
FROM '{folder}/supplier.parquet'
"""
NATION = """
SELECT * REPLACE (CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_regionkey END AS n_regionkey)
FROM '{folder}/nation.parquet'
"""
REPEATED_PARTS = """
SELECT * FROM '{folder}/part.parquet'
UNION ALL SELECT * FROM '{folder}/part.parquet' WHERE p_partkey IN (3, 7)
"""


def write_skewed(folder: str, target: Path) -> str:
    con = duckdb.connect()
    selects = {name: f"SELECT * FROM '{folder}/{name}.parquet'" for name in COPIED.split()}
    selects["lineitem"] = LINEITEM.format(folder=folder)
    selects["orders"] = ORDERS.format(folder=folder)
    selects["customer"] = CUSTOMER.format(folder=folder)
    selects["supplier"] = SUPPLIER.format(folder=folder)
    selects["nation"] = NATION.format(folder=folder)
    selects["part"] = REPEATED_PARTS.format(folder=folder)
    for name, select in selects.items():
        # Several row groups, so that even these few rows are read by several tasks.
        con.execute(
            f"COPY ({select}) TO '{target}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)"
        )
    return str(target)
