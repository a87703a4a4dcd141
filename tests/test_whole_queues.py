"""Checks of whole-run operators run every rule of their queues, on tables made here."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from rulecheck.schema import RESULT_COLUMNS
from rulecheck.sources.tables import register_parquet_tables
from rulecheck.testing import corpus as C
from rulecheck.testing import oracle as O
from tools.check_oracles import canon

DAY = datetime(2000, 6, 1)
LATE = datetime(2024, 3, 1)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA"), (1, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "CHAD", 0), (1, "LAOS", 1)]),
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "a", 0, -2.5, "AUTO"), (2, "b", 1, 9.0, None)]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(1, "s1", 0, 5.0), (2, "s2", 1, -1.0)]),
    "part": ("p_partkey bigint, p_name string", [(1, "nut"), (2, None)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(i, 1, "FO"[i % 2], 10.5 * i, LATE if i % 3 else DAY, "1-URGENT") for i in range(1, 13)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_extendedprice double, l_shipdate timestamp",
        [(i, 1, 1 + i % 2, 3.25 * i, DAY) for i in range(1, 10)] + [(1, 1, 1, 7.0, LATE)],
    ),
    "events": ("event_id bigint, event_type string, value double, ts timestamp", [(1, "view", 101.0, LATE), (2, None, 1.0, LATE), (3, "view", 1.0, DAY)]),
}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("made"))
    for name, (kind, rows) in TABLES.items():
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    yield folder
    register_parquet_tables(spark, SF_SMALL, C.TABLES)


@pytest.fixture(scope="module")
def duck(made):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{made}/{name}.parquet/*.parquet')")
    return con


def both(spark, duck, made, key):
    """Columns and rows of a query, the same as those of its SQL."""
    df = E._QUERIES[key](spark, made)
    rows = df.collect()
    rel = duck.sql(E._oracles()[key])
    assert canon(df.columns, [tuple(r) for r in rows]) == canon(rel.columns, rel.fetchall())
    return df.columns, rows


def test_the_projection_has_every_rule_of_its_queue(spark, duck, made):
    columns, rows = both(spark, duck, made, "result_projection")
    assert {r.DQ_CHK_ID for r in rows} == set(O.queue_chk_ids(C.QUEUE))
    assert tuple(columns) == (*RESULT_COLUMNS, "LAYOUT")
    assert {r.LAYOUT for r in rows} == {O.LAYOUT}
    said = {r.DQ_CHK_ID: r.ERROR_MESSAGE for r in rows if r.EXECUTION_STATUS == "FAILED"}
    assert said["C13"] == "[PARSE_SYNTAX_ERROR]" and said["C16"] == "[USER_RAISED_EXCEPTION]" and said["C20"] == "DQ_SQL is null"
    assert said["C12"].startswith("Unresolved placeholders in SQL: ['$foo']. Final SQL: SELECT ")


def test_the_union_has_every_rule_of_its_queues(spark, duck, made):
    _, rows = both(spark, duck, made, "result_union_all")
    found = [(r.DQ_QUEUE_ID, r.DQ_CHK_ID) for r in rows]
    assert set(found) == {(queue, c) for queue in (C.QUEUE, C.UNION_QUEUE) for c in O.queue_chk_ids(queue)}
    alike = {c: sorted((r.SOR, r.TOTAL_COUNT, r.N_SAME) for r in rows if r.DQ_CHK_ID == c) for c in ("C32", "C33")}
    assert alike == {"C32": [("F", 6, 2)] * 2 + [("O", 6, 2)] * 2, "C33": [("F", 6, 1), ("O", 6, 1)]}
