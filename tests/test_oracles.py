"""Every rule-engine query against its DuckDB ``oracle_sql()`` twin at sf0.001 (the
training-data queries have tests of their own)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import VIEWS, canon, types_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in VIEWS.split():
        path = f"{SF}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", sorted(E._QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E._QUERIES[key](spark, SF)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(E._oracles()[key])
    d_types = types_of(duck_columns=rel.columns, duck_types=rel.types)
    d_cols, d_rows = canon(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    assert types_of(spark_dtypes=df.dtypes) == d_types
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 19
    assert df.count() >= 0
