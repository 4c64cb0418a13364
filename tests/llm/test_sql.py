"""Queries with SQL give what DuckDB gives on the same tables."""

import duckdb
import pytest

from kelpforge.llm import queries
from tests.llm.test_operators import SF


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = ", ".join(sorted(df.columns))
    want = c.execute(f"SELECT {cols} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr) == sorted(want, key=repr)
