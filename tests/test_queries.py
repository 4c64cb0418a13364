"""Every query with SQL gives what DuckDB gives on the same tables."""

import math
import os

import duckdb
import pytest

from kelpforge.plans import load

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(load().SQL))
def test_against_sql(spark, duck, name):
    df = load().QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = duck.execute(load().SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
