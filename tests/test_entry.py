"""Driver contract: entry smoke, registry shape and every oracle key at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from coact.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "orders", "customer", "events", "embeddings"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["item", "related", "rk", "sim"]
    assert df.count() > 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.REGISTRY) <= set(E.queries())
    assert set(oracle.SQL) <= set(catalog.REGISTRY)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda k: cols[k])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v
    return sorted((tuple(norm(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(oracle.SQL))
def test_oracle_key(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), dcols)


@pytest.mark.parametrize("key", sorted(set(catalog.REGISTRY) - set(oracle.SQL)))
def test_rows_only_key_runs(spark, key):
    assert E.queries()[key](spark, SF).count() > 0
