"""Every query of the contract engine against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from rowgate.plans import queries as core
from tests.conftest import SF

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, (dt.datetime, dt.date)):
        return x.isoformat()
    return x


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(core.queries()) - set(E.oracle_sql())
    assert not missing and set(core.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    rows = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    got = Counter(tuple(norm(r[i]) for i in order) for r in rows)
    want = Counter(tuple(norm(r[i]) for i in oorder) for r in orows)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_key", "source_file", "business_date", "violation_index", "kind", "column",
                          "rule", "violation"]
