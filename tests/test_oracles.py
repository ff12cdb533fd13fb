"""Every registered query against its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from eventwatch.plans.oracle import ORACLES
from eventwatch.plans.queries import QUERIES
from tools_norm import norm

TABLES = "events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    srows = Counter(tuple(norm(x) for x in r) for r in sdf.collect())
    orows = Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == orows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 1000 and df.columns == ["request_ts", "type", "source_ip", "user_id", "level", "description"]
