"""Rows of a registered query and of its SQL, as sorted text."""

import duckdb

from eventwatch.llm import queries

SF = "/root/testdata/sf0.001"


def oracle_rows(spark, name, sf=SF):
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    return (sorted(map(str, map(tuple, df.select(*columns).collect()))), sorted(str(tuple(r[i] for i in at)) for r in rel.fetchall()))
