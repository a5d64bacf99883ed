"""Queries of the operators that SQL can express, against it, on the smallest tables."""

import os

import duckdb
import pytest

from quotemill.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    df = registry.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    told = lambda rows: sorted(str([r[c] for c in sorted(columns)]) for r in rows)
    assert told(df.collect()) == told([dict(zip(columns, r)) for r in found.fetchall()])
