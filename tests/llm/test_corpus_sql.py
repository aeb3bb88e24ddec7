"""The corpus queries that SQL can express, against their SQL on the smallest tables."""

import duckdb
import pytest
from tramloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = queries.queries()[name](spark, sf)
    want = con.execute(queries.oracle_sql()[name])
    names = sorted(d[0] for d in want.description)
    assert sorted(got.columns) == names
    at = [[d[0] for d in want.description].index(c) for c in names]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
