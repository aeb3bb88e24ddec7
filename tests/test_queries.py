"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tramloom import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _rows(rows, names, order):
    at = [names.index(c) for c in order]
    value = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 3) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in at) for r in rows), key=repr)


_SOME = os.environ.get("TRAMLOOM_QUERIES", "")


@pytest.mark.parametrize("name", sorted(n for n in queries.oracle_sql() if not _SOME or n in _SOME.split()))
def test_query_matches_sql(spark, db, sf, name):
    df = queries.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cursor = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(got, df.columns, sorted(names)) == _rows(cursor.fetchall(), names, sorted(names))


def test_sql_is_only_for_queries():
    assert set(queries.oracle_sql()) <= set(queries.queries())
