import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tramloom.sources import published, tables

SHAPE = "service_date string, n int"
A, B, C = "2026-08-04", "2026-08-05", "2026-08-06"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SHAPE)


def _held(spark, path, **more):
    return sorted(map(tuple, published.read(spark, path, _rows(spark).schema, **more).collect()))


def test_dates_are_replaced_and_the_rest_stays(spark, tmp_path):
    path = str(tmp_path)
    assert _held(spark, path) == []
    first = published.publish(_rows(spark, (A, 1), (A, 2), (B, 3)), path, measures={"total": F.sum("n")})
    assert (first["version"], first["n"], first["total"]) == (1, 3, 6)
    for _ in range(2):  # a rerun gives the same table
        published.publish(_rows(spark, (B, 5), (C, 6), (A, 9)), path, [B, C])
        assert _held(spark, path) == [(A, 1), (A, 2), (B, 5), (C, 6)]
    assert published.publish(_rows(spark, (B, 7)), path, [A, B])["n"] == 1  # of a date without rows nothing stays
    assert _held(spark, path) == [(B, 7), (C, 6)] and _held(spark, path, dates=[C, A]) == [(C, 6)]
    assert published.publish(_rows(spark), path, [B, C])["n"] == 0 and _held(spark, path) == []
    assert _held(spark, path, version=1) == [(A, 1), (A, 2), (B, 3)] and _held(spark, path, version=3) == [(A, 1), (A, 2), (B, 5), (C, 6)]
    with pytest.raises(ValueError, match="no version 9"):
        _held(spark, path, version=9)


def test_a_publication_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    published.publish(_rows(spark, (A, 1), (B, 2)), path)
    before = published.read(spark, path, _rows(spark).schema)  # a reader that has begun

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(published, "_announce", die)
        with pytest.raises(RuntimeError):
            published.publish(_rows(spark, (A, 9)), path, [A, B])
    fails = F.udf(lambda n: 1 // n, "int")
    with pytest.raises(Exception, match="division|Division"):
        published.publish(_rows(spark, (A, 0)).select("service_date", fails("n").alias("n")), path, [A])
    assert _held(spark, path) == [(A, 1), (B, 2)]
    published.publish(_rows(spark, (A, 9)), path, [A])
    assert _held(spark, path) == [(A, 9), (B, 2)] and sorted(map(tuple, before.collect())) == [(A, 1), (B, 2)]
    assert len(published.clear_old(spark, path, keep=2)) == 1  # what the dead left; a failed job has cleared its own
    assert _held(spark, path, version=1) == [(A, 1), (B, 2)]
    assert len(published.clear_old(spark, path, keep=1)) == 0 and _held(spark, path) == [(A, 9), (B, 2)]  # B lies in the first still


def test_two_writers_from_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    published.publish(_rows(spark, (A, 1)), path)
    real, raced = published._newest, []

    def newest(spark_, path_, version=None):
        found = real(spark_, path_, version)
        if not raced and version is None:  # another one publishes after this one has looked
            raced.append(True)
            monkeypatch.setattr(uuid, "uuid4", lambda: uuid.UUID("f" * 32))
            other = _rows(spark_, (B, 2))
            other.write.partitionBy("service_date").parquet(f"{path_}/data/commit={'f' * 32}")
            published._announce(spark_, path_, "f" * 32, [B], [B])
        return found

    monkeypatch.setattr(published, "_newest", newest)
    commit = "0" * 32
    _rows(spark, (C, 3)).write.partitionBy("service_date").parquet(f"{path}/data/commit={commit}")
    assert published._announce(spark, path, commit, [C], [C]) == 3
    monkeypatch.undo()
    assert _held(spark, path) == [(A, 1), (B, 2), (C, 3)]


def test_a_table_without_dates(spark, tmp_path):
    path = str(tmp_path)
    for n in (1, 2):
        published.publish(_rows(spark, (A, n)), path, by=None)
        assert sorted(map(tuple, published.read(spark, path, _rows(spark).schema, by=None).collect())) == [(A, n)]


def test_archive_is_read_by_its_folders(spark, tmp_path):
    path, at = str(tmp_path), lambda d, h, m=0: datetime(2026, 8, d, h, m, tzinfo=timezone.utc)
    rows = spark.createDataFrame([(at(d, h, m), d * 10_000 + h * 100 + m) for d in (4, 5, 7) for h in (0, 5, 23) for m in (0, 59)], "captured_at timestamp, n int")
    tables.write_archive(rows.where("n < 50000"), path, "a")
    tables.write_archive(rows.where("n >= 50000"), path, "a")
    tables.write_archive(rows, path, "b")
    schema = rows.schema
    held = lambda *w: sorted(r["n"] for r in tables.read_archive(spark, path, schema, "a", *w).collect())
    every = sorted(r["n"] for r in rows.collect())
    assert held(at(1, 0), at(30, 0)) == every
    assert held(at(4, 23, 59), at(7, 5)) == [42359, 50000, 50059, 50500, 50559, 52300, 52359, 70000, 70059]
    assert held(at(6, 0), at(6, 23)) == [] == held(at(20, 0), at(25, 0))
    some = tables.read_archive(spark, path, schema, "a", at(5, 5), at(5, 6))
    assert {f.split("/day=")[1][:10] for f in some.inputFiles()} <= {"05/hour=00", "05/hour=05", "05/hour=23"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2026080505" in plan.split("PartitionFilters", 1)[1].split("DataFilters")[0]


def test_static_tables_are_text_without_nulls(spark, tmp_path):
    file = tmp_path / "stops.txt"
    file.write_text('stop_id,stop_name,parent\nS1,"Union, ""Main""",\nS2,"",P1\n007,x\n')
    rows = tables.read_static_table(spark, str(file))
    assert {t for _, t in rows.dtypes} == {"string"}
    assert sorted(map(tuple, rows.collect())) == [("007", "x", ""), ("S1", 'Union, "Main"', ""), ("S2", "", "P1")]
