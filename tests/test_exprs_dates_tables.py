from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tramloom.config import DEFAULT
from tramloom.functions import exprs as X
from tramloom.operators import dates, schedule
from tramloom.sources import observations, tables


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(("text", "base", "version"), [("123_456", "123", "456"), ("a_b_c", "a_b", "c"), ("abc", "abc", None), ("abc_", "abc_", None), ("_x", "_x", None)])
def test_version_suffix(spark, text, base, version):
    assert one(spark, X.versionless(F.lit(text))) == base and one(spark, X.version_of(F.lit(text))) == version


@pytest.mark.parametrize(("text", "sec"), [("08:00:00", 28800), (" 25:30:00 ", 91800), ("8:60:00", None), ("", None), ("x", None), (None, None), ("100:00:01", 360001)])
def test_clock_seconds(spark, text, sec):
    assert one(spark, X.clock_seconds(F.lit(text).cast("string"))) == sec


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
@pytest.mark.parametrize(("date", "utc"), [("2026-03-08", "2026-03-08T04:00"), ("2026-11-01", "2026-11-01T05:00"), ("2026-08-05", "2026-08-05T04:00")])
def test_service_day_start_on_days_when_clocks_change(spark, date, utc, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, X.service_day_start(F.lit(date), DEFAULT.zone))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == int(datetime.fromisoformat(utc).replace(tzinfo=timezone.utc).timestamp())


@pytest.mark.parametrize(("sec", "text"), [(45, "45s"), (192, "3m12s"), (3840, "1h04m"), (0, "0s"), (3599, "59m59s")])
def test_readable_duration(spark, sec, text):
    assert one(spark, X.readable_duration(F.lit(sec))) == text


def test_names_codes_and_small_ones(spark):
    assert one(spark, X.station_code(F.lit("PF_A01_C"))) == "A01" and one(spark, X.station_code(F.lit("STOP"))) == "STOP" and one(spark, X.station_code_or_null(F.lit("STOP"))) is None
    assert one(spark, X.plain_name(F.lit("  Foo-Bar & Baz "))) == "foo bar baz"
    assert one(spark, X.iso_date(F.lit("20260805"))) == "2026-08-05" and one(spark, X.iso_date(F.lit(""))) is None
    assert one(spark, X.version_label(F.lit("2026-01-01"), F.lit(None).cast("string"))) == "2026-01-01/unknown"
    assert one(spark, X.hour_bucket(F.lit(91800))) == 1 and one(spark, X.valid_epoch(F.lit(0), 10)) is None
    assert one(spark, F.unix_seconds(observations.captured_at_of(F.lit("a/b-1785931200.pb.gz")))) == 1785931200 and one(spark, observations.captured_at_of(F.lit("a/b.pb"))) is None


def test_covered_dates_need_the_hours_past_midnight(spark):
    spine = dates.date_spine(spark, F.lit("2026-08-04"), F.lit("2026-08-07"))
    start = one(spark, X.service_day_start(F.lit("2026-08-05"), DEFAULT.zone))
    of = lambda a, b: sorted(r[0] for r in dates.fully_covered(spine, F.lit(a), F.lit(b)).select("service_date").collect())
    assert of(start, start + 28 * 3600) == ["2026-08-05"] and of(start, start + 28 * 3600 - 1) == [] and of(start, start + 52 * 3600) == ["2026-08-05", "2026-08-06"]


def test_outstanding_and_prunable_dates(spark):
    done = spark.createDataFrame([("2026-08-03",)], "service_date string")
    now = F.lit(datetime(2026, 8, 6, 8, 30, tzinfo=timezone.utc))
    got = lambda **k: sorted(r[0] for r in dates.outstanding(spark, done, now, F.lit(datetime(2026, 8, 2, 0, 0, tzinfo=timezone.utc)), **k).collect())
    assert got() == ["2026-08-02", "2026-08-04", "2026-08-05"]
    assert "2026-08-03" in got(force=True)
    early = F.lit(datetime(2026, 8, 6, 7, 30, tzinfo=timezone.utc))
    assert "2026-08-05" not in [r[0] for r in dates.outstanding(spark, done, early).collect()]
    staged = spark.createDataFrame([("2026-07-29",), ("2026-07-30",), ("2026-08-05",)], "service_date string")
    assert [r[0] for r in dates.prunable(staged, now).collect()] == ["2026-07-29"]
    assert dates.keep_targets(staged, done).count() == 0 and dates.skipped(staged, done).count() == 3


def test_bundle_choice(spark):
    b = spark.createDataFrame([("2026-01-01", "2026-03-31", "1"), ("2026-03-01", "unknown", "2"), ("2026-05-01", "2026-06-30", None)], "feed_start string, feed_end string, version string")
    d = spark.createDataFrame([("2025-12-01",), ("2026-02-01",), ("2026-03-15",), ("2026-05-02",), ("2026-07-15",)], "service_date string")
    got = {r["service_date"]: (r["bundle"], r["covered"]) for r in schedule.resolve_bundles(d, b).collect()}
    assert got == {"2025-12-01": ("2026-05-01/unknown", False), "2026-02-01": ("2026-01-01/1", True), "2026-03-15": ("2026-03-01/2", True), "2026-05-02": ("2026-05-01/unknown", True), "2026-07-15": ("2026-03-01/2", True)}


def test_bundle_validity(spark):
    whole = [("a", m) for m in tables.REQUIRED_MEMBERS] + [("b", m) for m in tables.REQUIRED_MEMBERS[:-1]] + [("c", m) for m in tables.REQUIRED_MEMBERS]
    info = spark.createDataFrame([("a", "20260101", "", " "), ("b", "20260101", "20260201", "7"), ("c", "", "", "1")], "bundle string, feed_start_date string, feed_end_date string, feed_version string")
    got = {r["bundle"]: r for r in tables.bundle_problems(spark.createDataFrame(whole, "bundle string, member string"), info).collect()}
    assert got["a"]["valid"] and got["a"]["feed_end"] == "unknown" and got["a"]["version"] is None
    assert not got["b"]["valid"] and got["b"]["missing"] == ["trips.txt"] and not got["c"]["valid"]


def test_partition_writes_replace_only_their_own(spark, tmp_path):
    path, shape = f"{tmp_path}/t", "service_date string, x int"
    tables.write_partitions(spark.createDataFrame([("2026-08-04", i) for i in range(3)] + [("2026-08-05", 9)], shape), path)
    for _ in range(2):
        tables.write_partitions(spark.createDataFrame([("2026-08-05", 1), ("2026-08-05", 2)], shape), path)
    back = tables.read_partitions(spark, path, spark.createDataFrame([], shape).schema)
    assert sorted((r["service_date"], r["x"]) for r in back.collect()) == [("2026-08-04", 0), ("2026-08-04", 1), ("2026-08-04", 2), ("2026-08-05", 1), ("2026-08-05", 2)]
    assert tables.read_partitions(spark, path, back.schema, ["2026-08-04"]).count() == 3 and tables.completed_dates(back).count() == 2
    assert len(list((tmp_path / "t" / "service_date=2026-08-05").glob("*.parquet"))) == 1
    again = tables.fingerprint(back).first()
    assert again == tables.fingerprint(back.repartition(3)).first()


def test_window_writes_keep_neighbours_on_the_same_date(spark, tmp_path):
    path, shape = f"{tmp_path}/w", "service_date string, x int"
    ts = lambda h: F.timestamp_seconds(F.lit(1785888000 + 3600 * h))
    tables.write_window(spark.createDataFrame([("2026-08-05", 1)], shape), path, ts(0), ts(3))
    tables.write_window(spark.createDataFrame([("2026-08-05", 2)], shape), path, ts(3), ts(6))
    tables.write_window(spark.createDataFrame([("2026-08-05", 3)], shape), path, ts(0), ts(3))
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [2, 3]


def test_static_tables_are_text(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name,parent_station\n001,"A, b",\n2,,STN\n')
    rows = tables.read_static_table(spark, f"{tmp_path}/stops.txt").collect()
    assert [tuple(r) for r in rows] == [("001", "A, b", ""), ("2", "", "STN")]


def test_half_open_window_and_hours(spark):
    t = lambda h: datetime(2026, 8, 5, h, tzinfo=timezone.utc)
    df = spark.createDataFrame([(t(h),) for h in (9, 10, 11, 12, 13)], "captured_at timestamp")
    assert observations.in_window(df, F.lit(t(10)), F.lit(t(12))).count() == 2
    hours = observations.counts_by_hour(df, observations.hour_spine(spark, F.lit(t(11)), F.lit(t(15)))).orderBy("hour").collect()
    assert [r["n"] for r in hours] == [1, 1, 1, 0]


def test_content_addressing_is_idempotent(spark):
    df = spark.createDataFrame([("rail", "x"), ("rail", "x"), ("bus", "x"), ("rail", "y")], "mode string, content string")
    assert tables.content_addressed(df).count() == 3
