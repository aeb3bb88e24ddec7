import random
import statistics
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tramloom.operators import stations
from tramloom.streaming import feeds

BASE = datetime(2026, 8, 5, 12, 0, tzinfo=timezone.utc)


def test_station_index_and_requests(spark):
    stops = spark.createDataFrame([("STN_A01", "Metro Center", ""), ("STN_C01", "Metro Center", ""), ("STN_K08", "Vienna", ""), ("PF_A01_1", "p", "STN_A01"), ("PF_C01_1", "p", "STN_C01"), ("PF_K08_C", "p", "STN_K08"), ("PF_Z09_1", "Lone", "")], "stop_id string, stop_name string, parent_station string")
    index = {r["station"]: r["codes"] for r in stations.station_index(stops).collect()}
    assert index == {"metro center": ["A01", "C01"], "vienna": ["K08"], "lone": ["Z09"]}
    od = spark.createDataFrame([("PF_K08_C", "PF_C01_1", 8, 1500, 9, 9, 3, "OR", 0, "PF_K07_C"), ("PF_K08_C", "PF_C01_1", -1, 1600, 9, 9, 30, "OR", 0, "PF_K07_C"), ("PF_C01_1", "PF_K08_C", -1, 1600, 9, 9, 30, "OR", 1, "PF_C02_C"), ("PF_A01_1", "PF_K08_C", -1, 1600, 9, 9, 30, "RD", 1, "PF_A02_C")], "origin string, destination string, hour int, sched_sec long, n_segments int, stop_span int, trips long, route_id string, direction_id int, first_leg_to string")
    asked = spark.createDataFrame([(1, "VIENNA", "Metro-Center", 8), (2, "vienna", "metro center", 3), (3, "metro center", "vienna", 8), (4, "nowhere", "vienna", 8), (5, "lone", "vienna", 8)], "request_id int, origin string, destination string, hour int")
    got = {r["request_id"]: (r["status"], r["sched_sec"], r["hour"]) for r in stations.resolve_requests(asked, stations.station_codes(stops), od).collect()}
    assert got == {1: ("ok", 1500, 8), 2: ("ok", 1600, -1), 3: ("ambiguous", None, None), 4: ("unknown_station", None, None), 5: ("not_connected", None, None)}
    near = stations.nearest_names(spark.createDataFrame([("Viena",)], "name string"), stations.station_index(stops), 1).first()
    assert near["station"] == "vienna"


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_nearest_names_against_all_pairs(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcde ") for _ in range(n)).strip()
    known = sorted({" ".join(w.split()) for w in [word(rng.randrange(1, 14)) for _ in range(250)] if w.strip()})
    asked = sorted({*rng.sample(known, 20), *[" ".join((k + "e").split()) for k in rng.sample(known, 20)], "zzzz", "a", "q", "zzzzzzzzzzzzzzzzzzzzzz", *[" ".join(word(9).split()) for _ in range(20)]} - {""})
    for k in (1, 3, 7):
        got = stations.nearest_names(spark.createDataFrame([(a,) for a in asked], "name string"), spark.createDataFrame([(x,) for x in known], "station string"), k).collect()
        want = {}
        for a in asked:
            ranked = sorted((-round(1 - _edits(a, b) / max(len(a), len(b), 1), 6), b) for b in known)[:k]
            want |= {(a, i + 1): (b, pytest.approx(-s)) for i, (s, b) in enumerate(ranked)}
        assert {(r["asked"], r["rank"]): (r["station"], r["likeness"]) for r in got} == want


def test_nearest_names_of_thirty_thousand(spark):
    known = spark.range(30_000).select(F.concat(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 9), F.lit(" "), F.col("id").cast("string")).alias("station"))
    asked = known.where("crc32(station) % 500 = 0").select(F.concat("station", F.lit("7")).alias("name"))
    rows = stations.nearest_names(asked, known, 2).where("rank = 1").collect()
    assert len(rows) == asked.count() > 40
    assert all(r["likeness"] >= 1 - 1 / len(r["asked"]) - 1e-6 for r in rows)


def test_od_schedule_of_two_trips(spark):
    rows = [(t, "RD", 0, q, f"PF_{q}", 3600 * h + 100 * q * (1 + i)) for i, (t, h) in enumerate((("a", 8), ("b", 8))) for q in range(3)]
    df = spark.createDataFrame(rows, "scheduled_trip_id string, route_id string, direction_id int, stop_sequence int, stop_id string, scheduled_arrival_offset_sec int")
    got = {(r["origin"], r["destination"], r["hour"]): (r["sched_sec"], r["trips"], r["n_segments"], r["first_leg_to"]) for r in stations.od_schedule(df).collect()}
    assert got["PF_0", "PF_2", 8] == (300, 2, 2, "PF_1") and got["PF_0", "PF_2", -1] == (300, 2, 2, "PF_1") and len(got) == 6


def _run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    ended = q.awaitTermination(100)
    q.stop()
    assert ended
    return df.sparkSession.table(name).collect()


def _stream(spark, tmp_path, batches, shape):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.01 * i)
    return spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


SHAPE = "captured_at timestamp, trip_id string, stop_sequence int, stop_id string"


def _at(m):
    return BASE + timedelta(minutes=m)


def test_stream_drops_copies(spark, tmp_path):
    batch = [(_at(m), "T", m, "PF") for m in range(3)]
    assert len(_run(feeds.deduplicated(_stream(spark, tmp_path, [batch, batch], SHAPE), ("captured_at", "trip_id")), "dedup")) == 3


def test_stream_counts_closed_hours_only(spark, tmp_path):
    batches = [[(_at(m), "T", 1, "PF") for m in range(0, 120, 10)], [(_at(600), "T", 1, "PF")], [(_at(601), "T", 1, "PF")]]
    got = {r["hour"]: r["n"] for r in _run(feeds.hourly_counts(_stream(spark, tmp_path, batches, SHAPE)), "hours")}
    assert sorted(got.values()) == [6, 6]


def _batch_arrivals(spark, track):
    from tramloom.operators import arrivals

    rows = spark.createDataFrame([(_at(m), "2026-08-05", t, t, None, None, None, None, f"PF_{q}", q) for t, m, q in track], "captured_at timestamp, service_date string, trip_id string, scheduled_trip_id string, schedule_version string, route_id string, direction_id int, vehicle_id string, stop_id string, stop_sequence int")
    return _arrived(arrivals.numbered_runs(arrivals.observed_arrivals(rows)).collect())


def _arrived(rows):
    return sorted((r["trip_id"], r["trip_run"], r["stop_sequence"], r["arrival_bracket_sec"], r["sequence_jump"], r["arrival_confident"], r["actual_arrival_ts"]) for r in rows)


def test_stream_arrivals_match_the_batch_operator_in_any_order(spark, tmp_path):
    track = [("T", m, q) for m, q in ((0, 1), (1, 2), (2, 2), (3, 4), (60, 1), (61, 2), (80, 3))] + [("U", 2 * m, m % 7) for m in range(40)]
    shuffled = list(track)
    random.Random(3).shuffle(shuffled)
    over = [[(_at(900 + 600 * i), "later", 1, "PF")] for i in range(3)]  # moves the watermark past the others
    batches = [[(_at(m), t, q, f"PF_{q}") for t, m, q in part] for part in (shuffled[:20], shuffled[20:])] + over
    got = [r for r in _run(feeds.observed_arrivals(_stream(spark, tmp_path, batches, SHAPE)), "arrived") if r["trip_id"] != "later"]
    want = _batch_arrivals(spark, track)
    assert _arrived(got) == want and len(want) > 30


def test_stream_counts_service_dates_once_their_tail_is_over(spark, tmp_path):
    shape = "captured_at timestamp, service_date string"
    days = [f"2026-08-{d:02d}" for d in range(5, 9)]
    rows = [[(datetime(2026, 8, 5 + i, 12), d), (datetime(2026, 8, 6 + i, 6), d)] for i, d in enumerate(days)]  # the second within the tail
    rows += [[(datetime(2026, 8, 20, 12), "2026-08-20")], [(datetime(2026, 8, 20, 13), "2026-08-20")]]
    got = {r["service_date"]: r["n"] for r in _run(feeds.service_date_counts(_stream(spark, tmp_path, rows, shape)), "dates")}
    assert got == dict.fromkeys(days, 2)


def test_stream_conditions_are_those_of_the_last_completions(spark, tmp_path):
    shape = "from_stop_id string, to_stop_id string, actual_arrival_ts timestamp, actual_duration_sec int, delay_sec int"
    done = [("a", "b", _at(m), 100 + 7 * m % 60, m) for m in range(12)]
    random.Random(1).shuffle(done)
    rows = _run(feeds.recent_conditions(_stream(spark, tmp_path, [done[:5], done[5:]], shape)), "conditions", "append")
    assert sorted(r["seen"] for r in rows) == [5, 12]
    for row, part in zip(sorted(rows, key=lambda r: r["seen"]), (done[:5], done)):
        part = sorted(part, key=lambda r: r[2])
        own = part[-5:]
        apart = [r[3] - statistics.median(x[3] for x in part[: part.index(r)]) for r in own if part.index(r)]
        assert row["roll_n"] == 5 and row["completed_at"] == own[-1][2].replace(tzinfo=None) and row["roll_deviation"] == pytest.approx(statistics.fmean(apart))
        assert row["roll_median"] == sorted(r[3] for r in own)[2] and row["roll_delay_mean"] == sum(r[4] for r in own) / 5


def test_old_conditions_are_called_off(spark, tmp_path):
    shape = "from_stop_id string, to_stop_id string, actual_arrival_ts timestamp, actual_duration_sec int, delay_sec int"
    batches = [[("a", "b", _at(0), 100, 1)], [("x", "y", _at(600), 50, 1)], [("x", "y", _at(601), 50, 1)], [("a", "b", _at(602), 120, None)]]
    rows = _run(feeds.recent_conditions(_stream(spark, tmp_path, batches, shape)), "called_off", "append")
    got = [(r["seen"], r["roll_n"], r["roll_deviation"]) for r in rows if r["from_stop_id"] == "a"]
    assert sorted(got, key=str) == [(1, 0, None), (1, 1, None), (2, 2, 20.0)]


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    """Stopped between two batches, arrivals and their state go on as if nothing had been."""
    track = [("U", 2 * m, m % 7) for m in range(40)]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([], SHAPE).write.mode("overwrite").parquet(source)

    def drain() -> None:
        stream = feeds.observed_arrivals(spark.readStream.schema(SHAPE).parquet(source))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

    rows = lambda part: spark.createDataFrame([(_at(m), t, q, f"PF_{q}") for t, m, q in part], SHAPE)
    for part in (track[1::2], track[0::2], [("later", 900, 1)], [("later", 1500, 1)]):
        rows(part).coalesce(1).write.mode("append").parquet(source)
        drain()
    got = [r for r in spark.read.parquet(out).collect() if r["trip_id"] == "U"]
    assert _arrived(got) == _batch_arrivals(spark, track) and len(got) > 20
