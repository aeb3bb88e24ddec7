from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tramloom.config import DEFAULT
from tramloom.functions.asof import asof_backward
from tramloom.operators import baselines, encode, evaluate, features, journeys, model, split

NOON = datetime(2026, 8, 7, 12, 0, tzinfo=timezone.utc)
SHAPE = "service_date string, trip_id string, trip_run int, route_id string, direction_id int, mode string, from_stop_id string, to_stop_id string, from_stop_sequence int, stop_sequence int, stop_span int, actual_departure_ts timestamp, actual_arrival_ts timestamp, actual_duration_sec double, scheduled_duration_sec int, delay_sec int, arrival_bracket_sec int"


def seg(depart, duration=120.0, trip="T1", sequence=2, delay=0, date="2026-08-07", stop="PF_A01_C", to="PF_A02_C", route="RED", run=0, scheduled=120):
    t = NOON + timedelta(seconds=depart)
    return (date, trip, run, route, 0, "rail", stop, to, sequence - 1, sequence, 1, t, t + timedelta(seconds=duration), duration, scheduled, delay, 60)


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def recent(spark, rows, trip="Q", settings=DEFAULT):
    return features.recent_conditions(frame(spark, rows), settings).where(F.col("trip_id") == trip).first()


@pytest.mark.parametrize(("query", "want"), [(300, None), (301, 300.0), (200, None)])
def test_a_traversal_is_visible_only_after_it_is_completed(spark, query, want):
    assert recent(spark, [seg(0, 300.0, "P"), seg(query, 100.0, "Q")])["recent_duration_median"] == want


def test_the_future_moves_nothing(spark):
    rows = [seg(0, 100.0, "A"), seg(200, 140.0, "B"), seg(1000, 90.0, "Q")]
    before = recent(spark, rows)
    after = recent(spark, [*rows, seg(1001, 900.0, "Z"), seg(2000, 5.0, "Y")])
    assert before == after and before["recent_duration_median"] == 120.0 and before["recent_traversals"] == 2 and before["recent_deviation"] == 40.0


def test_stale_conditions_are_null(spark):
    assert recent(spark, [seg(0, 100.0, "P"), seg(3700, 100.0, "Q")])["recent_duration_median"] == 100.0
    assert recent(spark, [seg(0, 100.0, "P"), seg(3701, 100.0, "Q")])["recent_duration_median"] is None


def test_rolling_window_is_bounded(spark):
    rows = [seg(i * 200, 100.0 + i, f"P{i}") for i in range(7)] + [seg(1600, 1.0, "Q")]
    row = recent(spark, rows)
    assert row["recent_traversals"] == 5 and row["recent_duration_median"] == 104.0


def test_asof_against_brute_force(spark):
    import random

    rng = random.Random(2)
    q = [(i, rng.choice("ab"), rng.randrange(40)) for i in range(80)]
    e = [(rng.choice("ab"), rng.randrange(40), i, rng.choice([None, i * 10])) for i in range(60)]
    left, right = spark.createDataFrame(q, "qid int, k string, t int"), spark.createDataFrame(e, "k string, at int, n int, v int")
    for strict in (True, False):
        got = {r["qid"]: (r["at"], r["v"]) for r in asof_backward(left, right, ["k"], "t", "at", ["v"], ["n"], strict).collect()}
        for i, k, t in q:
            before = sorted((a, n, v) for kk, a, n, v in e if kk == k and (a < t or not strict and a == t))
            assert got[i] == ((before[-1][0], before[-1][2]) if before else (None, None))


def test_upstream_delay_is_strictly_before(spark):
    rows = [seg(i * 200, sequence=i + 2, delay=30 * (i + 1)) for i in range(3)] + [seg(9, trip="T1", run=1, sequence=2, delay=500)]
    got = {(r["trip_run"], r["stop_sequence"]): (r["upstream_delay_sec"], r["upstream_delay_last_sec"], r["segments_completed"]) for r in features.upstream_delay(frame(spark, rows)).collect()}
    assert got == {(0, 2): (None, None, 0), (0, 3): (30, 30, 1), (0, 4): (90, 60, 2), (1, 2): (None, None, 0)}


def test_headway_by_route_and_stop(spark):
    rows = [seg(0, trip="A"), seg(240, trip="B"), seg(540, trip="C"), seg(300, trip="D", route="BLUE"), seg(9000, trip="E")]
    got = {r["trip_id"]: r["headway_sec"] for r in features.headway(frame(spark, rows)).collect()}
    assert got == {"A": None, "B": 240, "C": 300, "D": None, "E": None}


def test_calendar(spark):
    holidays = spark.createDataFrame([("2026-08-07",)], "date string")
    row = features.calendar(frame(spark, [seg(0)])).first()
    assert (row["local_hour"], row["local_dow"], row["is_weekend"], row["fare_period"]) == (8, 4, 0, "weekday_daytime")
    row = features.calendar(frame(spark, [seg(0)]), holidays).first()
    assert row["is_holiday"] == 1 and row["fare_period"] == "weekend"
    assert features.calendar(frame(spark, [seg(13.5 * 3600)])).first()["fare_period"] == "weekday_evening"
    late, early = (features.calendar(frame(spark, [seg(h * 3600)])).first() for h in (15, 16))  # 23 and 0 o'clock lie side by side
    assert abs(late["hour_sin"] - early["hour_sin"]) < 0.3 and abs(late["hour_cos"] - early["hour_cos"]) < 0.05


def test_lookup_gives_what_a_probe_after_the_last_completion_would(spark):
    rows = [seg(i * 300, 100.0 + 7 * i, f"P{i}", delay=i) for i in range(9)] + [seg(i * 300, 50.0, f"R{i}", stop="PF_B01_C") for i in range(2)]
    df = frame(spark, rows)
    look = features.conditions_lookup(df)
    last = df.groupBy("from_stop_id", "to_stop_id").agg(F.max("actual_arrival_ts").alias("t"))
    probes = last.select(F.lit("x").alias("service_date"), F.lit("probe").alias("trip_id"), F.lit(0).alias("trip_run"), F.lit("RED").alias("route_id"), F.lit(0).alias("direction_id"), F.lit("rail").alias("mode"), "from_stop_id", "to_stop_id", F.lit(1).alias("from_stop_sequence"), F.lit(2).alias("stop_sequence"), F.lit(1).alias("stop_span"), (F.col("t") + F.expr("interval 1 second")).alias("actual_departure_ts"), F.lit(None).cast("timestamp").alias("actual_arrival_ts"), F.lit(None).cast("double").alias("actual_duration_sec"), F.lit(120).alias("scheduled_duration_sec"), F.lit(None).cast("int").alias("delay_sec"), F.lit(60).alias("arrival_bracket_sec"))
    asked = features.recent_conditions(df.unionByName(probes)).where("trip_id = 'probe'")
    got = {r["from_stop_id"]: tuple(r)[1:] for r in asked.select("from_stop_id", "recent_duration_median", "recent_duration_mean", "recent_delay_mean", "recent_traversals", "recent_deviation").collect()}
    want = {r["from_stop_id"]: tuple(r)[1:] for r in look.select("from_stop_id", "roll_median", "roll_mean", "roll_delay_mean", "roll_n", "roll_deviation").collect()}
    assert got == want and len(got) == 2
    now = NOON + timedelta(seconds=9 * 300)
    served = features.all_features(df.where("trip_id = 'P8'"), lookup=look, now=F.lit(now)).first()
    assert served["recent_duration_median"] == want["PF_A01_C"][0] and served["headway_sec"] is None
    early = features.with_lookup(df, look, F.lit(NOON)).first()
    assert early["recent_duration_median"] is None  # what is from the future is not used


def chain(trip, n, start=0, gap_at=None, skip_at=None, date="2026-08-11"):
    rows, t, q = [], start, 1
    for i in range(n):
        t += 500 if i == gap_at else 0
        q += 1 if i == skip_at else 0
        rows.append(seg(t, 100.0, trip, q + 1, date=date, stop=f"PF_A0{q}_C", to=f"PF_A0{q + 1}_C"))
        t, q = t + 100, q + 1
    return rows


def test_holes_split_blocks_and_sums_never_cross_them(spark):
    df = journeys.with_blocks(frame(spark, chain("A", 5, gap_at=2) + chain("B", 4, skip_at=1)))
    got = {(r["trip_id"], r["stop_sequence"]): r["block_no"] for r in df.collect()}
    assert [got["A", q] for q in range(2, 7)] == [0, 0, 1, 1, 1] and [got["B", q] for q in (2, 4, 5, 6)] == [0, 1, 1, 1]
    row = journeys.block_diagnostics(df).first()
    assert (row["n_segments"], row["runs"], row["blocks"], row["pairs"], row["broken"], row["median_block"]) == (9, 2, 4, 7, 2, 2.5)
    built = journeys.build_journeys(df).groupBy("n_segments").agg(F.count("*").alias("n"), F.min("actual_duration_sec").alias("lo"), F.max("actual_duration_sec").alias("hi")).collect()
    assert {r["n_segments"]: (r["n"], r["lo"], r["hi"]) for r in built} == {1: (9, 100, 100), 2: (5, 200, 200), 3: (2, 300, 300)}
    ends = journeys.build_journeys(df).where("n_segments = 3 and trip_id = 'A'").first()
    assert ends["origin_stop_id"] == "PF_A03_C" and ends["dest_stop_id"] == "PF_A06_C" and ends["dest_station"] == "A06"


def test_split_leaves_an_embargo_and_blocks_whole(spark):
    rows = [seg(3600 * h, trip=f"T{h}", date=f"2026-08-{7 + h // 24:02d}") for h in range(24 * 20)]
    labelled = split.temporal_split(frame(spark, rows))
    ends = {r["split"]: r for r in split.split_report(labelled).collect()}
    assert ends["validation"]["first"] - ends["train"]["last"] >= DEFAULT.embargo_sec
    w = split.split_warnings(labelled).first()
    assert not (w["too_few_days"] or w["single_date"] or w["has_unseen"])
    few = split.split_warnings(split.temporal_split(frame(spark, rows[:30]))).first()
    assert few["too_few_days"]
    built = journeys.build_journeys(journeys.with_blocks(frame(spark, [r for i in range(20) for r in chain(f"C{i}", 4, start=i * 7200)])))
    parts = split.split_journeys(built).groupBy("trip_id").agg(F.countDistinct("split").alias("n"))
    assert parts.where("n > 1").count() == 0


def test_codes_know_only_training(spark):
    train = spark.createDataFrame([("b", 1), ("a", 2), (None, 2)], "x string, y int")
    codes = encode.fit_codes(train, ["x"])
    assert {r["value"]: r["code"] for r in codes.collect()} == {"a": 0, "b": 1}
    other = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    assert sorted(r["x"] for r in encode.encode(other, codes, ["x"]).collect()) == [-1, -1, 0]
    assert encode.unseen_rate(other, codes, ["x"]).first()["unseen_pct"] == pytest.approx(200 / 3)
    with pytest.raises(ValueError, match="gone"):
        encode.matrix(other, codes, ["x", "gone"], ["x"])
    assert encode.matrix(other.withColumn("k", F.lit(1)), codes, ["k", "x"], ["x"]).columns == ["k", "x"]
    rows = frame(spark, [seg(0)])
    columns = encode.feature_columns(rows)
    assert "actual_duration_sec" not in columns and "trip_id" not in columns and set(encode.categorical_columns(rows, columns)) == {"route_id", "direction_id", "mode"}


def test_baselines_and_calibration(spark):
    rows = features.calendar(frame(spark, [seg(i * 100, 100.0 + 10 * (i % 3), f"T{i}") for i in range(9)]))
    got = {r["baseline"]: r for r in baselines.suite(rows).collect()}
    assert got["segment_median"]["mae"] == pytest.approx(60 / 9) and got["schedule"]["mae"] == pytest.approx(10.0) and got["segment_median"]["best"]
    fitted = baselines.fitted_medians(rows)
    other = features.calendar(frame(spark, [seg(0), seg(5 * 3600, trip="N"), seg(0, trip="M", stop="PF_Z")]))
    assert {r["trip_id"]: r["median_prediction"] for r in baselines.apply_medians(other, fitted).collect()} == {"T1": 110.0, "N": 110.0, "M": 110.0}
    scored = rows.withColumn("p", F.lit(100.0))
    offset = baselines.residual_offset(scored, "p")
    assert offset.first()[0] == pytest.approx(10.0) and baselines.calibrated(scored, "p", offset).first()["calibrated"] == pytest.approx(110.0)
    assert evaluate.segment_level(scored, ["p"]).first()["mae"] == pytest.approx(10.0)
    assert baselines.noise_floor(rows).first()["floor_sec"] == pytest.approx(30 * 2**0.5 * 0.8)


def test_categories_are_split_as_sets_and_the_unseen_are_one(spark):
    worth = {"a": 5.0, "b": 90.0, "c": 6.0, "d": 91.0, None: 50.0}
    rows = spark.createDataFrame([(c, v) for c, v in worth.items() for _ in range(9)], "c string, actual_duration_sec double")
    fitted = model.fit(rows, ["c"], rounds=1, depth=1, loss="squared")
    split_ = model.nodes(fitted).where("node = 0").first()
    assert {*split_["categories"]} in ({"a", "c"}, {"a", "c", None})
    deep = model.fit(rows, ["c"], rounds=2, depth=5, loss="squared")
    out = model.predict(deep, spark.createDataFrame([("a",), ("d",), (None,), ("never",)], "c string")).collect()
    assert [r["prediction"] for r in out] == pytest.approx([5.0, 91.0, 50.0, 50.0])


def test_rounds_end_when_validation_gains_no_more(spark):
    made = lambda lo, hi: spark.range(lo, hi).select((F.col("id") % 11).cast("double").alias("a"), F.when(F.col("id") % 11 > 5, 100.0).otherwise(10.0).alias("actual_duration_sec"))
    trees = lambda **more: model.fit(made(0, 200), ["a"], rounds=25, depth=2, loss="squared", **more).trees.stages[-1].getNumTrees
    assert trees(valid=made(200, 300)) < 5 and trees() == 25


def test_trees_take_missing_values_and_beat_a_constant(spark):
    rows = spark.createDataFrame([(float(i % 7), None if i % 3 else float(i), "ab"[i % 2], 100.0 + 20 * (i % 7) + 50 * (i % 2)) for i in range(300)], "a double, b double, c string, actual_duration_sec double")
    fitted = model.fit(rows, ("a", "b", "c"), rounds=8, depth=4)
    out = model.predict(fitted, rows)
    assert out.columns == [*rows.columns, "prediction"]
    mae = out.agg(F.avg(F.abs(F.col("prediction") - F.col("actual_duration_sec")))).first()[0]
    assert mae < 25
    top = evaluate.importance(model.gains(fitted)).collect()
    assert top[0]["feature"] in ("a", "c") and sum(r["share"] for r in top) == pytest.approx(1.0)
    odd = rows.limit(20).unionByName(spark.createDataFrame([(1.0, None, "z", 0.0), (None, 2.0, None, 0.0), (None, None, "a", 0.0)], rows.schema))
    both = model.by_nodes(model.predict(fitted, odd), model.nodes(fitted), model.known_values(fitted), "own").collect()
    assert len(both) == 23 and all(r["own"] == pytest.approx(r["prediction"], rel=1e-12) for r in both)
    table = model.nodes(fitted)
    assert table.where("column = 'c'").count() and table.where("column = 'c' and threshold is not null").count() == 0
    with pytest.raises(ValueError, match="b"):
        model.predict(fitted, rows.drop("b"))
    warned = spark.createDataFrame([(18, None), (17, 1.0)], "n int, recent_deviation double").select(model.scoring_warnings("n").alias("w")).collect()
    assert [r["w"] for r in warned] == [["beyond_training", "no_recent_conditions"], []]
