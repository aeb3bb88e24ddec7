"""Observations as a stream: dedup, coverage by hour and service date, arrivals, and the latest conditions of each segment."""

from __future__ import annotations

import statistics
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tramloom.config import DEFAULT, Settings
from tramloom.functions import exprs as X
from tramloom.functions.running import History


def deduplicated(stream: DataFrame, keys: tuple[str, ...], delay: str = "4 hours", ts: str = "captured_at") -> DataFrame:
    """Each natural key once, as long as its copies come within the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_counts(stream: DataFrame, delay: str = "4 hours", ts: str = "captured_at") -> DataFrame:
    """Captures per hour; in append mode an hour comes out once it is over and late captures have had their time."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), "n")


def service_date_counts(stream: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Observations per service date; in append mode a date comes out once its whole day, tail and all, is over.

    Event time here is the end of a row's service day. The first row of a later day moves it on by a day, some hours
    before the tail of the day before has ended, so that the delay is a day, the tail, and an hour for clock changes.
    """
    ends = F.timestamp_seconds(X.service_day_end(F.col("service_date"), settings.zone, settings.overhang_hours))
    rows = stream.withColumn("day_end", ends).withWatermark("day_end", f"{24 + settings.overhang_hours + 1} hours")
    return rows.groupBy("service_date", "day_end").agg(F.count("*").alias("n"), F.max("captured_at").alias("last_captured_at")).drop("day_end")


def with_rocksdb(spark: SparkSession) -> None:
    """State by columns, lists and timers needs the RocksDB store; what a session has set to another is set to it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _micros(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


_ARRIVED = "trip_id string, stop_sequence int, stop_id string, trip_run int, actual_arrival_ts timestamp, arrival_bracket_sec int, sequence_jump int, arrival_confident boolean, observed_at_utc timestamp"


#: Before the first stop that a trip reaches.
_NONE = int(np.iinfo(np.int64).min)
_HELD = {"trip": object, "captured": np.int64, "sequence": np.int64, "stop_id": object}
_LAST = {"trip": object, "sequence": np.int64, "captured": np.int64, "run": np.int64, "reached": np.int64}


class _Arrivals(StatefulProcessor):
    """Of a bucket of trips: sightings that wait, and each trip's last one taken with the run and the last stop reached in it.

    Calls and state cost the same for one trip as for thousands, so that a bucket's trips are taken together: a row of
    the list is what one batch brought, in arrays, and the trips' last sightings are one value of arrays.
    """

    def __init__(self, limit: int, idle_ms: int) -> None:
        self.limit, self.idle = limit, idle_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "trip array<string>, captured array<bigint>, sequence array<bigint>, stop_id array<string>")
        self.last = handle.getValueState("last", "trip array<string>, sequence array<bigint>, captured array<bigint>, run array<bigint>, reached array<bigint>")

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """New sightings are added to the list, which nobody reads before the watermark has passed the first of them."""
        came, first = [], None
        for batch in rows:
            batch = batch.dropna(subset=["captured_at", "stop_sequence"])
            if len(batch):
                at = _micros(batch["captured_at"])
                came.append((batch["trip_id"].tolist(), at.tolist(), batch["stop_sequence"].astype("int64").tolist(), [None if pd.isna(x) else x for x in batch["stop_id"]]))
                first = int(at.min()) if first is None else min(first, int(at.min()))
        if came:
            self.waiting.appendList(came)
            self.handle.registerTimer(first // 1000)
        return iter(())

    def handleExpiredTimer(self, key: tuple[Any, ...], timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = list(self.waiting.get())
        held = pd.DataFrame({c: np.concatenate([np.array([], t), *[np.array(row[i], t) for row in rows]]) for i, (c, t) in enumerate(_HELD.items())})
        last = pd.DataFrame(dict(zip(_LAST, self.last.get() if self.last.exists() else [[]] * 5, strict=True))).astype(_LAST)
        over = held["captured"] <= passed
        due, later = held[over], held[~over]
        if len(due):
            if len(later):
                self.waiting.put([tuple(later[c].tolist() for c in held.columns)])
            else:
                self.waiting.clear()
        known = last[~((last["captured"] + self.idle <= passed) & ~last["trip"].isin(held["trip"]))]  # others have been idle
        if len(due):
            found, known = self._take(due, known)
            if len(found):
                yield found
        if len(known):
            self.last.update(tuple(known[c].tolist() for c in _LAST))
        elif len(last):
            self.last.clear()
        ends = known["captured"][~known["trip"].isin(later["trip"])]
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        timers = [int(t.min()) // 1000 for t in (later["captured"], ends + self.idle) if len(t)]
        if timers:
            self.handle.registerTimer(min(timers))

    def _take(self, due: pd.DataFrame, known: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Arrivals among sightings in the order of capture, where the sequence is above that of the trip's sighting before; and the trips' last sightings now."""
        due = due.merge(known[["trip", "captured"]].rename(columns={"captured": "until"}), "left", "trip")
        due = due[~(due["captured"] < due["until"])]  # what is older was late
        before = known[known["trip"].isin(due["trip"])]
        both = pd.concat([before.assign(row=0), due[["trip", "captured", "sequence", "stop_id"]].assign(row=1, run=0, reached=_NONE)], ignore_index=True)
        trip = pd.factorize(both["trip"])[0]
        order = np.lexsort((both["sequence"].to_numpy(np.int64), both["captured"].to_numpy(np.int64), both["row"].to_numpy(np.int64), trip))
        both, trip = both.iloc[order], trip[order]
        now, at, run, reached = (both[c].to_numpy(np.int64) for c in ("sequence", "captured", "run", "reached"))
        start = np.append(True, trip[1:] != trip[:-1])[: len(trip)]
        up = ~start & (now > np.append(now[:1], now[:-1]))
        since = np.append(at[:1], at[:-1])
        # each arrival's stop reached before it: of the trip's arrival before, or else of what was known of the trip
        places, firsts = np.flatnonzero(up), np.flatnonzero(start)[np.cumsum(start) - 1]
        prior = np.append([-1], places[:-1])[: len(places)]
        earlier = np.where(prior >= firsts[places], now[prior], reached[firsts[places]])
        anew = np.zeros(len(now), np.int64)
        anew[places] = now[places] <= earlier
        runs = np.cumsum(anew)
        runs = run[firsts] + runs - runs[firsts]
        ends = np.flatnonzero(np.append(start[1:], True)[: len(start)])
        latest = np.maximum.accumulate(np.where(up | start, np.arange(len(now)), 0))[ends]  # the trip's last arrival, or its first row
        stops = np.where(up[latest], now[latest], reached[latest])
        ended = pd.DataFrame({"trip": both["trip"].to_numpy()[ends], "sequence": now[ends], "captured": at[ends], "run": runs[ends], "reached": stops})
        first, end = since[up] // 1_000_000, at[up] // 1_000_000
        found = pd.DataFrame({
            "trip_id": both["trip"].to_numpy()[up], "stop_sequence": now[up].astype("int32"), "stop_id": both["stop_id"].to_numpy()[up], "trip_run": runs[up].astype("int32"), "actual_arrival_ts": pd.to_datetime((first + end) // 2, unit="s"),
            "arrival_bracket_sec": (end - first).astype("int32"), "sequence_jump": (now[up] - now[places - 1]).astype("int32"), "arrival_confident": end - first <= self.limit, "observed_at_utc": pd.to_datetime(at[up], unit="us"),
        })
        return found, pd.concat([known[~known["trip"].isin(ended["trip"])], ended], ignore_index=True)


def observed_arrivals(stream: DataFrame, settings: Settings = DEFAULT, delay: str = "4 hours", idle: str = "1 day", buckets: int = 1024) -> DataFrame:
    """Arrivals as vehicles' stop sequences rise, with run numbers; needs captured_at, trip_id, stop_sequence, stop_id.

    Sightings wait in the state of their trip's bucket until the watermark has passed them, and are then taken in the
    order of capture, so that the order in which batches bring them does not matter. A batch only adds to the list; a
    timer reads it. A trip's state ends some idle time after its last sighting. The number of buckets bounds the tasks
    that share the work and must stay what it was when a checkpoint began.
    """
    with_rocksdb(stream.sparkSession)
    rows = stream.withWatermark("captured_at", delay).where("trip_id is not null")
    keyed = rows.select(F.pmod(F.hash("trip_id"), F.lit(buckets)).alias("bucket"), "trip_id", "captured_at", "stop_sequence", "stop_id").groupBy("bucket")
    return keyed.transformWithStateInPandas(_Arrivals(settings.max_bracket_sec, int(pd.Timedelta(idle).total_seconds() * 1000)), _ARRIVED, "append", "eventTime")


_RECENT = "from_stop_id string, to_stop_id string, completed_at timestamp, roll_median double, roll_mean double, roll_delay_mean double, roll_n int, roll_deviation double, seen long"


class _Conditions(StatefulProcessor):
    """Of a segment: a histogram of all its durations, and its N newest completions, in whatever order they come."""

    def __init__(self, n: int, age_ms: int) -> None:
        self.n, self.age_ms = n, age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getValueState("history", "values array<double>, counts array<bigint>")
        self.newest = handle.getListState("newest", "completed long, duration double, delay double")

    def _row(self, key: tuple[Any, ...], *values: Any) -> pd.DataFrame:
        return pd.DataFrame([(*key, *values)], columns=[c.split()[0] for c in _RECENT.split(", ")]).astype({"completed_at": "datetime64[us]"})

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        history = History()
        if self.history.exists():
            history.values, history.counts = (np.array(x, t) for x, t in zip(self.history.get(), (float, np.int64), strict=True))
        newest = [tuple(x) for x in self.newest.get()] if self.newest.exists() else []
        for batch in rows:
            batch = batch.dropna(subset=["actual_arrival_ts", "actual_duration_sec"])
            duration = batch["actual_duration_sec"].to_numpy(float)
            history.take(*np.unique(duration, return_counts=True), len(batch))
            at = _micros(batch["actual_arrival_ts"])
            own = np.lexsort((duration, at))[-self.n :]  # no other can be among the newest
            late = [None if pd.isna(x) else float(x) for x in batch["delay_sec"].iloc[own]]
            newest = sorted([*newest, *zip(at[own].tolist(), duration[own].tolist(), late, strict=True)], key=lambda h: h[:2])[-self.n :]
        if not newest:
            return
        self.history.update((history.values.tolist(), history.counts.tolist()))
        self.newest.put(newest)
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(newest[-1][0] // 1000 + self.age_ms + 1)
        delays = [h[2] for h in newest if h[2] is not None]
        durations = [h[1] for h in newest]
        apart = [d - m for d, m in zip(reversed(durations), history.medians_without(durations[::-1]), strict=True) if m is not None]
        mean = lambda x: statistics.fmean(x) if x else None
        yield self._row(key, pd.Timestamp(newest[-1][0], unit="us"), statistics.median(durations), mean(durations), mean(delays), len(newest), mean(apart), int(history.counts.sum()))

    def handleExpiredTimer(self, key: tuple[Any, ...], timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Too old to be used; the history stays, for the medians of what may come."""
        yield self._row(key, pd.NaT, None, None, None, 0, None, sum(self.history.get()[1]))


def recent_conditions(stream: DataFrame, settings: Settings = DEFAULT, delay: str = "1 hour") -> DataFrame:
    """Statistics of each segment's last N completions whenever they change, as a lookup for scoring; roll_n is 0 once they are too old.

    ``seen`` counts the segment's completions, so that of its rows the one with the most is in force. The deviation of
    the i-th newest is from the median of all but the i newest, which the histogram without those tells at once.
    """
    with_rocksdb(stream.sparkSession)
    keyed = stream.withWatermark("actual_arrival_ts", delay).select("from_stop_id", "to_stop_id", "actual_arrival_ts", "actual_duration_sec", "delay_sec").groupBy("from_stop_id", "to_stop_id")
    return keyed.transformWithStateInPandas(_Conditions(settings.rolling_traversals, settings.rolling_max_age_sec * 1000), _RECENT, "append", "eventTime")
