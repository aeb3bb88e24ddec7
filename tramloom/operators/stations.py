"""Stations by name, scheduled journeys between platforms, and requests resolved to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramloom.functions import exprs as X
from tramloom.sources.tables import materialize


def platform_names(stops: DataFrame) -> DataFrame:
    """stop_id, code and name of each platform; the name is its station's, or its own where there is no station."""
    station = stops.select(F.col("stop_id").alias("__id"), F.col("stop_name").alias("__name"))
    rows = stops.join(station, F.col("parent_station") == F.col("__id"), "left")
    code = X.station_code_or_null(F.col("stop_id"))
    return rows.select("stop_id", code.alias("code"), F.coalesce("__name", "stop_name").alias("name")).where("code is not null")


def _modal(keys: list[str], value: str) -> Window:
    return Window.partitionBy(*keys).orderBy(F.desc("__n"), value)


def station_codes(stops: DataFrame) -> DataFrame:
    """code, its most frequent name (of equals the lower), and its platforms in order."""
    rows = platform_names(stops)
    named = rows.groupBy("code", "name").agg(F.count("*").alias("__n"), F.collect_set("stop_id").alias("p"))
    named = named.withColumn("r", F.row_number().over(_modal(["code"], "name")))
    return named.groupBy("code").agg(F.max(F.when(F.col("r") == 1, F.col("name"))).alias("name"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("p")))).alias("platforms"))


def station_index(stops: DataFrame) -> DataFrame:
    """Normalised name to station codes: some names stand for more than one code."""
    return station_codes(stops).groupBy(X.plain_name(F.col("name")).alias("station")).agg(F.array_sort(F.collect_set("code")).alias("codes"), F.min("name").alias("name"))


def ordered_pairs(stop_times: DataFrame) -> DataFrame:
    """Every (earlier, later) pair of stops of each trip, from one sorted array a trip: some hundreds for a trip of thirty stops."""
    stop = F.struct("stop_sequence", "stop_id", "scheduled_arrival_offset_sec", "route_id", "direction_id")
    trips = stop_times.groupBy("scheduled_trip_id").agg(F.array_sort(F.collect_list(stop)).alias("s"))
    trips = trips.select("scheduled_trip_id", "s", F.posexplode("s").alias("i", "a"))
    rows = trips.select("scheduled_trip_id", "i", "a", F.get("s", F.col("i") + 1)["stop_id"].alias("first_leg_to"), F.posexplode(F.slice("s", F.col("i") + 2, F.size("s"))).alias("j", "b")).where("b.stop_sequence > a.stop_sequence")
    return rows.select(
        "scheduled_trip_id", "a.route_id", "a.direction_id", F.col("a.stop_id").alias("origin"), F.col("b.stop_id").alias("destination"), F.col("a.scheduled_arrival_offset_sec").alias("leaves"), F.col("b.scheduled_arrival_offset_sec").alias("arrives"),
        "first_leg_to", (F.col("j") + 1).alias("legs"), (F.col("b.stop_sequence") - F.col("a.stop_sequence")).alias("span"),
    )


def _most(alike: str, field: str) -> Column:
    """The value of the field that most trips have, of equals the lower; alike is an array of structs with n."""
    known = F.array_compact(F.array_distinct(F.transform(alike, lambda x: x[field])))
    trips = lambda v: F.aggregate(F.filter(alike, lambda x: x[field] == v), F.lit(0).cast("long"), lambda acc, x: acc - x["n"])
    return F.array_min(F.transform(known, lambda v: F.struct(trips(v).alias("less"), v.alias("v"))))["v"]


def od_schedule(stop_times: DataFrame) -> DataFrame:
    """Scheduled time, stops and trips of each origin and destination by hour, and for all day (hour -1).

    Trips alike between two stops, nearly all of a timetable, are counted as one row first; both summaries are one
    aggregate of those.
    """
    same = ["legs", "span", "route_id", "direction_id", "first_leg_to"]
    pairs = ordered_pairs(stop_times.where("scheduled_arrival_offset_sec is not null"))
    pairs = pairs.groupBy("origin", "destination", X.hour_bucket(F.col("leaves")).alias("hour"), (F.col("arrives") - F.col("leaves")).alias("sec"), *same).agg(F.count("*").alias("n"))
    sets = pairs.groupingSets([[F.col("origin"), F.col("destination"), F.col("hour")], [F.col("origin"), F.col("destination")]], "origin", "destination", "hour")
    rows = sets.agg(F.bround(F.percentile("sec", F.lit(0.5), F.col("n")), 0).cast("long").alias("sched_sec"), F.sum("n").alias("trips"), F.collect_list(F.struct(*same, "n")).alias("alike"))
    most = [_most("alike", c).alias(name) for c, name in zip(same, ("n_segments", "stop_span", *same[2:]), strict=True)]
    return rows.select("origin", "destination", F.coalesce("hour", F.lit(-1)).alias("hour"), "sched_sec", *most[:2], "trips", *most[2:])


def resolve_requests(requests: DataFrame, codes: DataFrame, schedule: DataFrame) -> DataFrame:
    """requests (request_id, origin, destination, hour) with status and the one platform pair that serves them.

    status: unknown_station, not_connected, ambiguous (more than one pair) or ok. The hour's row is used if there is
    one, else the all-day row.
    """
    names = codes.select(X.plain_name(F.col("name")).alias("station"), F.explode("platforms").alias("platform"))
    known = names.select("station").distinct().withColumn("known", F.lit(True))
    asked = requests.select("request_id", X.plain_name(F.col("origin")).alias("o"), X.plain_name(F.col("destination")).alias("d"), F.col("hour").alias("asked_hour"))
    side = lambda c, alias: names.select(F.col("station").alias(c), F.col("platform").alias(alias))
    pairs = asked.join(side("o", "origin"), "o").join(side("d", "destination"), "d").join(schedule, ["origin", "destination"]).where((F.col("hour") == F.col("asked_hour")) | (F.col("hour") == -1))
    carried = ["sched_sec", "n_segments", "stop_span", "trips", "route_id", "direction_id", "first_leg_to"]
    best = F.max_by(F.struct("origin", "destination", "hour", *carried), F.struct("hour", "origin", "destination"))
    found = pairs.groupBy("request_id").agg(F.countDistinct("origin", "destination").alias("pairs"), best.alias("b"))
    both = asked.join(known.select(F.col("station").alias("o"), F.col("known").alias("ok")), "o", "left").join(known.select(F.col("station").alias("d"), F.col("known").alias("dk")), "d", "left").join(found, "request_id", "left")
    status = F.when(F.col("ok").isNull() | F.col("dk").isNull(), "unknown_station").when(F.coalesce("pairs", F.lit(0)) == 0, "not_connected").when(F.col("pairs") > 1, "ambiguous").otherwise("ok")
    sure = lambda c: F.when(F.col("status") == "ok", F.col(f"b.{c}")).alias(c)
    return both.withColumn("status", status).select("request_id", "status", *[sure(c) for c in ("origin", "destination", "hour", *carried)])


#: Letters of a gram; names a block of the index has.
GRAM, BLOCK = 2, 4096


def _grams(name: Column) -> Column:
    """(gram, number among its like) of a padded name: a multiset as a set."""
    padded = F.concat(F.lit("\u0001"), name, F.lit("\u0002"))
    each = F.transform(F.sequence(F.lit(1), F.length(name) + 3 - GRAM), lambda i: F.substring(padded, i, F.lit(GRAM)))
    return F.transform(each, lambda g, i: F.struct(g.alias("gram"), F.size(F.filter(F.slice(each, 1, i + 1), lambda x: x == g)).alias("nth")))


def _likeness(a: Column, b: Column) -> Column:
    return F.round(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)), 6)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asked").orderBy(F.desc("likeness"), "station")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_names(names: DataFrame, known: DataFrame, k: int = 3) -> DataFrame:
    """For each name the k known names most alike by edit distance over length; of equals the lower.

    An index of grams finds candidates. An edit spoils at most GRAM grams, so within d edits one of the d * GRAM + 1
    rarest grams of the asked name is shared, and the more a pair shares the less it can differ.

    1. What shares one of the asked name's rarest grams gives k names; the least alike of them sets a bound.
    2. The bound tells how many edits can beat it, how many of the rarest grams must be looked up, and which lengths
       can be alike enough. Only candidates that share enough grams are measured.
    3. Names so unlike all others that no gram need be shared are measured against all known names, a block of BLOCK
       at a time, each block giving its k best.
    """
    asked = names.select(X.plain_name(F.col("name")).alias("asked")).where("asked is not null").distinct()
    stations = known.select("station").where("station is not null").distinct()
    postings = materialize(stations.withColumn("n", F.length("station")).select("station", "n", F.explode(_grams(F.col("station"))).alias("g")).select("station", "n", "g.*"), "grams")
    often = postings.groupBy("gram", "nth").agg(F.count("*").alias("often"))
    own = asked.select("asked", F.length("asked").alias("m"), F.explode(_grams(F.col("asked"))).alias("g")).select("asked", "m", "g.*")
    own = own.join(often, ["gram", "nth"], "left").withColumn("often", F.coalesce("often", F.lit(0)))
    own = materialize(own.withColumn("place", F.row_number().over(Window.partitionBy("asked").orderBy("often", "gram", "nth"))), "asked-grams")

    met = own.where("often > 0").withColumn("first", F.row_number().over(Window.partitionBy("asked").orderBy("often", "gram", "nth"))).where("first <= 2")
    some = met.join(postings, ["gram", "nth"]).select("asked", "station").distinct()
    bound = _ranked(some.withColumn("likeness", _likeness(F.col("asked"), F.col("station"))), k).groupBy("asked").agg(F.min("likeness").alias("least"), F.count("*").alias("found"))
    # of lengths m and n, likeness >= least leaves (1 - least) * max(m, n) edits, and max(m, n) <= m / least
    least = F.col("least") - 1e-6
    edits = F.floor((1 - least) * F.greatest(F.col("m"), F.col("m") / least))
    judged = materialize(own.select("asked", "m").distinct().join(bound, "asked", "left").withColumn("edits", F.when((F.col("found") >= k) & (least > 0), edits)).withColumn("indexed", F.coalesce(F.col("edits") * GRAM + 1 <= F.col("m") + 1, F.lit(False))), "bounds")

    near = own.drop("m").join(judged.where("indexed"), "asked").where(F.col("place") <= F.col("edits") * GRAM + 1)
    pairs = near.join(postings, ["gram", "nth"]).where((F.least("m", "n") >= least * F.greatest("m", "n"))).select("asked", "station").distinct()
    best = _ranked(pairs.withColumn("likeness", _likeness(F.col("asked"), F.col("station"))), k)

    blocks = stations.groupBy(F.pmod(F.xxhash64("station"), F.lit(1 + stations.count() // BLOCK)).alias("block")).agg(F.collect_list("station").alias("held"))
    alike = F.transform("held", lambda s: F.struct((-_likeness(F.col("asked"), s)).alias("d"), s.alias("station")))
    rest = judged.where("not indexed").select("asked").join(blocks.hint("broadcast") if stations.count() <= BLOCK else blocks)
    rest = rest.select("asked", F.explode(F.slice(F.array_sort(alike), 1, k)).alias("b")).select("asked", "b.station", (-F.col("b.d")).alias("likeness"))
    return best.unionByName(_ranked(rest, k)).select("asked", "station", "likeness", "rank")
