"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target number of words by weight. A target over the source's size means whole repeats plus
a fractional inclusion probability, the same for all documents of the source. The flight phase of the cube method
moves those probabilities, three documents at a time, along the one direction in which neither the expected number
of documents nor the expected number of words changes, until one of the three is 0 or 1. Shards of a source fly
apart from each other, leave two undecided documents each, and those fly again together; the small landing problem
at the end is solved by trying all outcomes of at most ``landing`` + 2 documents.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source of its own, ranked last;
rows alike are numbered and mixed one by one; an empty table gives an empty result. Further columns are left out here.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramloom.llm.common import OWN, col, materialize, n_words, small, without

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3.0
SHARD_ROWS = 512
#: Rows alike that are numbered together.
PORTION = 4096
#: Undecided documents of one source that one task may land; with more, they fly again in shards.
LANDING_ROWS = 4096
LANDING = 12
_EPS = 1e-9


def source_targets(sizes: dict[str | None, int], weights: Iterable[float] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> dict[str | None, float]:
    """Share the total size among sources by repeating weights in code-point order, null last; no target over max_repeat x size."""
    w = list(weights)
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: float(w[i % len(w)]) for i, s in enumerate(order)}
    target: dict[str | None, float] = {}
    rest, free = float(sum(sizes.values())), list(order)
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > max_repeat * sizes[s]]
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = max_repeat * sizes[s]
            rest -= target[s]
        free = [s for s in free if s not in target]
    return target


def flight(prob: list[float], size: list[int], rng: random.Random) -> list[float]:
    """Move probabilities within the null space of (count, size) until at most two are neither 0 nor 1."""
    p, active = list(prob), []
    for i, x in enumerate(p):
        if not _EPS < x < 1 - _EPS:
            p[i] = float(round(x))
            continue
        active.append(i)
        if len(active) < 3:
            continue
        a, b, c = active
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if not any(u):
            u = (1, -1, 0)
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(active, u, strict=True) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(active, u, strict=True) if v)
        step = up if rng.random() * (up + down) < down else -down
        for i, v in zip(active, u, strict=True):
            p[i] += step * v
            if p[i] < _EPS or p[i] > 1 - _EPS:
                p[i] = float(round(p[i]))
        active = [i for i in active if 0 < p[i] < 1]
    return p


def land(prob: list[float], size: list[int], rng: random.Random, landing: int = LANDING) -> list[float]:
    """Fly all but the last ``landing`` documents, then take the outcome of the rest that comes nearest both totals."""
    cut = max(0, len(prob) - landing)
    p = flight(prob[:cut], size[:cut], rng) + list(prob[cut:])
    free = [i for i, x in enumerate(p) if _EPS < x < 1 - _EPS]
    if free:
        outcomes = (np.arange(1 << len(free))[:, None] >> np.arange(len(free))) & 1
        s, x = np.array([size[i] for i in free], float), np.array([p[i] for i in free])
        miss = np.abs(outcomes @ s - x @ s) + 1e-3 * max(1.0, s.mean()) * np.abs(outcomes.sum(1) - x.sum())
        for i, v in zip(free, outcomes[int(miss.argmin())], strict=True):
            p[i] = float(v)
    return [float(round(x)) for x in p]


def _decide(seed: int, last: bool):
    def decide(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["order"].to_pylist(), table["size"].to_pylist(), table["prob"].to_pylist(), table["held"].to_pylist(), range(table.num_rows), strict=True))
        rng = random.Random(f"{seed}:{key[0].as_py()}:{key[1].as_py()}:{last}")
        size, prob = [r[1] for r in rows], [r[2] for r in rows]
        if last:
            got = land(prob, size, rng)
        else:
            fly = [i for i, r in enumerate(rows) if not r[3]]
            got = list(prob)
            for i, x in zip(fly, flight([prob[i] for i in fly], [size[i] for i in fly], rng), strict=True):
                got[i] = x
        back = [0.0] * len(rows)
        for r, x in zip(rows, got, strict=True):
            back[r[4]] = x
        return table.set_column(table.schema.get_field_index("prob"), "prob", pa.array(back, pa.float64()))

    return decide


def mix_sources(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: Iterable[float] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = 17) -> DataFrame:
    """key, source, size, source_size, target, copies and taken of every row of docs.

    What passes through the driver is one total per source. Sources are what a mix has weights for; of texts and
    documents nothing is gathered. Only ids and sizes shuffle, by (source, shard) with at most a few hundred rows
    each, so that a source with a third of all rows is spread like any other.
    """
    spark = docs.sparkSession
    base = docs.select(col(key).alias("id"), col(source).alias("source"), n_words(col(text)).alias("size"), F.xxhash64(col(key), col(text), F.lit(seed)).alias("mix_key"))
    alike = base.groupBy(*base.columns).agg(F.count("*").alias("n"))
    # rows alike go to shards of their own choice; a group's numbers are made in portions, each in a task of its own
    portions = alike.select(*base.columns, "n", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {PORTION}"))).alias("portion")).repartition("mix_key", "portion")
    number = F.explode(F.sequence(F.col("portion") * PORTION + 1, F.least(F.col("n"), (F.col("portion") + 1) * PORTION))).alias("number")
    base = materialize(portions.select(*base.columns, number).select(*base.columns, F.when(F.col("number") == 1, F.col("mix_key")).otherwise(F.xxhash64("mix_key", "number")).alias("order")), "mix-sizes")
    totals = [(r["source"], r["size"], r["n"]) for r in base.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).toLocalIterator()]
    targets = source_targets({s: n for s, n, _ in totals}, weights, max_repeat)
    known = spark.createDataFrame([(s, n, targets[s], rows) for s, n, rows in totals], f"src {base.schema['source'].dataType.simpleString()}, source_size long, target double, n long")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(_EPS))
    rows = base.join(small(known), F.col("source").eqNullSafe(F.col("src"))).drop("src")
    rows = rows.withColumn("whole", whole.cast("long")).withColumn("prob", F.greatest(F.lit(0.0), ratio - whole))
    # of each source, about LANDING documents wait for the landing
    rows = rows.withColumn("held", F.pmod(F.xxhash64("order"), F.col("n")) < LANDING)
    most, done, level = max((n for *_, n in totals), default=0), None, 0
    state = rows
    while True:
        divide = SHARD_ROWS * (SHARD_ROWS // 2) ** level  # a shard leaves two documents to the next level
        state = state.withColumn("shard", F.pmod(F.xxhash64("order", F.lit(level)), F.ceil(F.col("n") / F.lit(float(divide)))).cast("long"))
        state = materialize(state.groupBy("source", "shard").applyInArrow(_decide(seed, False), state.schema), "mix-flight")
        open_ = (F.col("prob") > _EPS) & (F.col("prob") < 1 - _EPS)
        decided = state.where(~open_)
        done = decided if done is None else done.unionByName(decided)
        state, level = state.where(open_), level + 1
        if 2 * math.ceil(most / divide) + 4 * LANDING <= LANDING_ROWS:
            break
    state = state.withColumn("shard", F.lit(0).cast("long"))
    done = done.unionByName(state.groupBy("source", "shard").applyInArrow(_decide(seed, True), state.schema))
    copies = F.col("whole") + F.round("prob").cast("long")
    return done.select(F.col("id").alias(key), F.col("source").alias(source), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "mix_key")


def _numbered(rows: DataFrame, rest: list[str]) -> DataFrame:
    """rows (with their group and its size n in own columns) with the number of each in its group, from 1.

    A group's rows are ordered by a hash of their other columns, so that reruns agree; of rows alike in all it doesn't
    matter which comes first. Groups are dealt into portions, which are counted; a row's number is that within its
    portion behind the rows of the portions before.
    """
    group, kind, deal = (f"{OWN}{x}" for x in ("mix", "kind", "deal"))
    rows = rows.withColumn(kind, F.xxhash64(*map(col, rest)) if rest else F.lit(0).cast("long"))
    rows = materialize(rows.withColumn(deal, F.pmod(F.monotonically_increasing_id(), F.expr(f"1 + {OWN}n div {PORTION}")).cast("int")), "mix-alike")
    counted = rows.groupBy(group, kind, deal).agg(F.count("*").alias(f"{OWN}own"))
    before = F.sum(f"{OWN}own").over(Window.partitionBy(group).orderBy(kind, deal)) - F.col(f"{OWN}own")
    found = rows.join(counted.withColumn(f"{OWN}before", before).drop(f"{OWN}own"), [group, kind, deal])
    number = F.col(f"{OWN}before") + F.row_number().over(Window.partitionBy(group, kind, deal).orderBy(group))
    return found.withColumn(f"{OWN}number", number).drop(kind, deal, f"{OWN}before")


def take(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The documents that the mix takes, whole, with size, source_size, target, copies and taken.

    Of rows alike in key and text the copies go to as many rows as there are, as evenly as whole copies allow, those
    left over by the order of a hash of their other columns. Columns of the input
    named like the five give way to them.
    """
    docs = without(docs, "size", "source_size", "target", "copies", "taken")
    seed = options.get("seed", 17)
    chosen = mix_sources(docs, text, key, source, **options).groupBy(F.col("mix_key").alias(f"{OWN}mix"))
    chosen = chosen.agg(F.max("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("copies").alias(f"{OWN}all"), F.count("*").alias(f"{OWN}n")).where(f"{OWN}all > 0")
    chosen = materialize(chosen, "mix-chosen")
    keyed = docs.withColumn(f"{OWN}mix", F.xxhash64(col(key), col(text), F.lit(seed)))
    each, more = F.expr(f"{OWN}all div {OWN}n"), F.col(f"{OWN}all") % F.col(f"{OWN}n")
    plain = keyed.join(chosen.where(more == 0).hint("merge"), f"{OWN}mix").withColumn("copies", each)  # one plan at every size
    # only rows alike can share unevenly
    placed = _numbered(keyed.join(small(chosen.where(more > 0)), f"{OWN}mix"), [c for c in docs.columns if c not in (key, text)])
    joined = plain.unionByName(placed.withColumn("copies", each + (F.col(f"{OWN}number") <= more).cast("long")).drop(f"{OWN}number"))
    joined = joined.where("copies > 0").withColumn("taken", F.col("copies") * F.col("size"))
    return joined.select(*map(col, docs.columns), "size", "source_size", "target", "copies", "taken")
