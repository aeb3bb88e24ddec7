"""SimHash near-duplicate classes found with BK-trees.

Fingerprints of all documents are reduced to distinct ones. By the pigeonhole rule two fingerprints within ``radius``
bits agree on ``blocks - radius`` of ``blocks`` blocks, so each choice of such blocks is a key, and what shares a key
is one shard with a BK-tree of its own. A shard's tree and its queries meet in the same task by one shuffle on the key;
a broadcast of all trees would grow with the corpus. Within a tree only edges inside the radius are followed. What a
task finds leaves it as a spanning forest, never as all pairs, and components are then joined across shards.

Defined results: a null or empty text has fingerprint zero and links like any other; a null id never names a component
(null if its component has no other id); rows alike get like results; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.llm.bktree import Forest, find, unite
from tramloom.llm.common import OWN, binary, col, materialize, mix64, slices, small, spread_join, text_hash, whole_groups, without
from tramloom.llm.graph import components

SEED = 42
RADIUS = 3
#: Fingerprints of one shard that a task takes at once; larger shards are compared in blocks of two parts.
SHARD = 20_000


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64, seed 42, of every run of ``size`` words joined by a space; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - size]]
    return np.fromiter((digest(whole[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=True)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is 1 in over half the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str, key: str, shingle: int) -> DataFrame:
    """(key, fp: the fingerprint as a signed long) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1000):
            fp = np.array([fingerprint(shingle_hashes(t.lower().split(), shingle)) for t in binary(b, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def block_masks(radius: int, rows: int, bits: int = 64) -> list[int]:
    """Masks such that codes within the radius agree under one at least. More rows get longer keys, so that shards stay small."""
    blocks = radius + 1 if rows < 1 << 24 else radius + 3 if rows < 1 << 34 else radius + 5
    edges = [bits * i // blocks for i in range(blocks + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [sum(block[i] for i in some) for some in itertools.combinations(range(blocks), blocks - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def dealt(keyed: DataFrame, room: int, weight: Column) -> DataFrame:
    """keyed (key, item, ...) with (low, high, part) added, such that any two items of a key share a group (key, low, high).

    A key that weighs more than ``room`` is dealt into parts, and every pair of parts becomes a group of its own.
    """
    hot = keyed.groupBy("key").agg(F.sum(weight).alias("n")).where(F.col("n") > room).withColumn("parts", F.ceil(F.col("n") / room).cast("int")).select("key", "parts")
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("item"), parts).cast("int")
    rows = keyed.join(small(materialize(hot, "hot-shards")), "key", "left").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return rows.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("parts", "other")


_GROUP = ("key", "low", "high")


def sharded(keyed: DataFrame, shard: int = SHARD) -> DataFrame:
    """keyed (key, item, ...) dealt such that any two items of a key meet in one task, in groups (key, low, high) one after the other."""
    return dealt(keyed, shard, F.lit(1)).drop("part").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "item")


def _numbered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A number for the group of each row, and the items, of rows sorted by group and item."""
    columns = [table[c].to_numpy() for c in _GROUP]
    return np.cumsum(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]), table["item"].to_numpy()


def _forest(parent: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
    root = find(parent, np.arange(len(item)))
    linked = np.flatnonzero(root != np.arange(len(item)))
    return pa.RecordBatch.from_arrays([pa.array(item[linked]), pa.array(item[root[linked]])], names=["u", "v"])


def linker(radius: int):
    """For mapInArrow over sharded rows (key, low, high, item, fp): a spanning forest (u, v) of each group's links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _GROUP, 5 * SHARD):
            group, item = _numbered(table)
            parent = np.arange(len(item))
            for a, b in Forest(table["fp"].to_numpy().view(np.uint64), group).pairs(radius):
                unite(parent, a, b)
            yield _forest(parent, item)

    return run


def likeness_linker(radius: int, least: float):
    """As linker, for rows that carry a sketch: a spanning forest of the pairs within the radius that look alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _GROUP, SHARD):
            group, item = _numbered(table)
            sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
            parent = np.arange(len(item))
            for a, b in Forest(table["fp"].to_numpy().view(np.uint64), group).pairs(radius):
                for at in range(0, len(a), 65536):
                    i, j = a[at : at + 65536], b[at : at + 65536]
                    apart = find(parent, i) != find(parent, j)
                    i, j = i[apart], j[apart]
                    alike = ((sketches[i] == sketches[j]).mean(1) * 256 - 1) / 255 >= least
                    unite(parent, i[alike], j[alike])
            yield _forest(parent, item)

    return run


def keys(fp: Column, masks: list[int]) -> Column:
    return F.array(*[F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)])


def simhash_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """key, fingerprint (hex) and component_id (least key reachable over links of at most ``radius`` bits) of every row."""
    prints = materialize(fingerprints(docs, text, key, shingle), "simhash")
    reps = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "simhash-distinct")
    masks = block_masks(radius, reps.count())
    keyed = reps.select(F.explode(keys(F.col("fp"), masks)).alias("key"), F.col("fp").alias("item"), "fp")
    edges = sharded(keyed, shard).mapInArrow(linker(radius), "u long, v long")
    found = components(edges)
    names = found.join(reps, F.col("node") == F.col("fp")).groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("n"))
    names = spread_join(found, materialize(names, "simhash-names"), "component", "n", by=["node"]).select(F.col("node").alias("fp"), F.col("least"))
    named = reps.join(names, "fp", "left").select("fp", "n", F.when(F.col("least").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id"))
    named = spread_join(prints, materialize(named, "simhash-named"), "fp", "n")
    return named.select(F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- near duplicates by similarity -------------------------------------------------------------------------------

#: Bands of minima that send like documents to a common shard: at a similarity of 0.8, 1 - (1 - 0.8**3)**10 = 99.9 %.
BANDS, ROWS = 10, 3
#: Sketch bytes by which a link's similarity is measured (standard error 0.029 at 0.8).
SKETCH = 192
#: Pairs whose measured similarity is at most this under the threshold are candidates, settled on whole sets.
DOUBT = 0.09
#: Shingles of one group of candidates that a task takes at once; larger groups are compared in blocks of two parts.
SET_ROOM = 4_000_000
#: At a similarity of 0.8 the fingerprints of two documents differ in about 10 bits, and hardly ever in more than these.
SIMILAR_RADIUS = 26
_XOR, _TIMES = (mix64(np.arange(k, SKETCH + k, dtype=np.uint64)).astype(np.uint32) | np.uint32(1) for k in (1, 1 << 20))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least values (uint32) of the set of hashes under SKETCH permutations."""
    h = np.unique(mix64(hashes).astype(np.uint32))
    least = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 512):
        np.minimum(least, ((h[None, at : at + 512] ^ _XOR[:, None]) * _TIMES[:, None]).min(1), out=least)
    return least


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, similarity: float = 0.8, shard: int = SHARD, room: int = SET_ROOM) -> DataFrame:
    """(key, th, class_id): the class of every row, by links of at least ``similarity`` between sets of word shingles.

    Equal word sequences form one item first, so that copies are never compared. Items meet in shards by bands of
    minima, since at a similarity of 0.8 fingerprints differ in too many bits for common blocks; in a shard, the
    BK-tree over SimHash fingerprints finds partners within SIMILAR_RADIUS and sketches carried along measure them. What
    may be alike forms groups of candidates, and no link holds but by the whole sets of shingles (settle).
    ``th`` is text_hash(text): with the key it finds the row again. class_id is a hash that names the class.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, th long, item long, fp long, n long, bands array<long>, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1000):
            item, fp, n, bands, sketch = [], [], [], [], []
            for t in binary(b, "text"):
                words = t.lower().split()
                h = np.unique(shingle_hashes(words, shingle))  # a set, so that repeats move no bits
                least = minima(h)
                item.append(signed(xxhash.xxh3_64_intdigest(b" ".join(words), SEED)))
                fp.append(signed(fingerprint(h)))
                n.append(len(h))
                bands.append([signed(xxhash.xxh64_intdigest(least[i * ROWS : i * ROWS + ROWS].tobytes(), i)) for i in range(BANDS)])
                sketch.append((least & np.uint32(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(item, pa.int64()), pa.array(fp, pa.int64()), pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())], names=["id", "th", "item", "fp", "n", "bands", "sketch"])

    rows = materialize(docs.select(col(key).alias("id"), text_hash(col(text)).alias("th"), col(text).alias("text")).mapInArrow(run, schema), "near")
    items = rows.groupBy("item").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    copies = materialize(rows.groupBy("item").agg(F.count("*").alias("copies")), "near-copies")
    keyed = items.select(F.explode("bands").alias("key"), "item", "fp", "sketch")
    live = materialize(rows.select("item", "bands").groupBy("item").agg(F.first("bands").alias("bands")).select(F.explode("bands").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-bands")
    found = sharded(spread_join(keyed, live, "key", "n", by=["item"]), shard).mapInArrow(likeness_linker(SIMILAR_RADIUS, similarity - DOUBT), "u long, v long")
    groups = materialize(components(found).select(F.col("node").alias("item"), F.col("component").alias("key")).join(copies, "item"), "near-groups")
    source = docs.select(col(key).alias("id"), text_hash(col(text)).alias("th"), col(text).alias("text"))
    found = components(settle(groups, rows.select("id", "th", "item", "fp", "n"), source, shingle, similarity, room))
    found = materialize(found.join(copies, F.col("node") == F.col("item")).select("item", "component", "copies"), "near-classes")
    return spread_join(rows.select("id", "th", "item"), found, "item", "copies", "left").select(F.col("id").alias(key), "th", F.coalesce("component", "item").alias("class_id"))


def settle(groups: DataFrame, rows: DataFrame, source: DataFrame, shingle: int, similarity: float, room: int) -> DataFrame:
    """Links (u, v) that span the classes of each group (item, key), by the similarity of whole sets of word shingles.

    One row stands for each item, and its set is shuffled once, or once for each part of a group with more than ``room``.
    """
    first = spread_join(rows, groups, "item", "copies").groupBy("item", "key").agg(F.min(F.struct("th", "id", "fp", "n")).alias("r"))
    places = dealt(first.select("item", "key", F.col("r.th").alias("wth"), F.col("r.id").alias("wid"), F.col("r.fp").alias("fp"), F.col("r.n").alias("n")), room, F.col("n"))
    wanted = places.groupBy("item", "wth", "wid").agg(F.collect_list(F.struct("key", "low", "high", "part", "item", "fp")).alias("places")).drop("item")
    texts = source.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth"))).select("text", "places")
    schema = "key long, low int, high int, part int, item long, fp long, held binary"

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # of rows alike, a task sends one
        for b in slices(batches, 200):
            put: list[dict] = []
            held: list[bytes] = []
            for t, own in zip(binary(b, "text"), b.column("places").to_pylist(), strict=True):
                if own[0]["item"] in sent:
                    continue
                sent.add(own[0]["item"])
                put += own
                held += [np.unique(shingle_hashes(t.lower().split(), shingle)).tobytes()] * len(own)
            types = {"key": pa.int64(), "low": pa.int32(), "high": pa.int32(), "part": pa.int32(), "item": pa.int64(), "fp": pa.int64()}
            yield pa.RecordBatch.from_arrays([*[pa.array([x[c] for x in put], t) for c, t in types.items()], pa.array(held, pa.binary())], names=[*types, "held"])

    return texts.mapInArrow(sets, schema).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "item").mapInArrow(set_linker(SIMILAR_RADIUS, similarity), "u long, v long")


def set_linker(radius: int, similarity: float, room: int = SET_ROOM):
    """For mapInArrow over rows (key, low, high, part, item, fp, held: the sorted set): a spanning forest (u, v) of each group's links.

    Every pair within the radius is compared exactly unless its items are joined by then. Of a group of two parts
    only the pairs across them are looked at, since each part is a group too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _GROUP, 1):
            group, item = _numbered(table)
            once = np.r_[True, (group[1:] != group[:-1]) | (item[1:] != item[:-1])]  # rows alike send a set again
            table, group, item = table.filter(pa.array(once)), group[once], item[once]
            fp, part = table["fp"].to_numpy().view(np.uint64), table["part"].to_numpy()
            across = table["low"].to_numpy() != table["high"].to_numpy()
            held = table["held"]
            ends = np.r_[np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)]
            low, size = 0, np.cumsum(pc.binary_length(held).to_numpy()) // 8
            for n, high in enumerate(ends.tolist()):  # some whole groups at a time
                if n + 1 < len(ends) and size[ends[n + 1] - 1] - (size[low - 1] if low else 0) <= room:
                    continue
                some = slice(low, high)
                u, v = _exact_links(fp[some], group[some], part[some], across[some], [np.frombuffer(x, np.uint64) for x in held[low:high].to_pylist()], radius, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(item[some][u]), pa.array(item[some][v])], names=["u", "v"])
                low = high

    return run


def _exact_links(fp: np.ndarray, group: np.ndarray, part: np.ndarray, across: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float, room: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
    flat = flat.astype(np.int32)
    marked, parent = np.zeros(len(kinds), bool), np.arange(len(sets))
    for a, b in Forest(fp, group).pairs(radius):
        # a pair of sets whose sizes are too far apart can't be alike
        keep = (~across[a] | (part[a] != part[b])) & (np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]))
        a, b = a[keep], b[keep]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        while len(a):
            apart = find(parent, a) != find(parent, b)
            a, b = a[apart], b[apart]
            now = max(1, int(np.searchsorted(np.cumsum(sizes[b[:4096]]), room)))
            i, j, a, b = a[:now], b[:now], a[now:], b[now:]
            common = np.zeros(len(i), np.int64)
            for low, high in itertools.pairwise([*np.flatnonzero(np.r_[True, i[1:] != i[:-1]]).tolist(), len(i)] if len(i) else []):
                own, many = flat[starts[i[low]] : starts[i[low]] + sizes[i[low]]], sizes[j[low:high]]
                marked[own] = True
                before = np.cumsum(many) - many
                hits = marked[flat[np.repeat(starts[j[low:high]] - before, many) + np.arange(many.sum())]]
                sums = np.r_[0, np.cumsum(hits)]
                common[low:high] = sums[before + many] - sums[before]
                marked[own] = False
            alike = common >= similarity * (sizes[i] + sizes[j] - common)
            unite(parent, i[alike], j[alike])
    root = find(parent, np.arange(len(sets)))
    linked = np.flatnonzero(root != np.arange(len(sets)))
    return linked, root[linked]


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near duplicates: of each class the row with the least key stays (null keys last), one of rows alike."""
    classes = near_duplicates(without(docs), text, key, shingle, similarity)
    ident = col(key)
    best = classes.groupBy("class_id").agg(F.min(F.struct(ident.isNull().alias("none"), ident.alias("id"), "th")).alias("k")).select(F.col("k.id").alias(f"{OWN}id"), F.col("k.th").alias(f"{OWN}th"))
    kept = docs.withColumn(f"{OWN}h", text_hash(col(text))).join(best.distinct(), ident.eqNullSafe(F.col(f"{OWN}id")) & (F.col(f"{OWN}h") == F.col(f"{OWN}th")), "left_semi")
    return one_of_alike(kept, key, f"{OWN}h").drop(f"{OWN}h")


def one_of_alike(df: DataFrame, key: str, th: str) -> DataFrame:
    """One of the rows with equal key and hash: that whose other columns have the least hash, so that reruns agree."""
    rest = [c for c in df.columns if c not in (key, th)]
    row = F.min_by(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(rest)]), F.xxhash64(*map(col, rest))).alias(f"{OWN}r")
    one = df.groupBy(col(key), col(th)).agg(row).select(col(key), col(th), *[F.col(f"{OWN}r.c{i}").alias(c) for i, c in enumerate(rest)])
    return one.select(*map(col, df.columns))
