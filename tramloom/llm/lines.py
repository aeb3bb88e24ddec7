"""Line dedup: two Bloom filters find suspected repeats, and only those are shuffled and confirmed.

A first pass over the texts sets each document's distinct line keys in a pair of filters, one for what was seen once and
one for what was seen twice. Filters have BITS bits for each line that was counted and consist of segments of a fixed
size, by hash: tasks send the bits that they set, and each segment is merged on its own. A second pass probes the
filter of what was seen twice and emits the digests of suspected lines; their documents are counted exactly and the
keeper of each line is chosen. A filter of up to FILTER_BYTES is broadcast to the second pass; of a larger one, the
lines' hashes go to their segments, a hot segment in parts. Either way gives the same suspects.

Defined results: null is one empty line and stays null; a document is a row, so rows alike each count and are both
keepers; a null id is below all others; a line without a non-null id among its documents stays everywhere. Columns of
the input named like the two counts give way to them.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import OWN, binary, col, map_rows, materialize, slices, spread_join, text_hash, without

MIN_CHARS = 40
MIN_DOCS = 5
#: Bits of each filter a line; log2 of a segment's bits; bytes of filter that may be broadcast.
BITS, SEGMENT_BITS, FILTER_BYTES = 12, 20, 64_000_000
#: Lines whose bits a task holds before it sends them.
FLUSH = 500_000


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return line.strip().lower()


def eligible(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def doc_keys(text: bytes, min_chars: int) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if eligible(k, min_chars)}


def hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def places(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash, and its two bits there as (n, 2). ``segments`` is a power of two."""
    mask = np.uint64((1 << SEGMENT_BITS) - 1)
    segment = (h >> np.uint64(2 * SEGMENT_BITS)) & np.uint64(segments - 1)
    return segment.astype(np.int64), np.stack([h & mask, (h >> np.uint64(SEGMENT_BITS)) & mask], axis=1).astype(np.int64)


def _fill(segments: int, min_chars: int):
    """For mapInArrow over texts: of each segment the bits set once or more, those set twice or more, and its lines."""

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        segment, at = places(np.concatenate(held), segments)
        bits, n = np.unique(((segment << SEGMENT_BITS)[:, None] | at).ravel(), return_counts=True)
        own, lines = np.unique(segment, return_counts=True)
        low, high = (np.searchsorted(bits, x << SEGMENT_BITS) for x in (own, own + 1))
        flat = (bits & ((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
        once = [flat[a:b].tobytes() for a, b in zip(low, high, strict=True)]
        twice = [flat[a:b][n[a:b] > 1].tobytes() for a, b in zip(low, high, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(lines), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["segment", "n", "once", "twice"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in slices(batches, 1000):
            held.append(hashes([k for t in binary(b, "text") for k in doc_keys(t, min_chars)]))
            n += len(held[-1])
            if n >= FLUSH:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    return fill


def _merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    once, twice = np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
    for a, b in zip(table["once"], table["twice"], strict=True):
        a, b = (np.frombuffer(x.as_py(), np.uint32) for x in (a, b))
        twice[a[once[a]]] = True
        once[a] = True
        twice[b] = True
    return pa.table({"segment": [key[0].as_py()], "n": [sum(table["n"].to_pylist())], "bits": [zlib.compress(np.packbits(twice, bitorder="little").tobytes(), 1)]}, schema=pa.schema([("segment", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())]))


def repeat_filter(docs: DataFrame, text: str, min_chars: int, bits: int = BITS) -> tuple[DataFrame, int]:
    """(segment, n: lines sent to it, bits: packed bits of what at least two documents hold), and the number of segments."""
    lines = docs.agg(F.sum(F.regexp_count(col(text), F.lit(f"[^\n]{{{min_chars},}}")))).first()[0] or 0
    segments = 1 << max(0, math.ceil(math.log2(max(1, lines) * bits / (1 << SEGMENT_BITS))))
    sent = docs.select(col(text).alias("text")).mapInArrow(_fill(segments, min_chars), "segment long, n long, once binary, twice binary")
    return materialize(sent.groupBy("segment").applyInArrow(_merge, "segment long, n long, bits binary"), "line-filter"), segments


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _keys_of(batch: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, list[bytes]]:
    """Distinct keys of each row, with the row."""
    own = [doc_keys(t, min_chars) for t in binary(batch, "text")]
    return np.repeat(np.arange(len(own)), [len(x) for x in own]), [k for x in own for k in x]


def suspects_by_broadcast(source: DataFrame, filters: DataFrame, segments: int, min_chars: int, shape: str) -> DataFrame:
    whole = np.zeros((segments, (1 << SEGMENT_BITS) // 8), np.uint8)
    for r in filters.select("segment", "bits").toLocalIterator():
        whole[r["segment"]] = np.frombuffer(zlib.decompress(bytes(r["bits"])), np.uint8)
    shared = source.sparkSession.sparkContext.broadcast(whole.tobytes())

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, np.uint8)
        for b in slices(batches, 1000):
            row, keys = _keys_of(b, min_chars)
            segment, at = places(hashes(keys), segments)
            at = at | (segment << SEGMENT_BITS)[:, None]
            hit = np.flatnonzero(((twice[at >> 3] >> (at & 7)) & 1).all(1))
            rows = pa.array(row[hit])
            yield pa.RecordBatch.from_arrays([b.column("id").take(rows), b.column("th").take(rows), pa.array([_digest(keys[i]) for i in hit], pa.binary())], names=["id", "th", "digest"])

    return source.mapInArrow(suspect, shape)


def suspects_by_shuffle(source: DataFrame, filters: DataFrame, segments: int, min_chars: int, shape: str) -> DataFrame:
    """The same where the filter is too large to broadcast: hashes stream past their segment's bits, which come first."""
    names = [x.split()[0] for x in shape.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1000):
            row, keys = _keys_of(b, min_chars)
            h = hashes(keys)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("id").take(rows), b.column("th").take(rows), pa.array(map(_digest, keys), pa.binary(), size=len(keys)), pa.array(h.view(np.int64)), pa.array(places(h, segments)[0])], names=[*names, "h", "segment"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, now = None, None
        for b in batches:
            segment, kind = b.column("segment").to_numpy(), b.column("bits").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, (segment[1:] != segment[:-1]) | kind[1:] | kind[:-1], True])
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if kind[low]:
                    bits, now = np.frombuffer(zlib.decompress(b.column("bits")[low].as_py()), np.uint8), segment[low]
                elif segment[low] == now:
                    at = places(b.column("h").slice(low, high - low).to_numpy().view(np.uint64), segments)[1]
                    hit = pa.array(low + np.flatnonzero(((bits[at >> 3] >> (at & 7)) & 1).all(1)))
                    yield pa.RecordBatch.from_arrays([b.column(c).take(hit) for c in names], names=names)

    keyed = source.mapInArrow(emit, f"{shape}, h long, segment long").withColumn("bits", F.lit(None).cast("binary"))
    total, deal = filters.agg(F.sum("n")).first()[0] or 0, int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.ceil(F.col("n") / F.lit(max(1024, 2 * total // deal))).cast("int")
    hot = filters.where(parts > 1).select("segment", parts.alias("parts"))  # fewer than half the partitions
    keyed = keyed.join(F.broadcast(hot), "segment", "left").withColumn("part", F.pmod(F.xxhash64("id", "th"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    bits = filters.select("segment", "bits", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), parts - 1))).alias("part"))
    both = keyed.unionByName(bits, allowMissingColumns=True).repartition("segment", "part").sortWithinPartitions("segment", "part", F.desc_nulls_last("bits"))
    return both.mapInArrow(probe, shape)


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, filter_bytes: int = FILTER_BYTES, bits: int = BITS) -> DataFrame:
    """(id, th, drops): for each row with lines to drop, the digests of their keys. th is text_hash(text)."""
    filters, segments = repeat_filter(docs, text, min_chars, bits)
    shape = f"id {docs.schema[key].dataType.simpleString()}, th long, digest binary"
    source = docs.select(col(key).alias("id"), text_hash(col(text)).alias("th"), col(text).alias("text"))
    way = suspects_by_broadcast if segments << SEGMENT_BITS <= 8 * filter_bytes else suspects_by_shuffle
    suspects = materialize(way(source, filters, segments, min_chars, shape), "lines")
    repeated = suspects.groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where((F.col("n") >= min_docs) & F.col("keeper").isNotNull())
    drops = spread_join(suspects, materialize(repeated, "repeated-lines"), "digest", "n").where(~F.col("id").eqNullSafe(F.col("keeper")))
    return drops.groupBy("id", "th").agg(F.collect_set("digest").alias("drops"))


def drop_lines(text: bytes, drops: set[bytes], min_chars: int) -> tuple[bytes, int, int]:
    """The kept lines joined by LF, the number of lines before, the number dropped."""
    lines = text.split(b"\n")
    if not drops:
        return text, len(lines), 0
    kept = [x for x in lines if not (eligible(k := line_key(x), min_chars) and _digest(k) in drops)]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, filter_bytes: int = FILTER_BYTES, bits: int = BITS, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """docs with text rewritten and two counts added, of lines before and of lines dropped; all rows and other columns stay."""
    docs = without(docs, *counts)
    own = repeated_lines(docs, text, key, min_chars, min_docs, filter_bytes, bits).select(*[F.col(c).alias(OWN + c) for c in ("id", "th", "drops")])
    joined = docs.join(own, col(key).eqNullSafe(F.col(f"{OWN}id")) & (text_hash(col(text)) == F.col(f"{OWN}th")), "left").drop(f"{OWN}id", f"{OWN}th")
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1000):
            kept, n, dropped = [], [], []
            texts = b.column(text)
            for t, d in zip(texts.cast(pa.binary()).to_pylist(), b.column(f"{OWN}drops").to_pylist(), strict=True):
                k, total, gone = drop_lines(t or b"", set(d or ()), min_chars)
                kept.append(None if t is None else k)
                n.append(total)
                dropped.append(gone)
            new = pa.array(kept, pa.binary()).cast(texts.type)
            yield pa.RecordBatch.from_arrays([*[new if c == text else b.column(c) for c in names], pa.array(n, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *counts])

    return map_rows(joined, rewrite, names, dict.fromkeys(counts, "long"))
