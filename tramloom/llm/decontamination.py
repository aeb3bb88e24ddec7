"""Benchmark decontamination by a prefix-filtered join of shingles.

An item's windows of ``width`` consecutive words (one shorter window for a shorter item) must occur whole. The tokens of
a window are its shingles of GRAM words (of all its words, if fewer), ordered by their rarity in the corpus. For whole
containment the necessary prefix is the rarest one, so a window is joined to a document only where that shingle stands.
Its place in the window fixes where the window would start (positional bound), the document must have room for it (length
bound), and then the words are compared.

Windows, rarity and join are made in Spark. Only hashes of shingles are broadcast, 8 bytes each and at most HASH_BYTES at
once: with more, the documents are read once for each part. Corpus counts cover all documents, and a shingle that very
many documents have is joined in parts.

Defined results: null or wordless texts have no words and no hits; wordless items have no windows; a null item id
still marks words but is not listed; repeated items each count by id; rows alike get like results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import OWN, binary, col, materialize, mix64, slices, small, spread_join, text_hash
from tramloom.llm.substrings import word_hashes

WIDTH, GRAM = 10, 3
#: Bytes of shingle hashes that one broadcast holds.
HASH_BYTES = 32_000_000
#: ASCII letters A-Z to lower case, other ASCII but digits and a-z to a space; bytes from 0x80 are parts of words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words, by the hashes of the words."""
    n = max(0, len(hashes) - width + 1)
    x = np.full(n, width, np.uint64)
    for i in range(width):
        x = x * _STEP + hashes[i : i + n]
    return mix64(x)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return word_hashes(words)


class Vocabulary:
    """A set of 64-bit hashes, as a sorted array behind a table of their leading bits."""

    def __init__(self, known: np.ndarray) -> None:
        self.known = known
        self.lead = np.zeros(1 << 20, bool)
        self.lead[known >> np.uint64(44)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the set, and the place of each there."""
        some = np.flatnonzero(self.lead[h >> np.uint64(44)])
        if not len(some):
            return some, some
        at = np.minimum(np.searchsorted(self.known, h[some]), len(self.known) - 1)
        same = self.known[at] == h[some]
        return some[same], at[same]


def _windows(width: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            item, held, tokens = [], [], []
            for name, text in zip(b.column("item").to_pylist(), binary(b, "text"), strict=True):
                words = words_of(text)
                gram = min(GRAM, len(words), width)
                own = grams(hashes_of(words), gram).view(np.int64) if words else []
                for i in range(max(1, len(words) - width + 1) if words else 0):
                    item.append(name)
                    held.append([w.decode() for w in words[i : i + width]])
                    tokens.append(own[i : i + len(held[-1]) - gram + 1])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(held, pa.list_(pa.string())), pa.array(tokens, pa.list_(pa.int64()))], names=["item", "words", "tokens"])

    return windows


def _tokens(batch: pa.RecordBatch, widths: list[int]) -> tuple[list[list[bytes]], np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The words of each row, where each row's words begin, and (width, hashes, place of the first word) of all rows' shingles."""
    words = [words_of(t) for t in binary(batch, "text")]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    row, hashes = np.repeat(np.arange(len(words)), sizes), hashes_of([w for own in words for w in own])
    found = []
    for width in widths:
        inside = np.flatnonzero(row[: max(0, len(row) - width + 1)] == row[width - 1 :])
        found.append((width, grams(hashes, width)[inside], inside))
    return words, np.r_[0, np.cumsum(sizes)], found


def _count(shared, widths: list[int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        total = np.zeros(len(vocabulary.known), np.int64)
        for b in slices(batches, 500):
            for _, hashes, _ in _tokens(b, widths)[2]:
                np.add.at(total, vocabulary.find(hashes)[1], 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary.known[seen].view(np.int64)), pa.array(total[seen])], names=["token", "n"])

    return count


_PLACES = "array<struct<token:bigint,at:int,low:int,around:array<string>>>"


def _scan(shared, widths: list[int], width: int):
    """For mapInArrow over documents: the number of words, and each place of a prefix shingle with the words around it."""
    kind = pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("around", pa.list_(pa.string()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for b in slices(batches, 500):
            words, begin, found = _tokens(b, widths)
            places: list[list[dict]] = [[] for _ in words]
            for gram, hashes, first in found:
                hit, _ = vocabulary.find(hashes)
                rows = np.searchsorted(begin, first[hit], "right") - 1
                for i, at, token in zip(rows.tolist(), (first[hit] - begin[rows]).tolist(), hashes[hit].view(np.int64).tolist(), strict=True):
                    low = max(0, at - width + gram)
                    places[i].append({"token": token, "at": at, "low": low, "around": [w.decode() for w in words[i][low : at + width]]})
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(map(len, words), pa.int64(), size=len(words)), pa.array(places, kind)], names=["id", "th", "n_words", "places"])

    return scan


def _parts(tokens: DataFrame, hash_bytes: int) -> Iterator:
    """Broadcasts of the tokens (materialized, one column) as sorted arrays, each of about ``hash_bytes`` at most."""
    parts = max(1, -(-8 * tokens.count() // hash_bytes))
    for i in range(parts):
        own = tokens.where(F.pmod(F.xxhash64("token"), F.lit(parts)) == i).toArrow()["token"].to_numpy()
        yield tokens.sparkSession.sparkContext.broadcast(np.sort(own.astype(np.int64).view(np.uint64)))


def prefix_windows(source: DataFrame, items: DataFrame, width: int, hash_bytes: int = HASH_BYTES) -> tuple[DataFrame, list[int]]:
    """(token, n, place, words, items) of each window that can occur: its rarest shingle and how often the corpus has that; and the widths of shingles."""
    every = items.mapInArrow(_windows(width), "item string, words array<string>, tokens array<long>")
    windows = materialize(every.groupBy("words").agg(F.first("tokens").alias("tokens"), F.collect_set("item").alias("items")), "windows")
    each = windows.select("words", F.size("tokens").alias("many"), F.posexplode("tokens").alias("place", "token"))
    tokens = materialize(each.groupBy("token").agg(F.count("*").alias("own")), "tokens")
    widths = sorted(r[0] for r in windows.select(F.least(F.lit(GRAM), F.size("words"))).distinct().collect())
    counted = None
    for part in _parts(tokens.select("token"), hash_bytes):
        own = source.select("text").mapInArrow(_count(part, widths), "token long, n long")
        counted = own if counted is None else counted.unionByName(own)
    counts = materialize(counted.groupBy("token").agg(F.sum("n").alias("n")).join(tokens, "token"), "token-counts")
    met = spread_join(each, counts, "token", "own", by=["words", "place"])
    least = met.groupBy("words").agg(F.min(F.struct("n", "token", "place")).alias("least"), F.count("*").alias("met"), F.first("many").alias("many")).where("met = many")
    found = least.join(windows.select("words", "items"), "words").select("least.token", "least.n", "least.place", "words", "items")
    return materialize(found, "prefixes"), widths


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", width: int = WIDTH, hash_bytes: int = HASH_BYTES, room: int | None = None) -> DataFrame:
    """key, th, n_words, n_hit, n_items, items_sha256, contaminated and items of every row of docs. th is text_hash(text)."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(col(key).alias("id"), text_hash(col(text)).alias("th"), col(text).alias("text"))
    items = benchmark.select(col(item).cast("string").alias("item"), col(item_text).alias("text"))
    prefixes, widths = prefix_windows(source, items, width, hash_bytes)
    base = places = None
    for part in _parts(materialize(prefixes.select("token").distinct(), "prefix-tokens"), hash_bytes):
        rows = materialize(source.mapInArrow(_scan(part, widths, width), f"id {kind}, th long, n_words long, places {_PLACES}"), "places")
        base = rows.select("id", "th", "n_words") if base is None else base
        own = rows.select("id", "th", F.inline("places"))
        places = own if places is None else places.unionByName(own)
    few = small(prefixes) if room is None else small(prefixes, size=room)
    met = places.join(few.drop("n"), "token") if few is not prefixes else spread_join(places, prefixes, "token", "n", by=["id", "th", "at"])
    # the window's start among the words around, and what it would cover
    start, size = F.col("at") - F.col("low") - F.col("place"), F.size("words")
    fits = (start >= 0) & (start + size <= F.size("around"))
    met = met.where(fits).where(F.slice("around", F.when(start >= 0, start + 1).otherwise(1), size) == F.col("words"))
    spans = F.array_sort(F.collect_set(F.struct((F.col("at") - F.col("place")).alias("start"), size.alias("size"))))
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    hits = materialize(met.groupBy(F.col("id").alias("hit_id"), F.col("th").alias("hit_th")).agg(spans.alias("spans"), names.alias("names")), "hits")
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(acc, span):
        end = span["start"] + span["size"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], span["start"]))).alias("n"))

    joined = base.join(small(hits), F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left")
    listed = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(key),
        "th",
        "n_words",
        F.coalesce(F.aggregate("spans", zero, cover, lambda acc: acc["n"]), F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
        listed.alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """docs without those in which a benchmark window occurs."""
    found = contamination(docs, benchmark, text, key, width=width).where("contaminated")
    bad = small(materialize(found.select(col(key).alias(f"{OWN}id"), F.col("th").alias(f"{OWN}th")).distinct(), "contaminated"))
    return docs.join(bad, col(key).eqNullSafe(F.col(f"{OWN}id")) & (text_hash(col(text)) == F.col(f"{OWN}th")), "left_anti")
