"""Phrase collocations by Rabin-Karp fingerprints: hash every n-gram, count fingerprints, verify frequent ones by text.

1. A task joins texts to chunks of some megabytes. Prefix polynomials over the bytes give each word's fingerprint, prefix
   polynomials over the words' each n-gram's: (P[i + n] - P[i]) / base**i. Fingerprints of words and pairs are counted in
   the chunk and summed by a shuffle; what stays under ``least`` can't be a frequent phrase, as unlike phrases of one
   fingerprint only add to its count.
2. Frequent fingerprints are put into a filter of two bits each, in segments that are merged one by one. Its size is
   bounded by FILTER_BITS; a fuller filter lets more pass and loses nothing. Longer n-grams are fingerprinted and summed
   in one pass a length, but only where both n-grams one word shorter passed: others can't be frequent.
3. A last pass verifies against the text: n-grams that pass the filter are grouped by fingerprint, all occurrences of a
   group are compared word by word with its first (unlike ones are told apart), and only then is text written: the
   phrase, its count and a pointer to the first document of its occurrences. A shuffle by the text itself sums counts and
   takes the least pointer, so counts are exact whatever fingerprints collide.
4. The frequent phrases are joined with the counts of their parts, a hot part in portions, and ranked by language.

Defined results: a null text is empty, a null language ``und``; words and pieces are as the contract of the query has them;
rows alike count each; an empty table gives no rows. A text longer than a chunk is cut between words; the words before a
cut go along as context, and an n-gram counts where its last word is new. A null document is no pointer, unless there is no other.
"""

from __future__ import annotations

import contextlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.llm.common import binary, col, materialize, mix64, slices, spread_join
from tramloom.llm.lines import SEGMENT_BITS, places

LONGEST, LEAST, KEEP, COVER = 3, 10, 2000, 50
#: Bytes of text in a chunk (a task holds some 30 times as many); bits of filter a fingerprint, and of all at most.
CHUNK, BITS, FILTER_BITS = 1_000_000, 16, 1 << 28
#: Rows of text that a task hands to Python at once.
BATCH = 500
#: Portions in which a language's phrases are ranked before they meet.
DEAL = 32
UNKNOWN = "und"
#: Kinds of bytes: 0 of words, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\v\f\r")] = 2
_SEPARATOR = re.compile(rb"[ \t.,;:!?\n\v\f\r]")
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base to the power of 0 to n - 1, from a table that a worker keeps."""
    if len(known := _POWERS.get(base, ())) < n:
        known = np.full(max(n, CHUNK), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= 2 * CHUNK:
            _POWERS[base] = known
    return known[:n]


class Prefix:
    """Prefix polynomials of a sequence of values, modulo 2**64."""

    def __init__(self, values: np.ndarray, table: np.ndarray | None = None) -> None:
        """Of values, or of what a table has for them. Worked out in place, as a chunk's bytes become eight times as many."""
        self.sums = np.zeros(len(values) + 1, np.uint64)
        own = self.sums[1:]
        np.take(table, values, out=own) if table is not None else np.copyto(own, values)
        own *= _powers(_BASE, len(values))
        np.cumsum(own, out=own)
        self.back = _powers(pow(_BASE, -1, 1 << 64), len(values) + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def grams(self, n: int) -> np.ndarray:
        """Of every n consecutive values."""
        return (self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n]


def parts(text: bytes, room: int, longest: int) -> Iterator[tuple[bytes, int]]:
    """(part, words of context at its start) of a text cut between words."""
    low = context = begin = 0  # low: up to where all is counted
    while len(text) - begin > room:
        ends = np.flatnonzero(KIND[np.frombuffer(text, np.uint8, room, begin)])
        if len(ends) and begin + ends[-1] > low:
            cut = begin + int(ends[-1])
        elif after := _SEPARATOR.search(text, max(begin + room, low + 1)):  # a word reaches over all the rest of the part
            cut = after.start()
        else:
            break
        yield text[begin:cut], context
        # words of the piece that goes on at the cut
        tail = text[begin:cut]
        kind = KIND[np.frombuffer(tail, np.uint8)]
        piece = np.flatnonzero(kind == 2)
        inside = np.concatenate([[False], kind[piece[-1] + 1 if len(piece) else 0 :] == 0])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + (piece[-1] + 1 if len(piece) else 0)
        context = min(longest - 1, len(starts))
        low, begin = cut, begin + int(starts[-context]) if context else cut
    yield text[begin:], context


class Chunk:
    """The words of some texts: language, piece and fingerprint of each, and whether it is new or only context."""

    def __init__(self, texts: list[bytes], context: np.ndarray, lang: np.ndarray, salt: np.ndarray) -> None:
        self.data = np.frombuffer(b"\n".join([b"", *[t.lower() for t in texts], b""]), np.uint8)
        kind = KIND[self.data]
        self.inside = kind == 0
        edges = np.flatnonzero(self.inside[1:] != self.inside[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        begins = np.cumsum([1, *[len(t) + 1 for t in texts]])[:-1]
        self.row = np.searchsorted(begins, self.starts, "right") - 1
        first = np.searchsorted(self.row, np.arange(len(texts)))
        self.new = np.arange(len(self.row)) - first[self.row] >= context[self.row]
        self.lang = lang[self.row]
        words = mix64(Prefix(self.data, _VALUE).spans(self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))
        self.salt, self.words = salt[self.lang], Prefix(words)
        self.known: dict[int, np.ndarray] = {}

    def grams(self, n: int) -> np.ndarray:
        """Fingerprints, by language, of the n-grams that begin at each word."""
        if n not in self.known:
            m = max(0, len(self.row) - n + 1)
            self.known[n] = mix64(self.words.grams(n) + self.salt[:m] * np.uint64(2 * n + 1)) if m else np.empty(0, np.uint64)
        return self.known[n]

    def counting(self, n: int) -> np.ndarray:
        """Words at which an n-gram begins that lies in a piece and ends in a new word."""
        m = max(0, len(self.row) - n + 1)
        return np.flatnonzero((self.piece[n - 1 :] == self.piece[:m]) & self.new[n - 1 :])

    def numbers(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's number among the distinct words, and those."""
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[self.inside])]).dictionary_encode()
        return words.indices.to_numpy(), words.dictionary


def chunks(batches: Iterator[pa.RecordBatch], room: int, longest: int) -> Iterator[tuple[Chunk, list[str], list[int | None]]]:
    """(words, languages by number, documents by row); rows in the order of documents."""
    held: list[tuple] = []
    size = 0

    def close() -> tuple[Chunk, list[str], list[int | None]]:
        held.sort(key=lambda x: (x[0] is None, x[0] or 0))
        names: dict[str, int] = {}
        lang = np.array([names.setdefault(x[1], len(names)) for x in held])
        salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in names], np.uint64)
        docs, _, texts, context = zip(*held, strict=True)
        return Chunk(list(texts), np.array(context), lang, salt), list(names), list(docs)

    for b in slices(batches, 500):
        for doc, lang, text in zip(b.column("doc").to_pylist(), b.column("lang").to_pylist(), binary(b, "text"), strict=True):
            for part, context in parts(text, room, longest):
                held.append((doc, lang, part, context))
                size += len(part)
                if size >= room:
                    yield close()
                    held, size = [], 0
    if held:
        yield close()


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which fingerprints a filter holds, and some more."""
    segments = len(bits) >> (SEGMENT_BITS - 3)
    segment, at = places(h, segments)
    at |= (segment << SEGMENT_BITS)[:, None]
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)


def may_be_frequent(chunk: Chunk, n: int, filters: list[np.ndarray]) -> np.ndarray:
    """Places of n-grams that count and whose n-grams one word shorter, from pairs on, all pass their filter.

    filters[i] is that of n-grams of i + 2 words, the first that of single words too.
    """
    at = chunk.counting(n)
    for m in range(2, n):
        short = chunk.grams(m)
        for j in range(n - m + 1):
            at = at[passes(filters[m - 2], short[at + j])]
    return at


def _sums(lengths: tuple[int, ...], shared, room: int, longest: int) -> Callable:
    """For mapInArrow over (doc, lang, text): fingerprints of the n-grams of these lengths and their number in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [np.frombuffer(x, np.uint8) for x in shared.value]
        for chunk, *_ in chunks(batches, room, longest):
            for n in lengths:
                h, count = np.unique(chunk.grams(n)[may_be_frequent(chunk, n, filters)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(count)], names=["fingerprint", "n"])

    return run


def same_words(chunk: Chunk, numbers: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first place, number) of each kind of n-gram at the places ``at``, which rise. Fingerprints only sort: words decide."""
    h = chunk.grams(n)[at]
    at = at[np.argsort(h, kind="stable")]
    h = np.sort(h)
    cuts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    size = np.diff(np.append(cuts, len(h)))
    first = np.repeat(at[cuts], size)
    like = chunk.lang[at] == chunk.lang[first]
    for j in range(n):
        like &= numbers[at + j] == numbers[first + j]
    if like.all():
        return at[cuts], size
    mixed = ~np.logical_and.reduceat(like, cuts)
    rest = np.sort(at[np.repeat(mixed, size)])
    kinds = np.stack([chunk.lang[rest], *[numbers[rest + j] for j in range(n)]], axis=1)
    _, own, count = np.unique(kinds, axis=0, return_index=True, return_counts=True)
    return np.concatenate([at[cuts[~mixed]], rest[own]]), np.concatenate([size[~mixed], count])


_VERIFIED = "lang string, phrase string, n long, doc long"


def _verified(shared, room: int, longest: int) -> Callable:
    """For mapInArrow over (doc, lang, text): phrases that pass, with text; a row without a phrase has the number of a language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [np.frombuffer(x, np.uint8) for x in shared.value]
        for chunk, names, docs in chunks(batches, room, longest):
            numbers, words = chunk.numbers()
            total = np.bincount(chunk.lang[chunk.new], minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.nulls(len(names), pa.string()), pa.array(total), pa.nulls(len(names), pa.int64())], names=["lang", "phrase", "n", "doc"])
            langs, docs = pa.array(names), pa.array(docs, pa.int64())
            for n in range(1, longest + 1):
                at = may_be_frequent(chunk, n, filters)
                at = at[passes(filters[max(n - 2, 0)], chunk.grams(n)[at])] if len(at) else at
                if not len(at):
                    continue
                first, count = same_words(chunk, numbers, at, n)
                text = pc.binary_join_element_wise(*[words.take(pa.array(numbers[first + j])) for j in range(n)], b" ").cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(chunk.lang[first])), text, pa.array(count), docs.take(pa.array(chunk.row[first]))], names=["lang", "phrase", "n", "doc"])

    return run


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand texts to Python so many rows at a time: ten thousand whole texts are tens of megabytes, held by either side."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fingerprint_filter(frequent: DataFrame, most_bits: int) -> bytes:
    """Two bits for each fingerprint, in a power of two of segments of SEGMENT_BITS; each segment is merged on its own."""
    wanted = min(most_bits, BITS * frequent.count()) >> SEGMENT_BITS
    segments = 1 << max(0, (wanted - 1).bit_length()) if wanted > 0 else 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            segment, at = places(b.column("fingerprint").to_numpy().view(np.uint64), segments)
            order = np.argsort(segment, kind="stable")
            own, low = np.unique(segment[order], return_index=True)
            flat = [x.astype(np.uint32).tobytes() for x in np.split(at[order], low[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(flat[: len(own)], pa.binary())], names=["segment", "places"])

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << SEGMENT_BITS, bool)
        for x in table["places"]:
            bits[np.frombuffer(x.as_py(), np.uint32)] = True
        return pa.table({"segment": [key[0].as_py()], "bits": [zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)]}, schema=pa.schema([("segment", pa.int64()), ("bits", pa.binary())]))

    whole = np.zeros((segments, 1 << (SEGMENT_BITS - 3)), np.uint8)
    for r in frequent.select("fingerprint").mapInArrow(send, "segment long, places binary").groupBy("segment").applyInArrow(merge, "segment long, bits binary").toLocalIterator():
        whole[r["segment"]] = np.frombuffer(zlib.decompress(bytes(r["bits"])), np.uint8)
    return whole.tobytes()


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", longest: int = LONGEST, least: int = LEAST, chunk: int = CHUNK, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, words, phrase, n, first_doc: all n-grams of up to ``longest`` words with n >= least, counted exactly, with the least document; and a row of 0 words for each language with the number of its words."""
    spark = docs.sparkSession
    source = docs.select(col(key).cast("long").alias("doc"), F.coalesce(col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), col(text).cast("string").alias("text"))
    filters: list[bytes] = []
    with batches_of(spark, BATCH):
        for n in range(2, longest + 1):
            lengths = (1, 2) if n == 2 else (n,)
            sums = source.mapInArrow(_sums(lengths, spark.sparkContext.broadcast(filters), chunk, longest), "fingerprint long, n long").groupBy("fingerprint").agg(F.sum("n").alias("n"))
            frequent = materialize(sums.where(F.col("n") >= least).select("fingerprint"), "fingerprints")
            filters = [*filters, fingerprint_filter(frequent, filter_bits)]
        found = source.mapInArrow(_verified(spark.sparkContext.broadcast(filters), chunk, longest), _VERIFIED)
        counted = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.min("doc").alias("first_doc"))
        words = F.when(F.col("phrase").isNull(), 0).otherwise(F.size(F.split("phrase", " ")))
        return materialize(counted.where((F.col("n") >= least) | F.col("phrase").isNull()).withColumn("words", words), "phrases")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact for counts under 10**15."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def mine_collocations(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", longest: int = LONGEST, least: int = LEAST, keep: int = KEEP, cover: int = COVER, chunk: int = CHUNK, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and first_doc of each language's ``keep`` best phrases."""
    if longest < 2 or least < 1:
        raise ValueError("longest >= 2 and least >= 1")
    known = frequent_phrases(docs, text, lang, key, longest, least, chunk, filter_bits)
    phrases = known.where("words >= 1").select("lang", "words", "phrase", F.col("n").alias("f"))
    whole = phrases.where("words >= 2").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    joined = lambda low, n: F.array_join(F.slice("w", low, n), " ")
    k = F.col("k")
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = F.array(F.struct(F.lit(0).alias("side"), joined(F.lit(1), k).alias("part")), F.struct(F.lit(1).alias("side"), joined(k + 1, F.col("words") - k).alias("part")))
    sides = materialize(cuts.select("lang", "phrase", "a", "k", F.explode(sides).alias("s")).select("lang", "phrase", "a", "k", "s.*"), "parts")
    asked = sides.groupBy("lang", "part").agg(F.count("*").alias("asked"))
    counts = phrases.select("lang", F.col("phrase").alias("part"), "f")
    met = spread_join(sides, counts, ["lang", "part"], "asked", by=("phrase", "k"), sizes=materialize(asked, "parts-asked"))
    side = lambda i: F.max(F.when(F.col("side") == i, F.col("f")))
    scored = met.groupBy("lang", "phrase", "k", "a").agg(side(0).alias("l"), side(1).alias("r"))
    scored = scored.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    covering = whole.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(covering, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("b.score"), F.desc("a"), "phrase"))
    deal = left.withColumn("__deal", F.pmod(F.hash("phrase"), F.lit(DEAL)))  # a language's best are among the best of its portions
    ranked = deal.withColumn("rank", place("lang", "__deal")).where(F.col("rank") <= keep).withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= keep)
    total = known.where("words = 0").select("lang", "n")
    firsts = known.where("words >= 2").select("lang", "phrase", "first_doc")
    result = ranked.join(firsts, ["lang", "phrase"]).join(total, "lang")
    return result.select("lang", "rank", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"), "first_doc")
