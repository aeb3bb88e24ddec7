"""Substring dedup: suffix automata of reference shards give matching statistics; long repeated spans are removed.

1. Every document's windows of ``length`` words are dealt to anchors: a window's anchor is the place of the least hash
   among its runs of GRAM words, so equal windows have equal anchors at equal places. An anchor owns one stretch of
   words, the union of its windows; a document of n words has about n / 14 of them, and only their hashes shuffle.
2. Anchors whose hash occurs twice or more are suspected. Equal stretches are pre-aggregated to one with a count, so
   that groups of copies, however large, leave one stretch each.
   Stretches of one anchor count as equal by a BLAKE2b digest of all their words, of 64 bits under a key that each run draws
   anew, so that nobody can write words that it confuses; the plain hashes only bring together what may be equal.
3. An anchor with over HOT_KINDS kinds of stretches (the edge of a passage in very many contexts) would make an automaton
   without bound. Its kinds are taken apart into windows, which are counted by such digests of their words.
4. Of all other anchors the words of one stretch of each kind are fetched and sent to a shard by anchor hash. Shards, not documents, get
   bounded automata: all stretches of an anchor lie in one, and a shard is built, used and dropped in its own task.
   A broadcast of all automata would grow with the corpus; the shuffle by anchor sends each only what it can match.
5. Stretches stream through the automaton; a position is repeated if its state for ``length`` words occurs more than
   once, weighted by counts. Windows are owned once, so a place never counts twice.
6. Repeated windows are joined back to all documents with the stretch and their words are removed.

Defined results: a null or empty text has no words; rows alike repeat each other; documents shorter than ``length``
lose nothing; an empty table gives an empty result. Columns of the input named n_words or n_removed give way.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.llm.automaton import SuffixAutomaton
from tramloom.llm.common import OWN, binary, col, forget, map_rows, materialize, mix64, slices, small, spread_join, whole_groups, without

LENGTH = 35
GRAM = 8
#: Words of distinct stretches that one automaton takes, but for its last anchor; distinct stretches that an anchor may have.
SHARD_WORDS, HOT_KINDS = 100_000, 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_KEY = 0x51F15E


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hashes that spread words evenly. They find what may be equal; what is equal, words or their digests decide."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(_KEY)), np.uint64, len(words))


def digest(words: Sequence[bytes], key: bytes) -> int:
    """64 bits of all the words by BLAKE2b, as a long. Words have no spaces, so their joint text tells them apart."""
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8, key=key).digest(), "little", signed=True)


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(hashes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first word, windows) of each stretch of a document, by its words' hashes."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = np.zeros(n - gram + 1, np.uint64)
    for i in range(gram):
        grams = grams * _STEP + hashes[i : n - gram + 1 + i]
    grams = mix64(grams)
    # a place breaks ties of the leading bits to the left, alike in equal windows; 28 bits hold any text's places
    place = np.arange(len(grams), dtype=np.uint64)
    least = least_in_windows((grams & ~np.uint64((1 << 28) - 1)) | place, length - gram + 1)
    anchor = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    windows = np.diff(np.r_[first, len(anchor)])
    return grams[anchor[first]], first, windows


def document_stretches(words: list[bytes], length: int, gram: int, key: bytes) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """(anchor hash, digest of the words, first word, windows) of each stretch."""
    anchor, first, windows = stretches(word_hashes(words) if len(words) >= length else np.empty(0, np.uint64), length, gram)
    return anchor, [digest(words[i : i + n + length - 1], key) for i, n in zip(first.tolist(), windows.tolist(), strict=True)], first, windows


def _scan(length: int, gram: int, key: bytes):
    """All stretches: their anchors, documents, contents and places (first << 5 | windows)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            found = [document_stretches(t.split(), length, gram, key) for t in binary(b, "text")]
            anchor, first, windows = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in (0, 2, 3))
            row = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            columns = (pa.array(anchor.view(np.int64)), b.column("id").take(row), b.column("th").take(row), pa.array([x for f in found for x in f[1]], pa.int64()), pa.array(first << 5 | windows))
            yield pa.RecordBatch.from_arrays(list(columns), names=["anchor", "id", "th", "content", "place"])

    return scan


#: Stretches whose words or windows a task holds before it sends them.
_SEND = 5000


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[dict]]]:
    """The words of each document that was chosen to give stretches, and those stretches."""
    before = None
    for b in slices(batches, 20):
        for t, wanted in zip(binary(b, "text"), b.column("wanted").to_pylist(), strict=True):
            if wanted != before:  # rows alike come one after the other
                before = wanted
                yield t.split(), wanted


def _fetch(length: int):
    """The words of the stretches that documents were chosen to give."""

    def send(cols: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())], names=["anchor", "content", "n", "words"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list] = [[] for _ in range(4)]
        for words, wanted in _wanted(batches):
            for w in wanted:
                first, windows = w["place"] >> 5, w["place"] & 31
                for c, v in zip(cols, (w["anchor"], w["content"], w["n"], b" ".join(words[first : first + windows + length - 1])), strict=True):
                    c.append(v)
            if len(cols[0]) >= _SEND:
                yield send(cols)
                cols = [[] for _ in range(4)]
        yield send(cols)

    return fetch


def _fetch_windows(length: int, key: bytes):
    """The windows of stretches of hot anchors, by the digest of all their words and their place in the stretch."""
    names = ["anchor", "content", "n", "window", "at"]

    def send(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for words, wanted in _wanted(batches):
            for w in wanted:
                first, windows = w["place"] >> 5, w["place"] & 31
                rows += [(w["anchor"], w["content"], w["n"], digest(words[first + i : first + i + length], key), i) for i in range(windows)]
            if len(rows) >= _SEND:
                yield send(rows)
                rows = []
        if rows:
            yield send(rows)

    return fetch


def match_shard(texts: list[list[bytes]], counts: list[int], length: int) -> list[list[int]]:
    """Of each text, the windows (by their first word) that occur more than once in all texts, counts weighing them."""
    automaton = SuffixAutomaton(texts, counts)
    return [[end - length for end in automaton.repeated_ends(t, length)] for t in texts]


def _match(length: int, room: int):
    """For mapInArrow over stretches sorted by anchor and content: (anchor, content, repeated) of those with repeated windows."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor"], max(1, room // (2 * length))):
            anchor, content = table["anchor"].to_numpy(), table["content"].to_numpy()
            table = table.filter(pa.array(np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]))  # rows alike give a stretch again
            found = match_shard([x.split() for x in table["words"].to_pylist()], table["n"].to_pylist(), length)
            hits = table.select(["anchor", "content"]).filter(pa.array([bool(f) for f in found], pa.bool_()))
            yield from hits.append_column("repeated", pa.array([f for f in found if f], pa.list_(pa.int32()))).combine_chunks().to_batches()

    return match


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_kinds: int = HOT_KINDS) -> DataFrame:
    """(id, th, windows): for each row of docs (id, th, text) with repeated windows, the places of their first words."""
    assert length - gram < 32, "a place holds up to 31 windows"
    key = secrets.token_bytes(16)
    shape = f"anchor long, id {docs.schema['id'].dataType.simpleString()}, th long, content long, place long"
    every = materialize(docs.mapInArrow(_scan(length, gram, key), shape), "anchors")
    suspected = materialize(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "suspected")
    rows = materialize(spread_join(every, suspected, "anchor", "n"), "stretches")
    forget(every)
    kinds = materialize(rows.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("th", "place", "id")).alias("from")), "stretch-kinds")
    per = materialize(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > hot_kinds).select("anchor", F.lit(True).alias("hot")), "hot-anchors")
    marked = kinds.join(small(per), "anchor", "left").withColumn("hot", F.col("hot").isNotNull())

    def giving(some: DataFrame) -> DataFrame:
        wanted = F.collect_list(F.struct("anchor", "content", "n", F.col("from.place").alias("place"))).alias("wanted")
        return some.groupBy(F.col("from.id").alias("wid"), F.col("from.th").alias("wth")).agg(wanted)

    def given(by: DataFrame) -> DataFrame:
        return docs.join(by, F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth"))).select("text", "wanted")

    shards = given(giving(marked.where(~F.col("hot")))).mapInArrow(_fetch(length), "anchor long, content long, n long, words binary").repartition("anchor").sortWithinPartitions("anchor", "content")
    found = shards.mapInArrow(_match(length, SHARD_WORDS), "anchor long, content long, repeated array<int>")
    if not per.isEmpty():
        # a plan of its own: with it, one stage would hold too many sorts at once
        few = small(materialize(giving(marked.where("hot")), "hot-giving"))  # mostly some thousand documents, for which texts need not move
        windows = materialize(given(few).mapInArrow(_fetch_windows(length, key), "anchor long, content long, n long, window long, at long").distinct(), "hot-windows")
        twice = windows.groupBy("anchor", "window").agg(F.sum("n").alias("all"), F.count("*").alias("own")).where("all > 1").select("anchor", "window", "own")
        again = spread_join(windows, materialize(twice, "hot-repeated"), ["anchor", "window"], "own")
        again = materialize(again.groupBy("anchor", "content").agg(F.collect_list(F.col("at").cast("int")).alias("repeated")), "hot-found")
        found = found.unionByName(again)
    hits = spread_join(rows.select("id", "th", "anchor", "content", "place"), found, ["anchor", "content"], "n", sizes=kinds)
    hits = hits.select("id", "th", F.transform("repeated", lambda x: x + F.shiftright("place", 5).cast("int")).alias("at"))
    return hits.groupBy("id", "th").agg(F.flatten(F.collect_list("at")).alias("windows"))


def cut(words: list[bytes], windows: list[int] | None, length: int) -> tuple[list[bytes], int]:
    """The words outside all windows, and how many were inside."""
    if not windows:
        return words, 0
    marks = np.zeros(len(words) + 1, np.int64)
    at = np.unique(np.asarray(windows, np.int64))
    marks[at] += 1
    np.add.at(marks, at + length, -1)
    keep = np.flatnonzero(np.cumsum(marks)[:-1] == 0)
    return [words[i] for i in keep], len(words) - len(keep)


def dedup_substrings(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot_kinds: int = HOT_KINDS) -> DataFrame:
    """docs with text replaced by the kept words joined by one space, and n_words and n_removed added."""
    # one shuffle of the texts serves both joins, that which fetches stretches and that which cuts: the same columns by the same keys
    docs = without(docs, "n_words", "n_removed")
    th = F.xxhash64(col(text))
    rest = [c for c in docs.columns if c not in (key, text)]
    keyed = docs.select(col(key).alias("id"), th.alias("th"), col(text).alias("text"))
    own = repeated_windows(keyed, length, gram, hot_kinds).select(F.col("id").alias(f"{OWN}id"), F.col("th").alias(f"{OWN}th"), F.col("windows").alias(f"{OWN}windows"))
    source = docs.select(col(key).alias("id"), th.alias("th"), col(text).alias("text"), *[col(c).alias(f"{OWN}c{i}") for i, c in enumerate(rest)])
    joined = source.join(own, F.col("id").eqNullSafe(F.col(f"{OWN}id")) & (F.col("th") == F.col(f"{OWN}th")), "left")
    joined = joined.select(F.col("id").alias(key), F.col("text").alias(text), *[F.col(f"{OWN}c{i}").alias(c) for i, c in enumerate(rest)], f"{OWN}windows").select(*map(col, docs.columns), f"{OWN}windows")
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            kept, n, removed = [], [], []
            texts = b.column(text)
            for t, w in zip(texts.cast(pa.binary()).to_pylist(), b.column(f"{OWN}windows").to_pylist(), strict=True):
                words = (t or b"").split()
                rest, gone = cut(words, w, length)
                kept.append(None if t is None else b" ".join(rest))
                n.append(len(words))
                removed.append(gone)
            new = pa.array(kept, pa.binary()).cast(texts.type)
            yield pa.RecordBatch.from_arrays([*[new if c == text else b.column(c) for c in names], pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_words", "n_removed"])

    return map_rows(joined, rewrite, names, {"n_words": "long", "n_removed": "long"})
