"""Toxicity: a bidirectional GRU with attention pooling over word and character inputs, trained in numpy.

A word's input is its hashed vector beside the mean of its hashed character trigrams' vectors. A run of over LONG bytes
without white space (unspaced scripts, glued words) is read as overlapping pieces, each a place of its own with trigrams
only, so that nothing of it is left out and no input grows with it. Documents are scored by
overlapping windows of WINDOW words, STRIDE apart, over the whole text; a document's score is its highest window's.
Training takes a bounded sample of labelled documents: at most ``sample`` rows, one for each id, with whole texts of at
most ``sample_bytes`` together. Of a toxic document it takes the window that looks most toxic, of a clean one a random
window and the one that looks most toxic.

Defined results: texts without words (null, empty) score what a window without words scores; labels that are null
or whose document is missing are not used; a document labelled both ways counts as toxic; with no labels, or labels
of one kind only, every score is the share of toxic ones (0 without any). A column of the input named like the score
gives way to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import OWN, binary, col, map_rows, mix64, slices, without
from tramloom.llm.recurrent import Adam, Params, backward, forward, new_params

#: Labelled rows that the training takes at most, a half of each kind at most, and bytes of their texts together.
SAMPLE, SAMPLE_BYTES = 3000, 64_000_000
#: Windows stand half a window apart, so that any passage of up to 16 words lies whole in one.
WINDOW, STRIDE = 32, 16
WORDS, GRAMS, WIDTH, HIDDEN, ATTENTION = 8192, 4096, 10, 10, 8
EPOCHS, BATCH = 8, 64
#: Bytes of the longest word that is one input; of a longer one, pieces of PIECE bytes stand PIECE_STEP apart.
LONG, PIECE, PIECE_STEP = 48, 24, 12
_STRIP = b".,;:!?\"'()[]{}<>*_-"


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, those of over LONG bytes in overlapping pieces of whole characters, each after a space as its mark."""
    words = text.split()
    if max(map(len, words), default=0) <= LONG:
        return words
    out: list[bytes] = []
    for word in words:
        if len(word) <= LONG:
            out.append(word)
            continue
        low = 0
        while len(word) - low > PIECE:
            out.append(b" " + word[low : _edge(word, low + PIECE)])
            low = _edge(word, low + PIECE_STEP)
        out.append(b" " + word[low:])
    return out


def _edge(word: bytes, at: int) -> int:
    """The first byte of the character that holds byte ``at``."""
    low = at
    while low > at - 3 and word[low] & 0xC0 == 0x80:
        low -= 1
    return low


class Features:
    """Word buckets and character trigram buckets of many words, in flat arrays: the trigrams of word i are many[i] long."""

    def __init__(self, words: list[bytes]) -> None:
        buckets, edged = np.empty(len(words), np.int32), []
        digest = xxhash.xxh3_64_intdigest
        for n, word in enumerate(words):
            if word[:1] == b" ":
                word, whole = b" ", word[1:].lower()
            else:
                word = word.lower().strip(_STRIP)
                whole = b"^" + word + b"$"
            buckets[n] = digest(word) % WORDS
            edged.append(whole if len(whole) > 2 else whole.ljust(3))
        sizes = np.fromiter(map(len, edged), np.int64, len(edged))
        data = np.frombuffer(b"".join(edged), np.uint8).astype(np.uint64)
        self.words, self.many = buckets, (sizes - 2).astype(np.int32)
        self.starts = np.cumsum(self.many, dtype=np.int64) - self.many
        first = np.repeat(np.cumsum(sizes) - sizes - self.starts, self.many) + np.arange(self.many.sum())
        codes = data[first] << np.uint64(16) | data[first + 1] << np.uint64(8) | data[first + 2] if len(first) else np.empty(0, np.uint64)
        self.grams = (mix64(codes) % np.uint64(GRAMS)).astype(np.int16)

    def grams_of(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The trigrams of some words one after the other, and how many each has."""
        many = self.many[some]
        return self.grams[np.repeat(self.starts[some] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())], many


def window_starts(n: int) -> list[int]:
    return [0, *range(STRIDE, max(STRIDE, n - WINDOW + STRIDE), STRIDE)] if n > WINDOW else [0]


class Inputs:
    """Numbers for words, and what each needs as input; number 0 is no word. Starts anew when it has too many words."""

    def __init__(self, p: Params, room: int = 200_000) -> None:
        self.p, self.room = p, room
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.todo: list[bytes] = []
        self.used = 1
        self.xf = np.zeros((4096, 3 * HIDDEN), np.float32)
        self.xb = np.zeros((4096, 3 * HIDDEN), np.float32)

    def numbers(self, words: list[bytes]) -> list[int]:
        known = self.number
        try:
            return [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = len(known) + 1
                    self.todo.append(w)
            return [known[w] for w in words]

    def add(self, found: Features, room: int = 20_000) -> None:
        """Inputs of more words, in both directions, some words at a time."""
        end = self.used + len(found.words)
        if end > len(self.xf):
            self.xf, self.xb = (np.concatenate([x[: self.used], np.zeros((2 * end - self.used, 3 * HIDDEN), np.float32)]) for x in (self.xf, self.xb))
        for at in range(0, len(found.words), room):
            x = vectors(self.p, found, np.arange(at, min(len(found.words), at + room)))
            low = self.used + at
            self.xf[low : low + len(x)] = x @ self.p["Wf"] + self.p["cf"]
            self.xb[low : low + len(x)] = x @ self.p["Wb"] + self.p["cb"]
        self.used = end

    def project(self) -> tuple[np.ndarray, np.ndarray]:
        if self.todo:
            self.add(Features(self.todo))
            self.todo = []
        return self.xf, self.xb


def vectors(p: Params, found: Features, some: np.ndarray) -> np.ndarray:
    grams, many = found.grams_of(some)
    sums = np.add.reduceat(p["gram"][grams], np.r_[0, np.cumsum(many)[:-1]], axis=0)
    return np.concatenate([p["word"][found.words[some]], sums / many[:, None]], axis=1).astype(np.float32)


def windowed(numbers: list[int]) -> np.ndarray:
    """(windows, WINDOW) of word numbers, 0 where there is none."""
    starts = window_starts(len(numbers))
    padded = np.zeros(starts[-1] + WINDOW, np.int32)
    padded[: len(numbers)] = numbers
    return padded[np.add.outer(starts, np.arange(WINDOW))]


def window_logits(p: Params, inputs: Inputs, windows: np.ndarray, room: int = 1024) -> np.ndarray:
    xf, xb = inputs.project()
    found = []
    for at in range(0, len(windows), room):
        ids = windows[at : at + room].T
        found.append(forward(p, xf[ids], xb[ids], (ids > 0).astype(np.float32))[0])
    return np.concatenate(found)


def score_texts(p: Params, inputs: Inputs, texts: list[bytes]) -> list[float]:
    if len(inputs.number) > inputs.room:
        inputs.clear()
    parts = [windowed(inputs.numbers(tokens(t))) for t in texts]
    starts = np.r_[0, np.cumsum([len(x) for x in parts])[:-1]]
    best = np.maximum.reduceat(window_logits(p, inputs, np.concatenate(parts)), starts)
    return (1 / (1 + np.exp(-np.clip(best.astype(np.float64), -30, 30)))).tolist()


def train(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 11) -> Params:
    """The network's parameters after training on whole texts; the same for the same rows in the same order."""
    rng = np.random.default_rng(seed)
    p = new_params(WORDS, GRAMS, WIDTH, HIDDEN, ATTENTION, rng)
    number: dict[bytes, int] = {}
    parts = [windowed([number.setdefault(w, len(number) + 1) for w in tokens(t)]) for t in texts]
    y = np.array(labels)
    found = Features([b"", *number])
    del texts
    # at first, windows look as toxic as their words' shares among toxic documents
    in_toxic, in_all = np.ones(len(found.words)), np.full(len(found.words), 2.0)
    for x, label in zip(parts, y, strict=True):
        own = np.unique(x)
        in_all[own] += 1
        in_toxic[own] += label
    odds = np.log(in_toxic / in_all) - math.log(max(1, y.sum()) / len(y))
    odds[0] = 0
    looks = [odds[x].sum(1) for x in parts]
    adam = Adam(p)
    for epoch in range(epochs):
        if epoch >= 2:
            inputs = Inputs(p)
            inputs.used = 0  # the first of found is no word
            inputs.add(found)
            every = window_logits(p, inputs, np.concatenate(parts))
            looks = np.split(every, np.cumsum([len(x) for x in parts])[:-1])
        picked = [(x[int(s.argmax())], label) for x, s, label in zip(parts, looks, y, strict=True)]
        picked += [(x[rng.integers(len(x))], 0) for x, label in zip(parts, y, strict=True) if not label]
        picked += [(np.zeros(WINDOW, np.int32), 0)]
        order = rng.permutation(len(picked))
        for at in range(0, len(order), BATCH):
            some = [picked[i] for i in order[at : at + BATCH]]
            ids, target = np.stack([s[0] for s in some]).T, np.array([s[1] for s in some], np.float32)
            own, place = np.unique(ids, return_inverse=True)
            place = place.reshape(ids.shape)
            x = vectors(p, found, own)
            xf, xb = (x @ p[f"W{d}"] + p[f"c{d}"] for d in "fb")
            mask = (ids > 0).astype(np.float32)
            logit, cache = forward(p, xf[place], xb[place], mask, keep=True)
            dlogit = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) / len(some)).astype(np.float32)
            g, dxf, dxb = backward(p, dlogit, mask, cache)
            dx = np.zeros_like(x)
            for d, dproj in (("f", dxf), ("b", dxb)):
                sums = np.zeros((len(own), 3 * HIDDEN), np.float32)
                np.add.at(sums, place.ravel(), dproj.reshape(-1, 3 * HIDDEN))
                g[f"W{d}"], g[f"c{d}"] = x.T @ sums, sums.sum(0)
                dx += sums @ p[f"W{d}"].T
            g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
            np.add.at(g["word"], found.words[own], dx[:, :WIDTH])
            grams, many = found.grams_of(own)
            np.add.at(g["gram"], grams, np.repeat(dx[:, WIDTH:] / many[:, None], many, axis=0))
            adam.step(g)
    return p


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, sample: int, sample_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], list[int]]:
    """A bounded sample by the order of a hash, half toxic at most; labels of held-out rows are left out.

    Of rows with one id the text with the least hash is taken. A text for which the bytes don't suffice is passed over.
    """
    ident = col(key)
    known = labels.where(F.col("toxic").isNotNull() & ident.isNotNull() & ~held_out(ident)).groupBy(ident.alias("id")).agg(F.max("toxic").alias("y"))
    known = known.join(docs.select(ident.alias("id")).distinct(), "id", "left_semi")
    ids = [r for y in (1, 0) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample // 2).collect()]
    if not ids:
        return [], []
    chosen = F.broadcast(docs.sparkSession.createDataFrame(ids, known.schema))
    own = docs.select(ident.alias("id"), F.coalesce(col(text), F.lit("")).alias("text")).join(chosen, "id")
    one = F.min(F.struct(F.xxhash64("text"), F.octet_length("text").alias("size"))).alias("least")
    room, wanted = sample_bytes, []
    for r in sorted(own.groupBy("id", "y").agg(one).collect(), key=lambda r: (r["least"][0], r["id"])):
        if r["least"]["size"] <= room:
            room -= r["least"]["size"]
            wanted.append((r["id"], r["least"][0]))
    wanted = F.broadcast(docs.sparkSession.createDataFrame(wanted, f"id {known.schema['id'].dataType.simpleString()}, least long"))
    rows = own.join(wanted, "id").where(F.xxhash64("text") == F.col("least")).groupBy("id", "y").agg(F.min("text").alias("text")).collect()
    rows = sorted((str(r["id"]), r["text"], int(r["y"])) for r in rows)
    return [r[1].encode() for r in rows], [r[2] for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, score: str = "score") -> DataFrame:
    """docs with a score (0 to 1) added; all rows and columns stay."""
    docs = without(docs, score)
    texts, marks = training_rows(docs, labels, text, key, sample)
    share = sum(marks) / len(marks) if marks else 0.0
    if not 0 < share < 1:
        return docs.withColumn(score, F.lit(share))
    shared = docs.sparkSession.sparkContext.broadcast(train(texts, marks))
    names = [*docs.columns, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        inputs = Inputs(p)
        for b in slices(batches, 64):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score_texts(p, inputs, binary(b, text)), pa.float64())], names=names)

    return map_rows(docs, run, docs.columns, {score: "double"})
