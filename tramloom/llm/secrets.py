"""Secret scans with DataFrame functions only: fixed kinds, and a battery of randomness tests over other tokens.

Three kinds are found by pattern. Beside them every token of TOKEN_CHARS or more characters of an alphabet that encodings
use is tested. By its characters a token's encoding is inferred (hex, base32, base64), and three tests are taken: the
chi-squared statistic of uniformity over the alphabet, the number of runs of capitals, small letters and digits, and the
serial correlation of neighbours' places in the alphabet. The weighted sum of the three is a token's score; the weights
are Fisher's, which set random tokens apart best from names made of words and numbers. The null hypothesis is such a
name of the same encoding and length (``names``); its scores are simulated once, from a fixed seed, and the share of
them that is as high is the p-value, with an exponential tail beyond the highest tenth. So a short token needs a
clearer score than a long one. Benjamini-Hochberg control runs over all tokens of the corpus by encoding and length
class, on a fixed grid of p-values, so that only a small table of counts is gathered.

Digits alone are never reported (they have one run), nor is what is more regular than chance allows: a serial correlation
or a number of runs beyond what one random token in about 4000 has.

Defined results: null is an empty text, without spans; rows alike get like results; added spans that overlap a base
span are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import col, materialize

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are matched whole, so that the least length within the pattern drops the same matches as a test of them would.
ACCESS, HEX = r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}"
#: (kind, pattern, shortest group 1, a test without which nothing is searched)
BASE = (("assign", ASSIGN, 8, r"""[pPsStTaA](?i:assw(?:or)?d|ecret|oken|pi_?key)["']?\x20*[:=]"""), ("access", ACCESS, 0, r"AKIA[A-Z0-9]{12}"), ("hex", HEX, 0, "[0-9a-f]{32}"))
KINDS = ("assign", "access", "hex", "random")
TOKEN_CHARS = 20
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}}+"
#: False discoveries among what is reported.
FALSE_DISCOVERY = 0.1
#: Lengths whose null is simulated; a token takes that of the longest not over its own. Simulated names of each.
LENGTHS, NAMES = (20, 22, 24, 26, 28, 30, 32, 36, 40, 44, 48, 56, 64, 80, 96, 128), 4000
#: The grid of p-values: TOP * 10 ** (-k / STEPS) for k up to WORST.
TOP, STEPS, WORST = 0.1, 8, 48
#: Standard deviations that a random token hardly ever strays from what is expected of it.
STRAY = 3.5
# The alphabets, and the letter frequencies of writing in percent, a to z
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
_WRITING = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
_SPAN = "struct<kind:int,start:bigint,end:bigint>"
_FOUND = "struct<start:bigint,end:bigint,token:string>"
#: Matches that are summed up one after the other; blocks of them are then shifted whole, so that many matches cost little.
_BLOCK = 64


def places(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches, as (start, end, token), in code points: gaps and matches by turns."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(whole, F.slice(F.split(text, pattern, -1), 1, F.greatest(F.lit(1), F.size(whole))), lambda m, gap: F.struct(m.alias("m"), F.length(gap).cast("long").alias("gap")))
    pieces = F.filter(pieces, lambda p: p["m"].isNotNull())

    def step(acc: Column, p: Column) -> Column:
        low = acc["at"] + p["gap"]
        high = low + F.length(p["m"])
        return F.struct(high.alias("at"), F.concat(acc["found"], F.array(F.struct(low.alias("start"), high.alias("end"), p["m"].alias("token")))).alias("found"))

    def block(i: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_FOUND}>").alias("found"))
        return F.aggregate(F.slice(pieces, i * _BLOCK + 1, _BLOCK), start, step)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _BLOCK).cast("int")), block)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("begin"))
    begin = F.aggregate(blocks, zero, lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["begin"], F.array(acc["at"])).alias("begin")), lambda acc: acc["begin"])
    moved = F.zip_with(blocks, begin, lambda b, low: F.transform(b["found"], lambda p: F.struct((p["start"] + low).alias("start"), (p["end"] + low).alias("end"), p["token"].alias("token"))))
    return F.when(F.size(pieces) > 0, F.flatten(moved)).otherwise(F.array().cast(f"array<{_FOUND}>"))


def base_spans(text: Column, kind: int) -> Column:
    _, pattern, group, test = BASE[kind]
    found = places(text, pattern)
    if group:
        found = F.filter(found, lambda p: F.length(F.regexp_extract(p["token"], pattern, 1)) >= group)
    found = F.transform(found, lambda p: F.struct(F.lit(kind).alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    return F.when(text.rlike(test), found.cast(f"array<{_SPAN}>")).otherwise(F.array().cast(f"array<{_SPAN}>"))


# --- the null: names made of words and numbers --------------------------------------------------------------------


def names(encoding: int, length: int, count: int, rng: np.random.Generator) -> np.ndarray:
    """(count, length) places in the alphabet (its size stands for "=") of names of pieces of five characters on average.

    A piece of a base64 name is a word (small, capitalised or in capitals), a number or a separator before a word; of a
    base32 name a word in capitals or digits; of a hex name letters or digits, with the frequencies of writing and of
    leading digits.
    """
    shape = (count, length)
    first = rng.random(shape) < 0.2
    first[:, 0] = True
    of_piece = np.maximum.accumulate(np.where(first, np.arange(length), 0), axis=1)
    kind = np.take_along_axis(rng.random(shape), of_piece, 1)
    share = np.array(_WRITING[: 6 if encoding == 0 else 26])
    letter = np.searchsorted(np.cumsum(share / share.sum()), rng.random(shape)).clip(0, len(share) - 1)
    leading = np.log10(1 + 1 / np.arange(1, 11))
    digit = np.searchsorted(np.cumsum(leading / leading.sum()), rng.random(shape)).clip(0, 9)
    if encoding == 0:
        return np.where(kind < 0.5, 10 + letter, digit)
    if encoding == 1:
        return np.where(kind < 0.75, letter, 26 + digit % 6)
    style = np.take_along_axis(rng.random(shape), of_piece, 1)
    small = np.where((style > 0.85) | (style > 0.4) & first, letter, 26 + letter)
    word = np.where(first & (kind > 0.65), 62 + (digit & 1), small)
    return np.where(kind < 0.8, word, 52 + digit)


def measures(x: np.ndarray, encoding: int) -> np.ndarray:
    """(rows, 3): chi-squared, class changes a step and serial correlation of rows of places in the alphabet, as _measures."""
    n, size = x.shape[1], len(ALPHABETS[encoding])
    counts = np.bincount((np.arange(len(x))[:, None] * (size + 1) + x).ravel(), minlength=len(x) * (size + 1)).reshape(len(x), -1)
    chi = size / n * (counts.astype(float) ** 2).sum(1) - n
    classes = (x >= 10).astype(int) if encoding == 0 else (x >= 26).astype(int) if encoding == 1 else np.digitize(x, [26, 52, 62])
    if encoding == 2:  # a separator belongs to what stands before it
        at = np.maximum.accumulate(np.where(classes < 3, np.arange(n), 0), axis=1)
        classes = np.take_along_axis(classes, at, 1)
    changes = (classes[:, 1:] != classes[:, :-1]).sum(1) / (n - 1)
    d = x - x.mean(1, keepdims=True)
    return np.stack([chi, changes, (d[:, 1:] * d[:, :-1]).sum(1) / np.maximum((d * d).sum(1), 1e-9)], axis=1)


def changes_expected(encoding: int) -> float:
    """The chance that neighbours of a random token are of two classes."""
    shares = ((6, 10), (26, 6), (26, 26, 10))[encoding]
    return 1 - sum((s / sum(shares)) ** 2 for s in shares)


@lru_cache
def scoring(encoding: int, length: int, count: int = NAMES) -> tuple[float, ...]:
    """The three weights, the score that a tenth of names reach, and the mean excess of those over it."""
    rng = np.random.default_rng([encoding, length])
    null = measures(names(encoding, length, count, rng), encoding)
    chance = measures(rng.integers(0, len(ALPHABETS[encoding]), (count // 2, length)), encoding)
    weights = np.linalg.solve(np.cov(null.T) + np.cov(chance.T), chance.mean(0) - null.mean(0))
    scores = null @ weights
    top = np.quantile(scores, 1 - TOP)
    return (*weights.tolist(), float(top), float((scores[scores > top] - top).mean()))


def _table(values: list[list[float]], encoding: Column, length: Column) -> Column:
    """values[encoding][length class], as an array of arrays."""
    return F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, row)) for row in values]), encoding + 1), length + 1)


def _measures(token: Column, encoding: Column) -> tuple[Column, Column, Column, Column]:
    """Length, chi-squared, class changes a step and serial correlation of a token in one case if it is hex."""
    n = F.length(token).cast("double")
    size = F.element_at(F.array(*[F.lit(float(len(a))) for a in ALPHABETS]), encoding + 1)
    letters = F.split(token, "")
    squares = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda s, c: s + F.pow((n - F.length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0)))
    runs = F.regexp_count(F.translate(token, "+/-_=", ""), F.lit("[A-Z]+|[a-z]+|[0-9]+"))
    alphabet = F.element_at(F.array(*[F.lit(a + "=") for a in ALPHABETS]), encoding + 1)
    number = F.transform(F.split(F.translate(token, "-_", "+/"), ""), lambda c: F.instr(alphabet, c).cast("double"))
    mean = F.aggregate(number, F.lit(0.0), lambda s, v: s + v) / n
    shifted = F.transform(number, lambda v: v - mean)
    power = F.aggregate(shifted, F.lit(0.0), lambda s, v: s + v * v)
    steps = F.zip_with(F.slice(shifted, 1, F.size(shifted) - 1), F.slice(shifted, 2, F.size(shifted) - 1), lambda a, b: a * b)
    together = F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)
    return n, size / n * squares - n, (F.greatest(F.lit(1), runs) - 1) / (n - 1), together / F.greatest(power, F.lit(1e-9))


def assess(p: Column) -> Column:
    """(start, end, encoding, class, grid) of a token; grid is -1 where its p-value is over TOP."""
    whole = p["token"]
    encoding = F.when(whole.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 0).when(whole.rlike("^[A-Z2-7]+=*$"), 1).otherwise(2)
    token = F.when(encoding == 0, F.lower(whole)).otherwise(whole)
    n, chi, changes, serial = _measures(token, encoding)
    length = F.lit(-1)
    for bound in LENGTHS:
        length = length + F.when(n >= bound, 1).otherwise(0)
    table = [[scoring(e, g) for g in LENGTHS] for e in range(len(ALPHABETS))]
    value = lambda i: _table([[x[i] for x in row] for row in table], encoding, length)
    score = value(0) * chi + value(1) * changes + value(2) * serial
    excess = (score - value(3)) / value(4)
    grade = F.least(F.lit(WORST), F.floor(excess * STEPS / float(np.log(10))).cast("int"))
    expected = F.element_at(F.array(*[F.lit(changes_expected(e)) for e in range(len(ALPHABETS))]), encoding + 1)
    regular = (serial > STRAY / F.sqrt(n)) | (serial < -STRAY / F.sqrt(n)) | (changes > expected + STRAY * F.sqrt(expected * (1 - expected) / (n - 1)))
    return F.struct(p["start"].alias("start"), p["end"].alias("end"), encoding.alias("encoding"), length.alias("class"), F.when((excess >= 0) & ~regular, grade).otherwise(-1).cast("int").alias("grid"))


def least_grades(counts: dict[tuple[int, int], dict[int, int]], level: float = FALSE_DISCOVERY) -> dict[tuple[int, int], int]:
    """Benjamini-Hochberg on the grid: for each (encoding, length class) the least grade that is a discovery, if any."""
    found = {}
    for key, by_grade in counts.items():
        total, reported, least = sum(by_grade.values()), 0, None
        for grade in sorted((g for g in by_grade if g >= 0), reverse=True):
            reported += by_grade[grade]
            if TOP * 10 ** (-grade / STEPS) * total / reported <= level:
                least = grade
        if least is not None:
            found[key] = least
    return found


def joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", level: float = FALSE_DISCOVERY) -> DataFrame:
    """key, base and random (arrays of kind, start, end) of every row."""
    whole = F.coalesce(col(text), F.lit(""))
    base = F.concat(*[base_spans(whole, k) for k in range(len(BASE))])
    tokens = F.when(whole.rlike(TOKEN), F.transform(places(whole, TOKEN), assess)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,encoding:int,class:int,grid:int>>"))
    rows = materialize(docs.select(col(key).alias("id"), base.alias("base"), tokens.alias("tokens")), "secrets")
    graded = rows.select(F.explode("tokens").alias("t")).groupBy("t.encoding", "t.class", "t.grid").agg(F.count("*").alias("n"))
    counts: dict = {}
    for r in graded.toLocalIterator():  # at most 3 x 16 x 50 rows
        counts.setdefault((r["encoding"], r["class"]), {})[r["grid"]] = r["n"]
    least = least_grades(counts, level)
    cuts = [[least.get((e, c), WORST + 1) for c in range(len(LENGTHS))] for e in range(len(ALPHABETS))]
    passes = lambda t: t["grid"] >= _table(cuts, t["encoding"], t["class"])
    free = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    added = F.transform(F.filter("tokens", lambda t: passes(t) & free(t)), lambda t: F.struct(F.lit(3).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return rows.select(F.col("id").alias(key), "base", added.cast(f"array<{_SPAN}>").alias("random"))
