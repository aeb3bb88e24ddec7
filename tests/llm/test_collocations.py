import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tramloom.llm import collocations
from tramloom.llm.collocations import Chunk, mine_collocations, parts, same_words


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least=10, longest=3, keep=2000):
    f, n, first = defaultdict(Counter), Counter(), {}
    for doc, text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i : i + k])] += 1
                    at = (lang, tuple(ws[i : i + k]))
                    first[at] = min(first.get(at, (2, 0)), (doc is None, doc or 0))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            inside = [b for q, b in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 50 * a for b in inside):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]], first[lang, p]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s, None if d[0] else d[1]) for i, (s, a, p, left, right, d) in enumerate(sorted(found)[:keep])]
    return sorted(out)


def _rows(seed, n=120):
    rng = random.Random(seed)
    words = ["The", "of", "a", "É", "naïve", "x\x00y", "的", "b\x1cc", "new", "york", "city", "at"]
    join = lambda: rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "   "])
    out = [(i, "".join(rng.choice(words) + join() for _ in range(rng.randrange(1, 60))) + "New York city hall", rng.choice(["en", "fr", None, "und", ""])) for i in range(n)]
    return out + [(n, None, "en"), (n + 1, "", "fr"), (n + 2, " .,; ", "de"), (5, "new york", "en"), (None, "new york " * 30, "xx"), (None, "big apple. " * 12, "xx"), (7, "big apple. " * 12, "xx"), (n + 3, "a a a a a a a a a a a a a a", "zz")]


def _frame(spark, rows, n=3):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n int, phrase string").repartition(n)


@pytest.mark.parametrize("chunk", [40, 700, collocations.CHUNK])
def test_against_brute_force(spark, chunk):
    rows = _rows(1)
    got = mine_collocations(_frame(spark, rows), chunk=chunk)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_other_lengths_and_a_full_filter(spark):
    rows = _rows(2, 60)
    for longest, least, keep in ((2, 3, 5), (5, 4, 2000)):
        got = mine_collocations(_frame(spark, rows), longest=longest, least=least, keep=keep, filter_bits=1 << 20)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, longest, keep)


def test_a_long_text_is_counted_whole(spark):
    rng = random.Random(3)
    rows = [(1, " ".join(rng.choice("abcdefgh") for _ in range(3000)), "en"), (2, "w" * 5000 + " a b " + "v" * 900 + " c d", "en"), (3, "z" * 9000, "en")]
    assert sorted(tuple(r) for r in mine_collocations(_frame(spark, rows, 1), chunk=500).collect()) == brute(rows)


def test_no_rows_and_no_phrases(spark, nothing):
    assert mine_collocations(nothing).collect() == []
    assert mine_collocations(_frame(spark, [(1, "one two three", "en"), (2, None, None)])).collect() == []


def test_parts_hold_every_word_once():
    rng = random.Random(4)
    for room in (1, 7, 30, 200):
        for _ in range(50):
            text = "".join(rng.choice(["ab", "c", " ", " ", ".", "long" * 4]) for _ in range(80)).encode()
            words, joined = re.findall(rb"[^ .]+", text), []
            for part, context in parts(text, room, 3):
                own = re.findall(rb"[^ .]+", part)
                assert own[:context] == joined[len(joined) - context :]
                joined += own[context:]
            assert joined == words


def test_unlike_phrases_of_one_fingerprint_are_told_apart():
    texts = [b"a b. c d. a b. e f. c d. a b", b"a b. a b"]
    chunk = Chunk(texts, np.zeros(2, int), np.array([0, 1]), np.array([3, 4], np.uint64))
    numbers, words = chunk.numbers()
    at = chunk.counting(2)
    want = {(0, b"a", b"b"): 3, (0, b"c", b"d"): 2, (0, b"e", b"f"): 1, (1, b"a", b"b"): 2}
    for shift in (0, 62, 63, 64):  # of 64 bits, 2, 1 or none are left
        if shift:
            chunk.known[2] = chunk.grams(2) >> np.uint64(shift) if shift < 64 else np.zeros_like(chunk.grams(2))
        first, count = same_words(chunk, numbers, at, 2)
        got = {(int(chunk.lang[i]), *[words[int(numbers[i + j])].as_py() for j in (0, 1)]): int(n) for i, n in zip(first, count)}
        assert got == want


def test_words_that_collide_by_construction(spark):
    """Powers of two words that follow the Thue-Morse sequence and its complement have equal polynomials modulo 2**64."""
    morse = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join("ab"[x ^ y] for x in morse) for y in (0, 1))
    rows = [(i, f"{one if i % 3 else other} tail", "en") for i in range(30)]
    got = sorted(tuple(r) for r in mine_collocations(_frame(spark, rows)).collect())
    assert got == brute(rows) and len(got) == 2


def test_products_past_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.lit(3 * 10**12).alias("a"), F.lit(4 * 10**12).alias("l"), F.lit(5 * 10**12 + 1).alias("r"))
    got = row.select(collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert got == 10**6 * (3 * 10**12) ** 2 // (4 * 10**12 * (5 * 10**12 + 1))
