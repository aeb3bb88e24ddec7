import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tramloom.llm import lines, substrings
from tramloom.llm.automaton import SuffixAutomaton

_SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_substrings(texts, length):
    docs = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in docs for i in range(len(w) - length + 1))
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def _substrings(df, rows, **options):
    want = sorted(((i is None, i or 0), n, g, k) for (i, t), (n, g, k) in zip(rows, brute_substrings([t for _, t in rows], options.get("length", 35))))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_words"], r["n_removed"], r["text"] or "") for r in substrings.dedup_substrings(df, **options).collect())
    assert got == want


def test_substrings_of_odd_rows(odd, odd_rows, nothing):
    _substrings(odd, [(i, t) for i, t, _ in odd_rows])
    _substrings(odd, [(i, t) for i, t, _ in odd_rows], hot_kinds=1)
    assert substrings.dedup_substrings(odd).columns == [*odd.columns, "n_words", "n_removed"]
    assert substrings.dedup_substrings(nothing).collect() == []


def test_substrings_with_few_words_and_overlaps(spark):
    """Two-word texts repeat within themselves and each other in every way."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    _substrings(spark.createDataFrame(rows, "doc_id long, text string"), rows, length=10, gram=3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 300)))) for i in range(40)]
    _substrings(spark.createDataFrame(rows, "doc_id long, text string"), rows, length=6, gram=2)
    for kinds in (0, 2, 5):
        _substrings(spark.createDataFrame(rows, "doc_id long, text string"), rows, length=6, gram=2, hot_kinds=kinds)


def test_a_passage_in_very_many_contexts_and_null_ids(spark):
    """The edges of a passage meet in few anchors with a kind of stretch for each document; null ids don't mix texts up."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(70))
    filler = lambda n: " ".join(f"f{rng.randrange(10**9)}" for _ in range(n))
    rows = [(None if i % 3 else i, f"{filler(40)} {passage} {filler(40)}") for i in range(90)] * 2
    rows += [(None, f"{filler(30)}\t{passage}") for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _substrings(df, rows, hot_kinds=16)
    _substrings(df, rows)


def test_substrings_at_the_threshold(spark):
    rng = random.Random(6)
    piece = [f"p{i}" for i in range(35)]
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    rows = [(1, " ".join(filler(20) + piece + filler(20))), (2, " ".join(filler(3) + piece)), (3, " ".join(filler(9) + piece[:34] + filler(9))), (4, "  ".join(filler(50)))]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 35, 2: 35, 3: 0, 4: 0}


def test_automaton_counts_every_factor():
    rng = random.Random(2)
    for _ in range(40):
        texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 25))) for _ in range(6)]
        weights = [rng.randrange(1, 4) for _ in texts]
        automaton = SuffixAutomaton(texts, weights)
        for length in (1, 3, 5):
            total = defaultdict(int)
            for t, w in zip(texts, weights):
                for i in range(len(t) - length + 1):
                    total[t[i : i + length]] += w
            for t in [*texts, "abcabcabcacb"]:
                want = [i + length for i in range(len(t) - length + 1) if total[t[i : i + length]] >= 2]
                assert list(automaton.repeated_ends(t, length)) == want


def test_stretches_own_every_window_once():
    rng = np.random.default_rng(1)
    for n in (34, 35, 36, 500):
        hashes = rng.integers(0, 1 << 63, n).astype(np.uint64)
        _, _, first, windows = substrings.stretches(hashes)
        own = [x for f, w in zip(first, windows) for x in range(f, f + w)]
        assert own == list(range(max(0, n - 34))) and (windows < 32).all()


def brute_lines(rows, least=40, docs=5):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(_SPACE))
    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            holders[k].append(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = []
        for x in parts:
            own = holders[key(x)]
            named = [h for h in own if h is not None]
            if len(key(x)) >= least and len(own) >= docs and named and i != max(named):
                continue
            kept.append(x)
        out.append((len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def _lines(df, rows, **options):
    want = sorted(((i is None, i or 0), *x) for (i, _), x in zip(rows, brute_lines(rows)))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_lines"], r["n_dropped"], r["text"] or "") for r in lines.dedup_lines(df, **options).collect())
    assert got == want


def test_lines_of_odd_rows(odd, odd_rows, nothing):
    rows = [(i, t) for i, t, _ in odd_rows]
    _lines(odd, rows)
    _lines(odd, rows, bits=500_000)  # in many segments
    assert lines.dedup_lines(nothing).collect() == []
    null = lines.dedup_lines(odd).where("doc_id = 1").first()
    assert null["text"] is None and null["n_lines"] == 1


def test_lines_at_the_thresholds(spark):
    forty, short = "é" * 40, "é" * 39
    rows = [(i, f"{forty}\n{short}\n\n{i}") for i in range(5)] + [(10 + i, "four documents hold this line of text, no more") for i in range(4)] + [(30, "x\r\n y "), (None, forty), (31, f"{forty}\n{forty}")]
    _lines(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_line_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    _lines(docs, rows)
    _lines(docs, rows, filter_bytes=0, bits=5000)  # a filter that is too large to broadcast
    sums = lines.dedup_lines(docs).select(F.sha2(F.col("text").cast("binary"), 256).alias("h"), "text").first()
    assert sums["h"] == hashlib.sha256(sums["text"].encode()).hexdigest()


def test_words_that_polynomials_confuse(spark):
    """Words that follow the Thue-Morse sequence and its complement have equal polynomials modulo 2**64, in any base."""
    morse = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join("ab"[x ^ y] for x in morse) for y in (0, 1))
    common = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{common} {one}"), (2, f"{common} {other}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"hot_kinds": 0}):
        _substrings(df, rows, **options)
        assert {r["n_removed"] for r in substrings.dedup_substrings(df, **options).collect()} == {0}


def test_hashes_of_many_long_words_differ():
    rng = random.Random(5)
    words = set()
    while len(words) < 200_000:
        base = rng.randbytes(64).hex()
        words |= {(base * 9)[:1000].encode(), (base * 9)[:999].encode() + b"x"}
    words = list(words)
    assert len(np.unique(substrings.word_hashes(words))) == len(words)
    digest = lambda w: substrings.digest(w, b"key")
    assert len({digest(words[i : i + 2]) for i in range(0, len(words), 2)}) == len(words) // 2
    assert digest([b"a", b"b"]) != digest([b"ab"]) != digest([b"b", b"a"]) and digest([b"a"]) != substrings.digest([b"a"], b"other")
