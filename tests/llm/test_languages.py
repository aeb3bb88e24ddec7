import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramloom.llm import languages, ppm
from tramloom.llm.queries import op12_ppm_language


class Plain:
    """One language's context tree, as dictionaries, byte by byte."""

    def __init__(self, text, order):
        self.order, self.after = order, defaultdict(Counter)
        text = b"\n" * order + text
        for i in range(order, len(text)):
            for k in range(order + 1):
                self.after[text[i - k : i]][text[i]] += 1

    def bits(self, context, byte):
        k = next((k for k in range(self.order, -1, -1) if self.after.get(context[len(context) - k :])), -1)
        out, excluded = 0.0, set()
        while k >= 0:
            seen = self.after[context[len(context) - k :]]
            left = {b: n for b, n in seen.items() if b not in excluded}
            n, q = sum(left.values()), len(left)
            if byte in left:
                return out + math.log2((n + q) / left[byte])
            if q:
                out += math.log2((n + q) / q)
            excluded |= set(seen)
            k -= 1
        return out + math.log2(256 - len(excluded))

    def text_bits(self, text):
        text = b"\n" * self.order + text
        return sum(self.bits(text[i - self.order : i], text[i]) for i in range(self.order, len(text)))


def _texts(rng, kinds, n):
    return [bytes(rng.choice(kinds) for _ in range(n)) for _ in range(4)]


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_code_lengths_are_those_of_plain_trees(order):
    rng = random.Random(order)
    samples = _texts(rng, b"ab c", 80) + [b"abracadabra " * 9, b"", bytes(range(256)), b"\xc3\xa9t\xc3\xa9 " * 5]
    trees, plain = ppm.Trees(samples, order), [Plain(s, order) for s in samples]
    asked = [b"", b"a", b"abra cadabra", b"zzzz", b"\xff\x00\n\n", bytes(rng.choice(b"ab cdz\n") for _ in range(200)), "été à".encode()]
    want = np.array([[p.text_bits(t) for p in plain] for t in asked])
    for room in (7, 50, 1 << 17):
        assert np.allclose(trees.text_bits(asked, room), want, rtol=1e-9, atol=1e-9)


def test_probabilities_of_a_context_sum_to_one():
    trees = ppm.Trees([b"mississippi missouri", b"banana bandana"], 3)
    for context in (b"iss", b"ana", b"xxx", b"xis", b"\n\n\n"):
        bits = trees.text_bits([b""])  # no byte, no bits
        assert not bits.any()
        each = np.array([trees.code_lengths(np.frombuffer(context + bytes([b]), np.uint8))[0] for b in range(256)])
        assert np.allclose((2.0**-each).sum(0), 1)


def test_index_finds_what_it_holds_and_nothing_else():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    index = ppm.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    other = rng.integers(0, 1 << 40, 5000).astype(np.uint64)
    assert (index.find(other)[~np.isin(other, keys)] == -1).all()
    assert (ppm.Index(keys[:0]).find(other) == -1).all()


def test_held_out_accuracy_of_the_query(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = op12_ppm_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = got.select("doc_id", "held_out", "lang_pred", "score", "lang").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert len(unseen) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) >= 0.97 * len(unseen)


ENGLISH, FRENCH = "the quick brown fox jumps over the lazy dog and runs away ", "le renard brun saute par dessus le chien paresseux et part "


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_odd_rows_and_held_out_languages(spark):
    rows = [(i, (ENGLISH if i % 2 else FRENCH) * 3, "en" if i % 2 else "fr") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, " 12 +-= ", "fr"), (103, ENGLISH * 20_000, None), (104, "le chien", None), (104, "le chien", None), (None, "the dog and the fox", "fr"), (105, "的" * 50, None), (106, "\x00", "en")]
    df = _frame(spark, rows).withColumn("score", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    got = languages.predict_languages(df.withColumn("LANG_PRED", F.lit(1)), trained=F.col("doc_id") < 60)
    assert got.columns == ["doc_id", "text", "lang", "n", "lang_pred", "score"]
    found = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got.collect()}
    assert got.count() == len(rows)
    for i, text, lang in rows[:60]:
        assert found[i, text][0] == lang
    for i in (100, 101, 102, 106):
        assert found[next(k for k in found if k[0] == i)] == ("und", 0.0)
    assert found[103, ENGLISH * 20_000][0] == "en" and found[104, "le chien"][0] == "fr" and found[None, "the dog and the fox"][0] == "en"
    assert found[105, "的" * 50][0] in ("en", "fr")
    again = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in languages.predict_languages(df.repartition(5), trained=F.col("doc_id") < 60).collect()}
    assert again == found


def test_nothing_learnt_and_no_rows(spark, nothing):
    assert languages.predict_languages(nothing).collect() == []
    df = _frame(spark, [(1, "the dog", None), (2, None, "en")])
    assert {r["lang_pred"] for r in languages.predict_languages(df).collect()} == {"und"}
    one = _frame(spark, [(1, "the dog", "en"), (2, "le chien", None)])
    assert [(r["lang_pred"], r["score"]) for r in languages.predict_languages(one).orderBy("doc_id").collect()] == [("en", 1.0), ("en", 1.0)]


def test_the_sample_is_bounded_and_reaches_into_long_texts(spark):
    rows = [(i, f"w{i} " * 4000, "a" if i % 3 else "b") for i in range(30)] + [(99, "z" * 10, "c")]
    sample = languages.learn_sample(_frame(spark, rows), sample_chars=60_000, piece=500)
    assert list(sample) == ["a", "b", "c"] and all(len(b"".join(x)) <= 30_000 for x in sample.values())
    assert min(len(b"".join(sample[x])) for x in "ab") >= 8_000 and sample["c"] == [b"z" * 10]
    assert len({p.split()[1] for p in sample["a"] if len(p.split()) > 1}) > 5
    few = languages.learn_sample(_frame(spark, [(i, "text", f"l{i % 7}") for i in range(70)] + [(i, "x", "rare") for i in (1,)]), most=3)
    assert len(few) == 3 and "rare" not in few
