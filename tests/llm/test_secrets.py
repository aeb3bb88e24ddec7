import math
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramloom.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def _scan(df):
    rows = secrets.scan_secrets(df).select("doc_id", secrets.joined(F.col("base")).alias("base"), secrets.joined(F.col("random")).alias("random"))
    return {r["doc_id"]: r for r in rows.collect()}


def test_base_spans_match_brute_force(spark):
    rng = random.Random(1)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [None, "", "none here", "token=secret=abcdefgh12", "token=apikey: abcdefgh1234", "Password: 'short' API_KEY=\"abcdEFGH12345678\"", "é" * 9 + " AKIA" + "Z9" * 8 + " AKIAshort AKIAAAAKIA" + "B" * 9, f"x{hexes(31)} {hexes(32)}-{hexes(64)}", f"{hexes(32)}", "passwd = = abcdefghij", "\U0001f600 token:\x20\x20abcdefgh\nsecret=12345678", "SECRET='" + hexes(40) + "' " * 3]
    texts += ["".join(rng.choice(["token", "=", ":", " ", "'", "abcdefgh", "AKIA", "QWERTYUIOP12", hexes(33), "\n", "é"]) for _ in range(40)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = _scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {i: got[i]["base"] for i in got} == {i: brute(t) for i, t in rows}


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(7)
    letters = string.ascii_letters + string.digits + "+/"
    planted = {i: "".join(rng.choice(letters) for _ in range(44)) for i in range(20)}
    words = ["verkeitschheitlichengeber", "internationalisation-of-things", "counterrevolutionaries", "AbstractSingletonProxyFactoryBean", "aaaaaaaaaaaaaaaaaaaaaaaa", "0123456789012345678901234567", "the_quick_brown_fox_jumps_over_it", "=" * 40, "-" * 60]
    rows = [(i, f"some prose {rng.choice(words)} then {planted[i]} and {rng.choice(words)}") for i in planted] + [(100 + i, f"only {w} and {rng.choice(words)}") for i, w in enumerate(words * 4)]
    got = _scan(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = dict(rows)
    hit = 0
    for i, r in got.items():
        for span in filter(None, r["random"].split(",")):
            _, a, b = span.split(":")
            assert i in planted and texts[i][int(a) : int(b)] == planted[i]
            hit += 1
    assert hit >= 18


RANDOM = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": string.ascii_letters + string.digits + "+/"}


@pytest.mark.parametrize("kind", RANDOM)
def test_planted_tokens_of_every_encoding_and_length_are_found(spark, kind):
    rng = random.Random(kind)
    rows = [(1000 * n + i, f"some prose then {''.join(rng.choice(RANDOM[kind]) for _ in range(n))} and more") for n in (20, 24, 28, 32, 40, 64) for i in range(60)]
    got = _scan(spark.createDataFrame(rows, "doc_id long, text string"))
    for n in (20, 24, 28, 32, 40, 64):
        hit = sum(bool(got[1000 * n + i]["random"] or got[1000 * n + i]["base"]) for i in range(60))
        assert hit >= 54, (kind, n, hit)


def brute_random(texts, level=secrets.FALSE_DISCOVERY):
    """The random spans of each text, by numpy and exact p-values on the same grid."""
    found, strata = [], {}
    for i, text in enumerate(texts):
        base = [(int(a), int(b)) for _, a, b in (x.split(":") for x in brute(text).split(",") if x)]
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text or ""):
            if len(token := m[0]) < 20:
                continue
            e = 0 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", token) else 1 if re.fullmatch("[A-Z2-7]+=*", token) else 2
            plain = (token.lower() if e == 0 else token).translate(str.maketrans("-_", "+/"))
            x = np.array([[(secrets.ALPHABETS[e] + "=").index(c) for c in plain]])
            n = len(token)
            length = max(k for k in secrets.LENGTHS if k <= n)
            chi, changes, serial = secrets.measures(np.where(x == 64, 63, x) if e == 2 else x, e)[0]
            counts = np.array([plain.count(c) for c in set(plain)]) if e else np.array([token.lower().count(c) for c in set(token.lower())])
            if e == 2:  # "-" and "+" are letters of their own in the count
                counts = np.array([token.count(c) for c in set(token)])
            chi = len(secrets.ALPHABETS[e]) / n * (counts.astype(float) ** 2).sum() - n
            d = x[0] - x.mean()
            serial = (d[1:] * d[:-1]).sum() / max((d * d).sum(), 1e-9)
            bare = token.translate(str.maketrans("", "", "+/-_="))
            changes = (max(1, len(re.findall("[A-Z]+|[a-z]+|[0-9]+", bare.lower() if e == 0 else bare))) - 1) / (n - 1)
            w = secrets.scoring(e, length)
            excess = (w[0] * chi + w[1] * changes + w[2] * serial - w[3]) / w[4]
            expected = secrets.changes_expected(e)
            regular = abs(serial) > secrets.STRAY / n**0.5 or changes > expected + secrets.STRAY * (expected * (1 - expected) / (n - 1)) ** 0.5
            grade = -1 if excess < 0 or regular else min(secrets.WORST, math.floor(excess * secrets.STEPS / math.log(10)))
            strata.setdefault((e, length), []).append(grade)
            free = not any(a < m.end() and m.start() < b for a, b in base)
            found.append((i, m.start(), m.end(), (e, length), grade, free))
    out = {i: [] for i in range(len(texts))}
    for i, a, b, key, grade, free in found:
        grades = strata[key]
        cut = [g for g in set(grades) if g >= 0 and secrets.TOP * 10 ** (-g / secrets.STEPS) * len(grades) / sum(h >= g for h in grades) <= level]
        if free and cut and grade >= min(cut):
            out[i].append(f"random:{a}:{b}")
    return {i: ",".join(x) for i, x in out.items()}


def test_random_spans_match_brute_force(spark, sf):
    rng = random.Random(2)
    names = lambda n: "".join(rng.choice(["user", "Name", "get", "42", "-", "_x", "Config", "2024", "HTTP", "/", "value"]) for _ in range(n))
    texts = [None, "", "=" * 40, "-" * 60, "0123456789" * 5, "0123456789abcdef" * 3, "a1" * 20, "abcdefghijklmnopqrstuvwxyz" * 2]
    for _ in range(300):
        parts = [names(rng.randrange(3, 12)), "".join(rng.choice(RANDOM[rng.choice(list(RANDOM))]) for _ in range(rng.randrange(18, 60))), "".join(rng.choice("abcdef") for _ in range(25)), "\u00e9 words"]
        texts.append(" ".join(rng.choice(parts) for _ in range(5)))
    texts += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(300).collect()]
    got = _scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {i: r["random"] for i, r in got.items()} == brute_random(texts)


def test_p_values_hold_for_names_and_tell_random_tokens_apart():
    rng = np.random.default_rng(77)
    for e, alphabet in enumerate(secrets.ALPHABETS):
        for n in (20, 28, 40):
            *w, top, excess = secrets.scoring(e, n)
            p = lambda x: secrets.TOP * np.exp(-(secrets.measures(x, e) @ np.array(w) - top) / excess)  # noqa: E731, B023
            null = p(secrets.names(e, n, 20_000, rng))
            assert abs((null <= 0.1).mean() - 0.1) < 0.02 and (null <= 0.01).mean() < 0.02
            assert (p(rng.integers(0, len(alphabet), (4000, n))) <= 0.09).mean() > 0.92


def test_positions_of_very_many_matches(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice(["token=abcdefgh12", "x", "é", "secret: 'short'"]) for _ in range(9000))
    got = _scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert got[1]["base"] == brute(text)


def test_odd_rows_and_no_python(odd, nothing, odd_rows):
    assert len(_scan(odd)) == len({i for i, _, _ in odd_rows})
    assert _scan(nothing) == {}
    plan = odd.sparkSession._jvm.PythonSQLUtils.explainString(odd.select(secrets.base_spans(F.col("text"), 0))._jdf.queryExecution(), "simple")
    assert "Python" not in plan and "Arrow" not in plan


def test_false_discovery_control_is_length_aware():
    counts = {(2, 0): {-1: 500, 0: 100, 8: 100, 20: 1}, (2, 4): {-1: 10, 9: 90}}
    least = secrets.least_grades(counts)
    assert least[(2, 0)] == 8 and least[(2, 4)] == 9
