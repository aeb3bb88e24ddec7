import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tramloom.llm import simhash
from tramloom.llm.bktree import Forest, find, unite
from tramloom.llm.graph import components


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, prints, radius=3):
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                label[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        if r is not None:
            ids[root(i)] = min(ids.get(root(i), r), r)
    return [ids.get(root(i)) for i in range(len(rows))]


def _against_brute(df, rows, **options):
    prints = [brute_fingerprint(t) for _, t in rows]
    comps = brute_components([i for i, _ in rows], prints)
    want = sorted(((i is None, i or 0), f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, comps))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["fingerprint"], r["component_id"]) for r in simhash.simhash_classes(df, **options).collect())
    assert got == want


def test_odd_rows_and_small_parts(odd, odd_rows, nothing):
    _against_brute(odd, [(i, t) for i, t, _ in odd_rows])
    _against_brute(odd, [(i, t) for i, t, _ in odd_rows], shard=2)  # every shard is dealt into parts
    assert simhash.simhash_classes(nothing).collect() == []


def test_planted_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(3000)]
    rows = [(i, " ".join(f"v{rng.randrange(5000)}" for _ in range(80))) for i in range(40)]
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(0, 12)):
            copy[rng.randrange(len(copy))] = "edit"
        rows.append((100 + i, " ".join(copy)))
    _against_brute(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    _against_brute(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("radius", [0, 3, 20])
def test_forest_finds_all_pairs(radius):
    rng = np.random.default_rng(radius)
    codes = np.unique(np.r_[rng.integers(0, 1 << 63, 300).astype(np.uint64), np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))])
    tree = np.sort(rng.integers(0, 3, len(codes)))
    got = {(int(a), int(b)) for q, n in Forest(codes, tree).pairs(radius, room=500) for a, b in zip(q, n)}
    want = {(i, j) for i in range(len(codes)) for j in range(i) if tree[i] == tree[j] and bin(int(codes[i]) ^ int(codes[j])).count("1") <= radius}
    assert got == want
    parent = np.arange(5)
    unite(parent, np.array([1, 3, 4]), np.array([0, 4, 1]))
    assert find(parent, np.arange(5)).tolist() == [0, 0, 2, 0, 0]


def test_block_masks_cover_every_pattern():
    for rows in (10, 1 << 30, 1 << 40):
        masks = simhash.block_masks(3, rows)
        rng = random.Random(rows)
        for _ in range(300):
            flip = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(flip & m == 0 for m in masks)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}


def _jaccard(a, b, k=5):
    sets = [{tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_duplicates_keep_one_of_each_group(spark, odd, odd_rows, nothing):
    rng = random.Random(8)
    rows = []
    for g in range(30):
        base = [f"g{rng.randrange(3000)}" for _ in range(250)]
        rows.append((g * 100, " ".join(base), "en"))
        for c in range(4):
            copy = list(base)
            for _ in range(0 if c == 0 else 3):  # three edits touch 15 of 246 shingles at most
                copy[rng.randrange(250)] = f"e{rng.randrange(9999)}"
            rows.append((g * 100 + c + 1, " ".join(copy), "en"))
        other = [w if i % 4 else f"o{rng.randrange(9999)}" for i, w in enumerate(base)]
        rows.append((g * 100 + 50, " ".join(other), "en"))
        assert _jaccard(rows[-1][1], rows[-6][1]) < 0.3
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(x for g in range(30) for x in (g * 100, g * 100 + 50))
    left = simhash.keep_one(odd).collect()
    assert len([r for r in left if not (r["text"] or "").strip()]) == 1 and len([r for r in left if r["doc_id"] == 4]) == 1
    assert {r["doc_id"] for r in left} >= set(range(40, 70)) | {8} and 9 not in {r["doc_id"] for r in left}
    assert simhash.keep_one(nothing).collect() == []


def _templated(rng, n, words, own, name="t"):
    """n documents of one template of ``words`` words, each followed by ``own`` words of its own."""
    base = [f"{name}{i}" for i in range(words)]
    return [base + [f"o{rng.randrange(1 << 40)}" for _ in range(own)] for _ in range(n)]


def _classes(spark, docs, **options):
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["class_id"] for r in simhash.near_duplicates(rows, **options).collect()}


def _set_classes(docs, similarity=0.8):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    return label


def _same_partition(found, want):
    return len({(found[i], w) for i, w in enumerate(want)}) == len(set(found.values())) == len(set(want))


@pytest.mark.parametrize("options", [{}, {"room": 20_000}])
def test_templated_documents_under_the_threshold_stay_apart(spark, options):
    docs = _templated(random.Random(4), 300, 204, 26, "g")  # 200 of 252 shingles in common, 0.794, and sketches that say 0.89 of some
    assert abs(_jaccard(" ".join(docs[0]), " ".join(docs[1])) - 0.794) < 0.001
    docs[299] = docs[3][:-4] + ["x", "y", "z", "u"]
    want = _set_classes(docs)
    assert len(set(want)) == 299
    assert _same_partition(_classes(spark, docs, **options), want)


def test_planted_pairs_in_a_templated_group_are_found(spark):
    rng = random.Random(6)
    docs = _templated(rng, 700, 204, 33)  # pairwise 0.75
    for i in range(0, 140, 2):  # 18 words in common beside the template's: 0.81
        docs[i + 1] = docs[i][: 204 + 10] + docs[i + 1][204 + 10 :]
    want = _set_classes(docs)
    assert len(set(want)) == 630
    assert _same_partition(_classes(spark, docs), want)


def test_documents_that_repeat_a_passage_unlike_often(spark):
    rng = random.Random(9)
    docs = []
    for g in range(60):
        body, passage = ([f"r{rng.randrange(1 << 40)}" for _ in range(n)] for n in (200, 20))
        docs += [body + passage, body + passage * 60]
    want = _set_classes(docs)
    assert len(set(want)) == 60
    assert _same_partition(_classes(spark, docs), want)


def exact_classes(texts, similarity=0.8):
    """Least id of each one's class, by all pairs of sets that share a shingle of their rare fifth (which two sets so alike must)."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().encode().split()) else set() for i, t in texts}
    seen = Counter(x for s in sets.values() for x in s)
    label, places = {i: i for i in sets}, defaultdict(list)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, own in sorted(sets.items(), key=lambda x: len(x[1])):
        rare = sorted(own, key=lambda x: (seen[x], x))[: len(own) - math.ceil(similarity * len(own)) + 1]
        for j in {j for x in rare for j in places[x]}:
            if len(own & sets[j]) >= similarity * len(own | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
        for x in rare:
            places[x].append(i)
    empty = [i for i, s in sets.items() if not s]
    return {i: min(empty) if i in empty else find(i) for i in sets}


def test_near_duplicate_classes_are_exact_on_a_whole_table(spark, sf):
    """No link is lost and none is made: the classes are those of all pairs of 0.8 or more."""
    docs = spark.read.parquet(f"{os.path.dirname(sf)}/sf0.01/documents.parquet")
    want = exact_classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    found = {r["doc_id"]: r["class_id"] for r in simhash.near_duplicates(docs).collect()}
    assert len(set(want.values())) < len(want) - 30
    assert len({(found[i], w) for i, w in want.items()}) == len(set(found.values())) == len(set(want.values()))
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == set(want.values())


def test_the_one_kept_of_rows_alike_does_not_change(spark):
    rows = [(1, "a b c d e f g", f"l{i}") for i in range(40)]
    keep = lambda n: [tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n)).collect()]
    assert len(keep(1)) == 1 and keep(1) == keep(6)
