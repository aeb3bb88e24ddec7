import hashlib
import random
import re

from tramloom.llm import decontamination

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words_of(t)
        for a in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[a : a + width]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, names = words_of(t), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[a : a + n]))) is not None:
                    hit.update(range(a, a + n))
                    names |= {str(x) for x in own if x is not None}
        out.append(((d is None, d or 0), len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def _against(spark, docs, items, **options):
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.contamination(d, b, **options).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows) == brute(docs, items)


def _cases(odd_rows):
    rng = random.Random(1)
    items = [(i, " ".join(f"t{rng.randrange(60)}" for _ in range(rng.randrange(1, 25)))) for i in range(30)]
    items += [(100, None), (101, " ,;. "), (None, "t1 t2 t3 t4 t5 t6 t7 t8 t9 t10 t11"), (102, "One, TWO!"), (103, "one two"), (7, items[3][1])]
    docs = [(i, t) for i, t, _ in odd_rows]
    docs += [(500 + i, "pre fix, " + " ".join(f"T{rng.randrange(60)}" for _ in range(30)) + "; " + (items[i % 30][1] or "").upper().replace(" ", " -- ") + " after") for i in range(40)]
    docs += [(600, "t1 t2 t3 t4 t5 t6 t7 t8 t9 t10 t11"), (601, "t1 t2 t3 t4 t5 t6 t7 t8 t9")]
    return docs, items


def test_against_brute_force(spark, odd_rows):
    docs, items = _cases(odd_rows)
    _against(spark, docs, items)


def test_hashes_in_parts_and_a_join_by_shuffle(spark, odd_rows):
    docs, items = _cases(odd_rows)
    _against(spark, docs, items, hash_bytes=500, room=0)


def test_very_frequent_words_and_passages(spark):
    """A hot passage, windows of frequent words only, short items; also where one shingle stands in most documents."""
    rng = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(1, passage), (2, "the cat " * 8), (3, "the the the the the the the the the the the"), (4, "the"), (5, "the cat"), (6, f"the {passage}")]
    docs = [(i, " ".join(rng.choice(["the", "cat", "sat", passage]) for _ in range(40))) for i in range(60)]
    _against(spark, docs, items)
    _against(spark, docs, items, room=0)


def test_empty_tables(spark, odd, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontamination.contamination(odd, bench).collect())
    assert decontamination.contamination(nothing, bench).collect() == []


def test_stage_drops_only_contaminated(spark):
    item = " ".join(f"b{i}" for i in range(15))
    docs = spark.createDataFrame([(1, f"x {item} y", 5), (2, "clean words", 6), (None, item, 7), (3, None, 8)], "doc_id long, text string, extra int")
    left = decontamination.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == ["doc_id", "text", "extra"] and sorted(r["doc_id"] for r in left.collect()) == [2, 3]
