import numpy as np
from pyspark.sql import functions as F

from tramloom.llm import queries, toxicity
from tramloom.llm.recurrent import backward, forward, new_params


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in new_params(5, 5, 3, 4, 3, rng).items()}
    steps, batch = 5, 3
    xf, xb = rng.normal(size=(2, steps, batch, 12))
    mask = np.ones((steps, batch))
    mask[3:, 1] = 0
    mask[:, 2] = 0
    loss = lambda: float(forward(p, xf, xb, mask)[0].sum())
    _, cache = forward(p, xf, xb, mask, keep=True)
    g, dxf, dxb = backward(p, np.ones(batch), mask, cache)

    def numeric(x):
        out, step = np.zeros_like(x), 1e-2
        for i in np.ndindex(x.shape):
            old = x[i]
            x[i] = old + step
            up = loss()
            x[i] = old - step
            out[i] = (up - loss()) / (2 * step)
            x[i] = old
        return out

    for name in ("Uf", "Ub", "A", "a", "v", "w", "o"):
        assert np.allclose(g[name], numeric(p[name]), atol=3e-3), name
    assert np.allclose(dxf, numeric(xf), atol=3e-3) and np.allclose(dxb, numeric(xb), atol=3e-3)


def _auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    pos = np.asarray(y) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 32, 33, 56, 57, 1000):
        starts = toxicity.window_starts(n)
        assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n and all(0 < b - a < toxicity.WINDOW for a, b in zip(starts, starts[1:]))
        assert set(toxicity.windowed(list(range(1, n + 1))).ravel()) - {0} == set(range(1, n + 1))


def test_held_out_documents_are_ranked(spark):
    """The query as it ships, on labels that it never learns from."""
    sf = "/root/testdata/sf0.1"
    scored = queries.op9_toxicity_gru(spark, sf).where("held_out")
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "predicted", "toxic").collect()
    y, s = [r["toxic"] for r in rows], np.array([r["score"] for r in rows])
    assert len(rows) > 500 and _auc(y, s) > 0.93  # some labels are wrong on purpose
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.95


def test_the_training_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 40, f"text {i} " + "w " * (i % 9)) for i in range(400)] + [(7, "x" * 5000)] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    texts, marks = toxicity.training_rows(docs, labels, "text", "doc_id", 20, 400)
    assert len(texts) == len(marks) <= 20 and sum(map(len, texts)) <= 400 and len(set(texts)) == len(texts)
    again = toxicity.training_rows(docs.repartition(3), labels, "text", "doc_id", 20, 400)
    assert again == (texts, marks)


def test_odd_rows_and_labels(spark, odd, odd_rows, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40, 70)] + [(1, None), (None, 1), (9999, 1), (41, 0)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {round(r["score"], 9) for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1
    one = labels.where("toxic = 1")
    assert {r["score"] for r in toxicity.score_toxicity(odd, one).collect()} == {1.0}
    assert {r["score"] for r in toxicity.score_toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(nothing, labels).collect() == []


def test_long_runs_are_read_whole():
    for run in ("".join(chr(0x4E00 + i) for i in range(500)), "ab" * 24, "é" * 25, "x" + "𝒳y" * 90, "under_scored." * 40):
        word = run.encode()
        pieces = [x.removeprefix(b" ") for x in toxicity.tokens(b"one " + word + b" two")[1:-1]]
        assert all(len(x) <= toxicity.LONG and x.decode() for x in pieces)
        grams = {g for x in pieces for g in (x[i : i + 3] for i in range(len(x) - 2))}
        assert grams == {word[i : i + 3] for i in range(len(word) - 2)}
    assert toxicity.tokens(b" a  b\n") == [b"a", b"b"] and toxicity.tokens(b"") == []
    # each byte of a word of any length moves its trigrams
    for n in (45, 48):
        plain, changed = (toxicity.Features(toxicity.tokens(w)).grams.tolist() for w in (b"q" * n, b"q" * (n - 6) + b"zzz" + b"q" * 3))
        assert plain != changed


def test_toxic_words_inside_unspaced_texts_are_recognised():
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(600):
        run = "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 300, 120))
        texts.append((run[:60] + "毒語" * (i % 2) + run[60:]).encode())
        labels.append(i % 2)
    p = toxicity.train(texts[:450], labels[:450])
    scores = np.array(toxicity.score_texts(p, toxicity.Inputs(p), texts[450:]))
    assert _auc(labels[450:], scores) > 0.9


def test_scores_of_whole_texts_against_a_plain_forward_pass():
    """Word by word in double precision, from the parameters alone: inputs, both directions, attention, the best window."""
    from tramloom.llm.common import mix64

    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["good", "Vile", "été", "x" * 60, "a,", "day", "(no)"], n)).encode() for n in (1, 5, 31, 32, 33, 90)] + [b"", "毒語".encode() * 40]
    p = toxicity.train([t for t in texts if t] * 3, [i % 2 for i in range(7)] * 3, epochs=3)
    d = {k: v.astype(float) for k, v in p.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))
    n = toxicity.HIDDEN

    def vector(word):
        if word[:1] == b" ":
            plain, edged = b" ", word[1:].lower()
        else:
            plain = word.lower().strip(toxicity._STRIP)
            edged = b"^" + plain + b"$"
        edged = edged if len(edged) > 2 else edged.ljust(3)
        grams = [int(mix64(np.array([a << 16 | b << 8 | c], np.uint64))[0] % np.uint64(toxicity.GRAMS)) for a, b, c in zip(edged, edged[1:], edged[2:])]
        import xxhash

        return np.concatenate([d["word"][xxhash.xxh3_64_intdigest(plain) % toxicity.WORDS], np.mean([d["gram"][g] for g in grams], axis=0)])

    def states(vectors, way):
        h, out = np.zeros(n), []
        for x in vectors:
            x, u = x @ d[f"W{way}"] + d[f"c{way}"], h @ d[f"U{way}"]
            z, r = sig(x[:n] + u[:n]), sig(x[n : 2 * n] + u[n : 2 * n])
            h = z * h + (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :])
            out.append(h)
        return out

    def logit(words):
        if not words:
            return d["o"][0]
        v = [vector(w) for w in words]
        h = np.concatenate([states(v, "f"), states(v[::-1], "b")[::-1]], axis=1)
        weight = np.exp(np.tanh(h @ d["A"] + d["a"]) @ d["v"])
        return (weight / weight.sum()) @ h @ d["w"] + d["o"][0]

    got = toxicity.score_texts(p, toxicity.Inputs(p), texts)
    for text, score in zip(texts, got):
        words = toxicity.tokens(text)
        want = max(logit(words[s : s + toxicity.WINDOW]) for s in toxicity.window_starts(len(words)))
        assert abs(score - sig(want)) < 1e-4
