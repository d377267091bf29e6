import random

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import langid


def test_gradient_is_that_of_the_loss():
    """Against finite differences in double precision, in every table of weights."""
    rng = np.random.default_rng(1)
    net = langid.Network(["x", "y", "z"], hidden=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, lab = rng.integers(97, 103, (9, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    mask = np.ones((9, 5))
    mask[6:, 1] = mask[2:, 3] = 0
    _, grad = net.gradient(x, lab, mask)
    for name, w in net.w.items():
        used = [(i, j) for i in range(w.shape[0]) for j in range(w.shape[1]) if name[0] != "W" or j in x]
        for at in [used[k] for k in rng.choice(len(used), min(12, len(used)), replace=False)]:
            sides = []
            for step in (1e-5, -1e-5):
                w[at] += step
                sides.append(net.gradient(x, lab, mask)[0])
                w[at] -= step
            assert abs((sides[0] - sides[1]) / 2e-5 - grad[name][at]) < 1e-7, (name, at)


def test_a_fitted_network_tells_what_only_order_does():
    rng = random.Random(1)
    texts = [(b"abc " if k else b"acb ") * rng.randrange(8, 20) for k in [0, 1] * 60]
    net = langid.Network(["x", "y"])
    net.fit(texts, np.array([0, 1] * 60), steps=150)
    p = net.probabilities(texts)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    assert (p.argmax(axis=1) == np.array([0, 1] * 60)).mean() > 0.95


def test_probabilities_equal_a_plain_loop_over_bytes():
    """Every byte by its own recurrence, state by state, runs of RUN bytes."""
    net = langid.Network(["x", "y", "z"])
    w, n = {k: v.astype(np.float64) for k, v in net.w.items()}, net.n
    sigmoid = lambda v: 1 / (1 + np.exp(-v))

    def states(run, d):
        h, out = np.zeros(n), []
        for byte in run:
            g, u = w["W" + d][:, byte], w["U" + d] @ h
            z, r = sigmoid(2 * (g[:n] + u[:n])), sigmoid(2 * (g[n : 2 * n] + u[n : 2 * n]))
            h = z * h + (1 - z) * np.tanh(g[2 * n :] + r * u[2 * n :])
            out.append(h)
        return out

    for text in (b"a", b"the cat " * 40, bytes(range(1, 200))):
        total = np.zeros(3)
        for lo in range(0, len(text), langid.RUN):
            run = text[lo : lo + langid.RUN]
            for f, b in zip(states(run, "f"), states(run[::-1], "b")[::-1]):
                e = np.exp(w["V"] @ np.concatenate((f, b)) + w["b"][:, 0])
                total += e / e.sum()
        assert np.allclose(net.probabilities([text])[0], total / len(text), atol=1e-4)


def test_only_letters_count(spark):
    rows = [(1, "½ ²", None), (2, "①", None), (3, "٣ 7", None), (4, "ª", None), (5, "ß", None)] + [(i, "the house and the", "en") for i in range(10, 20)] + [(i, "der die und das", "de") for i in range(20, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.train(docs, F.lit(True))).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and "und" not in (got[4], got[5])


def test_runs_are_pooled_alike_for_any_batch():
    net = langid.Network(["x", "y", "z"])
    texts = [b"a" * n + b"q" * (n % 7) for n in (1, 5, 127, 128, 129, 400, 1000)]
    whole = net.probabilities(texts)
    assert np.allclose(whole, np.concatenate([net.probabilities([t]) for t in texts]), atol=1e-5)


def test_documents_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, None, "en"), (5, "123 !?", None), (6, "", "fr"), (7, "the of and " * 9000, None)], "doc_id long, text string, lang string")
    rows = docs.union(odd).withColumn("score", F.lit("clash"))
    out = langid.predict(rows, langid.train(rows, ~langid._held_out())).select("doc_id", "lang_pred", "score").collect()
    assert len(out) == docs.count() + 4 and all(0 <= r.score <= 1 for r in out)
    assert sum(r.lang_pred == "und" and r.score == 0 for r in out) == 3
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out if r.doc_id not in (None, 5, 6, 7)]) > 0.97


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.predict(docs, langid.train(docs, F.lit(True))).collect()] == ["und"]
    assert langid.predict(docs.limit(0), None).count() == 0


def test_rows_that_share_or_lack_ids_teach_once(spark):
    rows = [(None, f"the house number {i}", "en") for i in range(400)] + [(5, f"das Haus {i}", "de") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    original, langid.Network.fit = langid.Network.fit, lambda self, texts, y, **more: seen.extend(texts)
    try:
        langid.train(docs, F.lit(True))
    finally:
        langid.Network.fit = original
    assert len(seen) == 2
