import math
import zlib
from collections import Counter

import numpy as np

from textloom.llm import katz


def brute(rows, cut=katz.CUT):
    """doc_id -> (tokens, known, N, base, score), with dictionaries."""
    docs = [(d, [w.decode() for w in (t or "").encode().lower().split()]) for d, t in rows]
    train = [w for d, w in docs if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    uni, tables = Counter(), {2: {}, 3: {}}
    for w in train:
        line = ["<s>", "<s>", *w, "</s>"]
        uni.update(line[2:])
        for n in (2, 3):
            for i in range(2, len(line)):
                tables[n].setdefault(tuple(line[i - n + 1 : i]), Counter())[line[i]] += 1
    N, V = sum(uni.values()), len(uni)
    cc = lambda counts: np.array([sum(v == r for v in counts) for r in range(1, cut + 2)])
    d = {n: katz.discounts(cc([c for row in t.values() for c in row.values()])) for n, t in tables.items()}
    du = katz.discounts(cc(uni.values()))
    if cc(uni.values())[:cut].sum() == 0:
        pu, unk = {w: c / (N + 1) for w, c in uni.items()}, 1 / (N + 1)
    else:
        pu = {w: c * (du[c - 1] if c <= cut else 1) / N for w, c in uni.items()}
        unk = 1 - sum(pu.values())

    def prob(context, b):
        if not context:
            return pu.get(b, unk)
        n = len(context) + 1
        row = tables[n].get(context)
        if row is None:
            return prob(context[1:], b)
        plus = 0 if any(c <= cut for c in row.values()) else 1
        total = sum(row.values()) + plus
        if b in row:
            return row[b] * (d[n][row[b] - 1] if row[b] <= cut else 1) / total
        if context not in alpha:
            rest = sum((1 - d[n][c - 1]) * c for c in row.values() if c <= cut) + plus
            alpha[context] = rest / total / (1 - sum(prob(context[1:], x) for x in row))
        return alpha[context] * prob(context[1:], b)

    alpha = {}
    for a in [*list(tables[2])[:20], *list(tables[3])[:30], ("never", "seen")]:
        assert abs(sum(prob(a, b) for b in [*uni, "<unk>"]) - 1) < 1e-9
    out = []
    for doc, w in docs:
        t = ["<s>", "<s>", *w, "</s>"]
        out.append((doc, len(t) - 2, sum(uni[x] > 0 for x in t[2:]), N, sum(math.log10((uni[x] + 1) / (N + V + 1)) for x in t[2:]), sum(math.log10(prob((t[i - 2], t[i - 1]), t[i])) for i in range(2, len(t)))))
    return out


def compare(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in katz.score_documents(df).drop("held_out").collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1], r[2], round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:4] == w[:4]
        assert np.allclose(g[4:], w[4:], atol=1e-6), (g, w)


def test_scores_match_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[int(min(59, rng.exponential(8)))] for _ in range(rng.integers(0, 60)))) for i in range(250)]
    rows += [(None, "W1 w2"), (5, None), (5, None), (7, ""), (8, "new words only"), (8, "new words only"), (12, "w1 \x0b w1 é\xa0é")]
    compare(spark, rows)


def test_tables_in_which_good_turing_has_nothing(spark):
    compare(spark, [(i, "a b a b") for i in range(30)])
    compare(spark, [(1, "a"), (2, "b c")])


def test_empty_table(spark):
    assert katz.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_words_in_pieces_clashing_columns_and_a_long_text(spark, monkeypatch):
    """Words that most tokens follow, over more buckets than there is text for."""
    monkeypatch.setattr(katz, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(katz, "FREQUENT", 12)
    rng = np.random.default_rng(7)
    words = ["the", "the", "a", *(f"w{i}" for i in range(40))]
    rows = [(i, " ".join(w for _ in range(rng.integers(1, 30)) for w in (["the"] if rng.random() < 0.4 else []) + [words[int(rng.integers(43))]])) for i in range(150)]
    rows += [(1000 + i, "the unseen the never the") for i in range(20)] + [(5000, "the w1 " * 4_000)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, k string, score int").repartition(5)
    got = {r.doc_id: r for r in katz.score_documents(df).collect()}
    lay = katz.layout_of(katz._prepared(df, None)[1], katz.pieces(df, 1500), 1)
    assert len(lay.hot) >= 3 and katz.BEGIN in lay.hot and lay.pieces.max() > 10
    want = brute(rows)
    assert len(got) == len(want)
    for doc, n, known, total, base, score in want:
        r = got[doc]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base) and abs(r.score - score) < 1e-6 * max(1, -score)


def test_packed_hashes_come_back():
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert np.array_equal(katz.unsteps(katz.steps(h)), h) and len(katz.unsteps(katz.steps(h[:0]))) == 0
    parts = katz.part_of(h, 7)
    assert (np.diff(parts.astype(int)) >= 0).all() and set(parts.tolist()) == set(range(7))


def test_stored_tables_score_texts_alike_and_sum_to_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(katz, "FREQUENT", 12)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join("the" if rng.random() < 0.3 else f"w{min(29, int(rng.exponential(6)))}" for _ in range(rng.integers(0, 40)))) for i in range(120)]
    rows += [(500, "new the words the"), (500, "new the words the"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = str(tmp_path / "model")
    katz.write_tables(df, folder)
    want = sorted((str(r.doc_id), round(r.score, 6)) for r in katz.score_documents(df).collect())
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in katz.score_texts(df, folder).collect()) == want
    model = spark.read.parquet(folder).collect()
    p1 = {r.w: r.p for r in model if r["order"] == 1}
    assert abs(sum(p1.values()) - 1) < 1e-9
    p2 = {}
    for r in model:
        if r["order"] == 2 and r.w is not None:
            assert (r.v, r.w) not in p2
            p2[(r.v, r.w)] = r.p
    weights = {r.v: r.p for r in model if r["order"] == 2 and r.w is None}
    for v, a in weights.items():
        own = {w for x, w in p2 if x == v}
        assert abs(sum(p2[(v, w)] for w in own) + a * sum(p for w, p in p1.items() if w not in own) - 1) < 1e-9


def test_blobs_reach_the_workers_a_few_mb_at_a_time(spark, monkeypatch):
    """A bucket's blobs were sent as one batch of up to 64 MB, which stood in an executor several times."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before, write = spark.conf.get(key), katz.written

    def spy(df, name):
        seen[name] = int(spark.conf.get(key).rstrip("b"))
        return write(df, name)

    monkeypatch.setattr(katz, "written", spy)
    compare(spark, [(i, f"a b w{i % 7}") for i in range(30)])
    assert set(seen) == {"words", "evaluated"} and max(seen.values()) <= 4 << 20
    assert spark.conf.get(key) == before
