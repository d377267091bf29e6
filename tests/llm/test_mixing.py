import random
from collections import defaultdict

import numpy as np

from textloom.llm import mixing


def rows_():
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(900), f"s{i % 5}" if i % 3 else "hot", 5) for i in range(240)]
    return rows + [(None, "x y", None, 1), (5, None, "b", 1), (5, None, "b", 1), (7, "", "b", 1), (9, "a\tb  c", None, 1), (9, "a\tb  c", None, 1)]


def test_targets_stop_at_three_times_and_reshare():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    got = mixing.targets([1, 10, 1000], [3, 2, 1])
    assert got[0] == 3 and got[1] == 30 and abs(sum(got) - 1011) < 1e-9
    assert mixing.targets([0, 5], [1, 1]) == [0, 5] and mixing.targets([], []) == []


def test_quota_tree_is_exact():
    got = np.array(mixing.split_quotas([1000, 0, 37, 5], 8, 1))
    assert got.sum(axis=1).tolist() == [1000, 0, 37, 5]
    assert set(got.sum(axis=0).tolist()) <= {130, 131}
    assert (got >= 0).all() and mixing.split_quotas([1000, 37], 8, 1) == mixing.split_quotas([1000, 37], 8, 1)
    rng = np.random.default_rng(0)
    big = [mixing.hypergeometric(rng, 2 * 10**9, 10**9, 3000) for _ in range(40)]
    assert abs(np.mean(big) - 2000) < 25 and np.std(big) > 5


def test_what_is_taken(spark):
    df = spark.createDataFrame(rows_(), "doc_id long, text string, source string, words int")
    drawn = mixing.draw(df, shards=8, block_words=50, buckets=16).collect()
    taken, size, by_shard, places = defaultdict(int), {}, defaultdict(int), set()
    for r in drawn:
        size[(r.source, r.k1, r.copy)] = r.size
        for x in r.draws:
            taken[(r.source, r.k1, r.copy)] += x.words
            by_shard[x.shard] += 1
            places.add((r.source, r.k1, r.copy, r.block, x.epoch))
    assert all(n <= 3 * size[k] for k, n in taken.items())
    assert len(size) == len(rows_()) and len(places) == sum(by_shard.values())
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 8
    total, goal = defaultdict(int), {}
    for k, n in taken.items():
        total[k[0]] += n
    names = sorted({r[2] for r in rows_() if r[2]}) + [None]
    sizes = [sum(len((t or "").split()) for _, t, s, _ in rows_() if s == name) for name in names]
    for name, t in zip(names, mixing.targets(sizes, [1, 2, 3, 1, 2, 3, 1, 2])):
        goal[name] = round(t)
    assert {k: total.get(k, 0) for k in goal} == goal
    again = mixing.draw(df.repartition(7), shards=8, block_words=50, buckets=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, drawn))


def test_mixed_documents(spark):
    df = spark.createDataFrame([(d, t, s, "clash", len(t or "")) for d, t, s, _ in rows_()], "doc_id long, text string, source string, shard string, n_chars long")
    out = mixing.mix_documents(df, shards=4, block_words=50)
    assert out.columns == df.columns
    words = defaultdict(int)
    texts = {(d, s): t for d, t, s, _ in rows_()}
    for r in out.collect():
        words[r.source] += len(r.text.split())
        assert r.shard == "clash" and r.n_chars == len(r.text)
        assert r.text == texts[(r.doc_id, r.source)] or len(r.text) <= len(texts[(r.doc_id, r.source)]) + 10
    drawn = mixing.draw(df, shards=4, block_words=50)
    want = defaultdict(int)
    for r in drawn.collect():
        want[r.source] += sum(x.words for x in r.draws)
    assert dict(words) == {k: v for k, v in want.items() if v}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.draw(df).count() == 0 and mixing.mix_documents(df).count() == 0


def test_shards_of_mixed_documents_hold_their_quotas(spark):
    """Long texts too: partition i has the words that were drawn for shard i, by source."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = [(i, " ".join(f"{i}.{k}" for k in range(rng.choice([30, 2000]))), f"s{i % 3}", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    want, blocks = defaultdict(int), defaultdict(int)
    for r in mixing.draw(df, shards=4, block_words=50).collect():
        for x in r.draws:
            want[(x.shard, r.source)] += x.words
            blocks[x.shard] += 1
    out = mixing.mix_documents(df, shards=4, block_words=50).withColumn("shard", F.spark_partition_id()).collect()
    got, words = defaultdict(int), defaultdict(int)
    for r in out:
        got[(r.shard, r.source)] += len(r.text.split())
        for w in r.text.split():
            words[(r.doc_id, w)] += 1
    assert got == want and max(blocks.values()) - min(blocks.values()) <= 1
    have = {(r[0], w) for r in rows for w in r[1].split()}
    assert set(words) <= have and max(words.values()) <= 4


def test_the_tree_decides_what_is_taken(spark, monkeypatch):
    """Every document gives its whole epochs and at most one more; a quota that the tree
    doesn't deal out isn't taken."""
    df = spark.createDataFrame(rows_(), "doc_id long, text string, source string, words int")
    total = lambda rows: sum(x.words for r in rows for x in r.draws)
    drawn = mixing.draw(df, shards=8, block_words=50, buckets=16).collect()
    taken, whole = defaultdict(int), {}
    for r in drawn:
        taken[(r.source, r.k1, r.copy)] += sum(x.words for x in r.draws)
        whole[(r.source, r.k1, r.copy)] = (r.size, round(r.target) // max(r.source_size, 1))
    assert all(full * n <= taken[k] <= (full + 1) * n for k, (n, full) in whole.items())
    tree = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda q, n, seed: tree([x // 2 for x in q], n, seed))
    assert total(mixing.draw(df, shards=8, block_words=50, buckets=16).collect()) < 0.7 * total(drawn)


def test_many_shards_and_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "a b " * 30_000, "x"), (2, "c", "y"), (3, "d e", None)], "doc_id long, text string, source string")
    drawn = mixing.draw(df, shards=37, block_words=100).collect()
    shards = [x.shard for r in drawn for x in r.draws]
    assert set(shards) <= set(range(37)) and len(set(shards)) > 30
    assert sum(r.words for r in drawn) == 60_003
