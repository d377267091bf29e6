import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import simhash


def fp(text, n=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, distance=4):
    """Component (smallest doc_id, None ignored) of each row, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [(d, f, least[find(i)]) for i, (d, f) in enumerate(prints)]


def test_fingerprints_and_components(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(4000)}" for _ in range(400)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(range(0, 400, 9))]
    rows += [(100 + i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(12)))) for i in range(150)]
    rows += [(None, rows[0][1].upper()), (7, None), (7, None), (8, ""), (9, "one two"), (10, "ONE two"), (11, "ÄÖ b c d e"), (12, "äö b c d e")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted(components([(d, fp(t)) for d, t in rows]), key=str)


@pytest.mark.parametrize("distance", [1, 4, 7])
def test_links_of_random_bit_patterns(spark, distance):
    """Close fingerprints in numbers: every distance from 0 to 8, chains and stars."""
    rng = random.Random(4)
    values = []
    for _ in range(30):
        x = rng.getrandbits(64)
        values.append(x)
        for k in range(1, 9):
            y = x
            for b in rng.sample(range(64), k):
                y ^= 1 << b
            values.append(y)
    prints = list(dict.fromkeys(values))
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(prints)]
    links = simhash.link_fingerprints(spark.createDataFrame(signed, "doc_id long, fp long"), distance)
    from textloom.operators.components import connected_components

    comp = {r.node: r.component for r in connected_components(links).collect()}
    want = components([(s, v) for (_, s), v in zip(signed, prints)], distance)
    assert {s: comp.get(s, s) for _, s in signed} == {s: c for s, _, c in want}


def test_one_of_each_group_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = simhash.keep_one(docs.union(docs.limit(3)))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted(d for d, _, c in components([(d, fp(t)) for d, t in rows]) if d == c)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0 and simhash.keep_one(df).count() == 0


def jaccard(a, b, n=5):
    sets = []
    for t in (a, b):
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_links_are_jaccard_of_the_texts(spark):
    """Against all pairs: the table has pairs above 0.8 that are 11 and 17 bits apart, and one
    of 0.76 that is within 7."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    root = {d: d for d in rows}
    for a in rows:
        for b in rows:
            if a < b and root[a] != root[b] and jaccard(rows[a], rows[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    kept = simhash.keep_one(docs, distance=7, shingle_words=5, jaccard=0.8)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    assert got == sorted(set(root.values())) and 192 in got and not {145, 177} & set(got)
    empty = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(empty, 7, 5, 0.8).collect()) == [1, 3]


@pytest.mark.parametrize("similar", [None, 0.8])
def test_rows_with_null_or_repeated_ids_stay(spark, similar):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(300)) for _ in range(6)]
    near = [t + " end" for t in texts]
    rows = [(None, texts[0]), (None, texts[1]), (None, near[1]), (7, texts[2]), (7, texts[3]), (9, near[2]), (7, near[4]), (3, texts[4]), (None, texts[5]), (8, near[5]), (8, near[5])]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), 7, 5, jaccard=similar).collect()]
    assert len(kept) == 6
    assert {(None, texts[0]), (7, texts[2]), (7, texts[3]), (3, texts[4]), (8, near[5])} < set(kept)
    assert len({(None, texts[1]), (None, near[1])} & set(kept)) == 1


def test_similar_texts_in_small_blocks(spark, monkeypatch):
    """Families of texts that are alike but mostly under 0.8, against brute force."""
    from tests.llm.test_pipeline import brute_kept

    monkeypatch.setattr(simhash, "BLOCK_GRAMS", 256)
    monkeypatch.setattr(simhash, "COLUMNS", 64)
    rng = np.random.default_rng(8)
    rows = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(70)]
        for k in range(40):
            text = list(base)
            for i in rng.choice(70, int(rng.integers(0, 4)), replace=False):
                text[i] = f"x{rng.integers(1000)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows), "few words"), (len(rows) + 1, "few words"), (len(rows) + 2, ""), (len(rows) + 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in simhash.keep_one(df, shingle_words=5, jaccard=0.8).collect()}
    assert got == brute_kept(df.collect())


def test_a_very_long_text_and_clashing_columns(spark):
    long = " ".join(f"w{i % 9973}" for i in range(200_000))
    rows = [(1, long, 5, "a"), (2, long + " tail", 6, "b"), (3, "other words here now", 7, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long, component_id string")
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got[1][1] == got[2][1] == 1 and got[3][1] == 3
    assert got[3][0] == fp("other words here now") and got[1][0] == simhash.fingerprint(long.encode())
    kept = simhash.keep_one(df, shingle_words=5, jaccard=0.8)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_plans_of_the_stage_go_when_their_table_is_written(spark, monkeypatch):
    """Finished plans added up in the driver: three collections for eight tables."""
    import gc

    from textloom import scratch

    tables, collected, write, collect = [], [], scratch.written, gc.collect

    def spy(df, name):
        tables.append(name)
        return write(df, name)

    monkeypatch.setattr(scratch, "written", spy)
    monkeypatch.setattr(simhash, "written", spy)
    monkeypatch.setattr(gc, "collect", lambda *a: collected.append(1) or collect(*a))
    rows = [(i, " ".join(f"w{i // 2}x{j}" for j in range(60 + i % 2))) for i in range(20)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=5, jaccard=0.8)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 20, 2))
    assert len(collected) >= len(tables) >= 8


def test_exploded_variants_are_not_broadcast(spark):
    """Spark sizes them as the fingerprints they come of, 64 times too low."""
    links = simhash.link_fingerprints(spark.range(3000).select(F.xxhash64("id").alias("fp")))
    p = links._jdf.queryExecution().executedPlan().toString()
    assert "bit_count" in p and not [x for x in p.splitlines() if "Broadcast" in x and "bit_count" in x]


def test_all_of_a_cluster_of_fingerprints_meet(spark):
    """Without bands: texts whose fingerprints are close are compared with each other, not
    only with the smallest of a bucket."""
    rng = np.random.default_rng(3)
    rows = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(60)] * 4
        for k in range(25):
            rows.append((len(rows), " ".join(base + [f"x{family}y{rng.integers(9)}z{j}" for j in range(int(rng.integers(0, 30)))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketches = simhash._sketches(docs, 5).withColumn("bands", F.array(F.col("shape"))).cache()
    got = {(r.a, r.b) for r in simhash.similar_shapes(docs, sketches, 0.8, 4, 5).collect()}
    shape = {r.doc_id: (r.shape, r.fp) for r in sketches.collect()}
    root = {s: s for s, _ in shape.values()}

    def join(a, b):
        if root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            for s in root:
                root[s] = low if root[s] == high else root[s]

    for a, b in got:
        join(a, b)
    close = [(i, j) for i, _ in rows for j, _ in rows if i < j and bin((shape[i][1] ^ shape[j][1]) % (1 << 64)).count("1") <= 4]
    alike = [(i, j) for i, j in close if jaccard(rows[i][1], rows[j][1]) >= 0.8]
    assert len(alike) > 20 and not [(i, j) for i, j in alike if root[shape[i][0]] != root[shape[j][0]]]
