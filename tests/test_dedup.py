import numpy as np
from pyspark.sql import functions as F

from textloom.config import DEFAULT
from textloom.functions import text as T
from textloom.operators import decontam, dedup


def docs_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, source, t) for i, t in enumerate(texts)], "doc_id long, source string, text string")


def test_polynomial_hashes_match_numpy(spark):
    import zlib

    words = "the quick brown fox jumps over the lazy dog again".split()
    w = np.array([zlib.crc32(x.encode()) for x in words], dtype=object)
    want = sorted({int(sum(int(w[i + j]) * dedup.MULTIPLIER ** (4 - j) for j in range(5)) % 2**32) for i in range(len(w) - 4)})
    got = docs_of(spark, [" ".join(words), "too few"]).orderBy("doc_id").select(dedup.polynomial_hashes(T.words(F.col("text")), 5).alias("h")).collect()
    assert got[0].h == want and got[1].h == []


def test_compat_constants_and_zero_signature(spark):
    rng = np.random.default_rng(1337)
    a = rng.integers(1, (1 << 61) - 1, 64, dtype=np.uint64)
    assert [int(x) for x in a[:2]] == [2024765128292662543, 427798353355711302]
    sig = {r.doc_id: r.sig for r in dedup.minhash_compat(docs_of(spark, ["a b c", "a b c d e f g"])).collect()}
    assert sig[0] == [0] * 64 and sig[1] == dedup.compat_signature("a b c d e f g".split()).tolist()


def test_near_duplicates_and_order_of_causes(spark):
    base = [f"word{i}" for i in range(200)]
    bench = " ".join(f"q{i}" for i in range(20))
    texts = [" ".join(base), " ".join(base).upper(), " ".join([*base[:-1], "changed"]), bench, "short"]
    docs = docs_of(spark, texts)
    items = spark.createDataFrame([(1, bench)], "item_id long, text string")
    got = {r.doc_id: r.dedup_reason for r in dedup.mark_duplicates(docs, items, DEFAULT.__class__(minhash_sources=None), "global").collect()}
    assert got == {0: "kept", 1: "exact", 2: "near", 3: "contaminated", 4: "kept"}
    kept = docs.filter("doc_id in (0, 4)")
    again = dedup.mark_duplicates(kept, items, DEFAULT.__class__(minhash_sources=None), "global")
    assert {r.dedup_reason for r in again.collect()} == {"kept"}


def test_scope(spark):
    df = docs_of(spark, ["same text"]).union(docs_of(spark, ["x", "same  TEXT"], "t").filter("doc_id = 1"))
    assert dedup.exact_dedup(df, "source").count() == 2 and dedup.exact_dedup(df, "global").count() == 1


def test_benchmark_fields_and_thresholds(spark):
    w = [f"g{i}" for i in range(40)]
    bench = spark.createDataFrame([(" ".join(w[:13]), w[5:25], [w[20:30], w[30:40]])], "a string, b array<string>, c array<array<string>>")
    assert decontam.contam_index(bench, columns=("a", "b", "c")).count() == len({tuple(x[i : i + 13]) for x in (w[:13], w[5:25], w[20:40]) for i in range(len(x) - 12)})
    one = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    docs = docs_of(spark, [" ".join(w[:16]), " ".join(w[:17]), " ".join(w[:12]), None])
    assert {r.doc_id: r.hits for r in decontam.contam_hits(docs, one).collect()} == {0: 4, 1: 5}
    assert [r.doc_id for r in decontam.contaminated(docs, one).collect()] == [1]


def test_batches_are_cut_by_their_texts():
    import pyarrow as pa

    from textloom.functions.batches import text_slices

    texts = ["a" * 10, None, "", "b" * 25, "é" * 3, "c" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    got = list(text_slices(iter([batch.slice(0, 0), batch, batch.slice(4)]), 1, 16))
    assert [b.column(0).to_pylist() for b in got] == [[0, 1, 2], [3], [4, 5], [4, 5]]
    assert [x for b in got[:3] for x in b.column(1).to_pylist()] == texts


def test_signatures_and_gram_hashes_are_plain_arithmetic():
    import hashlib
    import zlib

    from textloom.functions.hashing import MULTIPLIER, ngram_hashes

    words = [f"w{i * i % 97}" for i in range(1300)] + ["é", "漢字"]
    shingles = {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}
    h = [int.from_bytes(hashlib.md5(x.encode()).digest()[:4], "big") & 0x7FFFFFFF for x in shingles]
    want = [min((a * x + b) % dedup.PRIME for x in h) for a, b in dedup.permutations(64, 1337)]
    assert dedup.portable_signature(words).tolist() == want
    assert dedup.permutations(64, 1337) is dedup.permutations(64, 1337)
    crc = [zlib.crc32(w.encode()) for w in words]
    for k in (5, 40):
        grams = {sum(c * MULTIPLIER ** (k - 1 - j) for j, c in enumerate(crc[i : i + k])) % 2**64 for i in range(len(crc) - k + 1)}
        assert ngram_hashes(words, k).tolist() == sorted(grams)
