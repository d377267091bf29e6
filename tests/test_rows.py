"""Rows that share or lack ids and sources: nothing is lost or multiplied."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.config import PipelineConfig
from textloom.functions.hashing import ngram_hashes
from textloom.operators import clean, dedup, rows, tokenizer

KIND = "doc_id long, source string, text string"
#: Null sources and ids, an id in two sources, an id with two texts, equal rows, null text.
ODD = [(7, "x", "same text"), (3, "x", "same text"), (7, "y", "other text"), (None, "y", "other text"), (None, None, "lone text"), (1, None, "lone  TEXT"), (1, None, "one id"), (1, None, "two texts"), (5, "z", "twice"), (5, "z", "twice"), (6, "z", None), (8, "z", "")]


def tuples(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_dedup_keeps_scopes_and_null_ids_apart(spark):
    df = spark.createDataFrame(ODD, KIND)
    assert tuples(dedup.exact_dedup(df, "source")) == Counter([(3, "x", "same text"), (7, "y", "other text"), (1, None, "lone  TEXT"), (1, None, "one id"), (1, None, "two texts"), (5, "z", "twice"), (6, "z", None)])
    assert tuples(dedup.exact_dedup(df, "global")) == tuples(dedup.exact_dedup(df, "source"))
    assert dedup.exact_dedup(df.limit(0)).count() == 0


def test_every_row_gets_one_reason(spark):
    base = " ".join(f"w{i}" for i in range(400))
    more = [(None, "x", base), (7, "z", base.replace("w7 ", "v7 ")), (None, "q", "unlike " + " ".join(f"u{i}" for i in range(60)))]
    df = spark.createDataFrame([(*r, "clash") for r in ODD + more], KIND + ", _k9 string")
    bench = spark.createDataFrame([(1, " ".join(f"u{i}" for i in range(30)))], "item_id long, text string")
    out = dedup.mark_duplicates(df, bench, PipelineConfig(minhash_sources=None), "global")
    assert tuples(out.drop("dedup_reason")) == tuples(df)
    reasons = Counter((r.doc_id, r.source, r.text, r.dedup_reason) for r in out.collect())
    assert reasons[(7, "x", "same text", "exact")] == 1 and reasons[(5, "z", "twice", "kept")] == 1 and reasons[(5, "z", "twice", "exact")] == 1
    assert reasons[(None, None, "lone text", "exact")] == 1 and reasons[(8, "z", "", "exact")] == 1
    # of the two near copies the one with an id comes first
    assert reasons[(None, "x", base, "near")] == 1 and reasons[(7, "z", more[1][2], "kept")] == 1
    assert reasons[(None, "q", more[2][2], "contaminated")] == 1
    assert Counter(r for *_, r in reasons.elements())["kept"] == 8


def test_shards_keep_rows_and_follow_the_rule(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]), "x" * rng.randrange(30)) for _ in range(400)] + ODD
    df = spark.createDataFrame(data, KIND)
    out = clean.shard_assign(df, 100).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in out) == Counter(data)
    for source in ("a", "b", None):
        own = [(r.shard, len(r.text or "") + 1) for r in out if r.source == source]
        sums = Counter()
        for shard, n in own:
            sums[shard] += n
        # all but the last reach the target, by less than one row
        assert sorted(sums) == list(range(len(sums)))
        assert all(100 <= sums[k] < 131 for k in range(len(sums) - 1))


def test_roll_is_the_plain_loop():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes, target, total = rng.integers(1, 20, rng.integers(0, 60)), int(rng.integers(1, 60)), int(rng.integers(0, 5))
        shard, want, run = 0, [], total
        for n in sizes:
            want.append(shard)
            run += n
            if run >= target:
                shard, run = shard + 1, 0
        got, left = clean.roll(sizes, target, total)
        assert got.tolist() == want and left == run


def test_budgets_count_null_sources_and_equal_rows(spark):
    df = spark.createDataFrame(ODD, KIND)
    cfg = PipelineConfig(chunk_docs=2)
    assert tuples(clean.budget_cut(df, 10**6, cfg)) == Counter(ODD) and clean.budget_cut(df, 0, cfg).count() == 0
    assert tuples(tokenizer.sample_by_budget(df, 10**6)) == Counter(ODD)
    budgets = spark.createDataFrame([(None, 1), ("z", 9)], "source string, budget long")
    got = tokenizer.sample_by_budget(df, budgets).collect()
    assert Counter(r.source for r in got) == {None: 1, "z": 2}
    few = clean.budget_cut(df, budgets.withColumnRenamed("budget", "token_budget"), cfg)
    assert Counter(r.source for r in few.collect()) == {None: 2, "z": 4}


def test_running_totals_are_those_of_plain_loops(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", "a", None]), rng.randrange(50), i, rng.randrange(9)) for i in range(300)]
    out = rows.running(spark.createDataFrame(data, "g string, o long, i long, v long"), ["g"], ["o", "i"], "v").collect()
    for r in out:
        before = [x for x in data if x[0] == r.g and (x[1], x[2]) < (r.o, r.i)]
        assert (r["_n"], r["_sum"]) == (len(before), sum(x[3] for x in before))
    assert len(out) == 300


def test_ngram_hashes_of_64_bits():
    import zlib

    words = [f"w{i % 30}" for i in range(50)]
    want = {sum(zlib.crc32(w.encode()) * 1000003 ** (12 - j) for j, w in enumerate(words[i : i + 13])) % 2**64 for i in range(38)}
    assert ngram_hashes(words, 13).tolist() == sorted(want) and len(ngram_hashes(words[:12], 13)) == 0


def test_survivors_are_written_only_when_asked(spark, tmp_path):
    from textloom.sources import documents

    df = spark.createDataFrame([(i, "s", f"text number {i // 2}") for i in range(10)], KIND)
    cfg = PipelineConfig(minhash_sources=None, shard_target=40)
    folder = str(tmp_path / "out")
    assert dedup.dedup_corpus(df, None, None, cfg).first().n_kept == 5 and not (tmp_path / "out").exists()
    assert dedup.dedup_corpus(df, folder, None, cfg).first().n_exact == 5
    got = documents.read_shards(spark, folder)
    assert sorted(r.text for r in got.collect()) == [f"text number {i}" for i in range(5)]
    assert got.select("shard").distinct().count() == 2


def test_tokenizer_files_load_in_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    merges = tokenizer.train_merges(tokenizer.word_counts(docs), 700)
    path = str(tmp_path / "tokenizer.json")
    tokenizer.save_tokenizer(spark, merges, path)
    assert tokenizer.load_tokenizer(spark, path) == merges
    lib = Tokenizer.from_file(path)
    out = tokenizer.encode_docs(docs, merges).select("text", "tokens").collect()
    assert all(lib.encode(r.text).ids == r.tokens for r in out)
    ok = tokenizer.validate_tokenizer(merges, PipelineConfig(vocab_size=700))
    assert ok == {"vocab_size": True, "specials": True, "round_trip": True} and not tokenizer.validate_tokenizer(merges)["vocab_size"]
    sharded = docs.withColumn("shard", F.col("doc_id") % 20)
    by = {r.source: r for r in tokenizer.compression_of_ids(sharded, merges).collect()}
    for source, r in by.items():
        own = sorted({x.shard for x in sharded.collect() if x.source == source})
        step = max(1, len(own) // 8)
        texts = [x.text for x in sharded.collect() if x.source == source and x.shard in own[::step][:8]]
        assert r.chars == sum(map(len, texts)) and r.tokens == sum(len(lib.encode(t).ids) for t in texts)


def test_orders_of_numpys_generator(spark):
    from textloom.operators import windows

    cfg = PipelineConfig(micro_batch=2, grad_accum=2, n_gpu=2)
    got = [r.idx for r in windows.epoch_order_compat(101, 3, spark, cfg).orderBy("pos").collect()]
    assert got == np.random.default_rng(1337 + 3).permutation(101)[:96].tolist()
    with pytest.raises(ValueError):
        windows.epoch_order_compat(1 << 40, 0, spark, cfg)


def test_stream_stops_at_budgets_and_on_a_full_disk(spark, tmp_path):
    from textloom.streaming.ingest import ingest

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    docs.repartitionByRange(4, "doc_id").write.parquet(source)
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    failed = ingest(spark, source, kind, out, state, min_free=1 << 80)
    with pytest.raises(Exception, match="bytes are free"):
        failed.awaitTermination()
    ingest(spark, source, kind, out, state, budgets={"a": 1}).awaitTermination()
    batches = spark.read.parquet(f"{out}/docs").groupBy("source").agg(F.count_distinct("batch").alias("n"))
    assert {r.source: r.n for r in batches.collect()} == {"a": 1, "b": 4}


def test_a_benchmark_that_cannot_be_read_is_left_out(spark, tmp_path):
    from textloom.operators import decontam
    from textloom.sources import documents

    for split in ("test", "validation"):
        spark.createDataFrame([(f"{split} a b", ["c d", "e"], [["f"], ["g h"]])], "a string, b array<string>, c array<array<string>>").write.parquet(f"{tmp_path}/one/{split}")
    found, skipped = documents.benchmark_scan(spark, [(f"{tmp_path}/one", ("a", "b", "c", "none")), (f"{tmp_path}/two", ("a",))])
    assert sorted(r["_text"] for r in found.collect()) == sorted(["test a b", "validation a b"] + ["c d e", "f g h"] * 2)
    assert len(skipped) == 1 and "two" in skipped[0]
    assert decontam


def test_small_scans_of_few_files_are_dealt_to_all_cores(spark):
    from textloom.sizes import spread

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert spread(docs).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert tuples(spread(docs)) == tuples(docs)
    # neither what is large nor what is tiny
    assert spread(docs, most_each=1000) is docs and spread(docs, least=1 << 30) is docs
