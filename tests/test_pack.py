import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.operators import pack, schedule, tokenizer, windows
from textloom.sources import documents


def test_windows_partition_the_stream(spark):
    rows = [(i, "a" if i % 3 else "b", i % 2, list(range(7, 7 + (i * 37) % 300))) for i in range(250)]
    docs = pack.split_docs(spark.createDataFrame(rows, "doc_id long, source string, shard int, tokens array<int>"), 10)
    stream = pack.token_stream(docs)
    got = {}
    for r in pack.pack_windows(stream, 64).collect():
        got.setdefault((r.source, r.shard, r.split), {})[r.win] = r.tokens
    want = {}
    for key in {(r[1], r[2]) for r in rows}:
        own = [r for r in rows if (r[1], r[2]) == key]
        for i, r in enumerate(own):
            want.setdefault((*key, "val" if i % 10 == 9 else "train"), []).extend([*r[3], 1])
    for key, ids in want.items():
        assert got.get(key, {}) == {k: ids[64 * k : 64 * k + 64] for k in range(len(ids) // 64)}
    sizes = {(r.source, r.shard, r.split): (r.windows, r.dropped) for r in pack.stream_sizes(stream, 64).collect()}
    assert sizes == {k: (len(v) // 64, len(v) % 64) for k, v in want.items()}


def test_bins_and_shards_come_back(spark, tmp_path):
    rows = [(0, "s", 0, [5, 6, 65535] * 30), (1, "s", 0, [9] * 50)]
    stream = pack.token_stream(spark.createDataFrame(rows, "doc_id long, source string, shard long, tokens array<int>").withColumn("split", F.lit("train")))
    wins = pack.pack_windows(stream, 32)
    documents.write_bins(wins, str(tmp_path / "bin"))
    back = documents.read_bins(spark, str(tmp_path / "bin"), 32)
    key = lambda df: sorted((r.source, r.shard, r.split, r.win, r.tokens) for r in df.select("source", "shard", "split", "win", "tokens").collect())
    assert key(back) == key(wins)
    docs = spark.createDataFrame([(0, "s", 0, "one\ntwo"), (1, "s", 1, "three"), (2, "t", 0, "  ")], "doc_id long, source string, shard int, text string")
    documents.write_shards(docs, str(tmp_path / "txt"))
    assert sorted(tuple(r) for r in documents.read_shards(spark, str(tmp_path / "txt")).collect()) == [("s", 0, "one two"), ("s", 1, "three")]


def test_bpe_merges_encode_and_decode(spark):
    texts = ["low lower lowest newer wider", "low low new wide", "  spaces\n\ttabs ünï 漢字 👩‍👩‍👧 don't 10th", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    merges = tokenizer.train_merges(tokenizer.word_counts(docs), 290)
    assert merges[0] in {("l", "o"), ("w", "e"), ("Ġ", "w"), ("o", "w")} and len(tokenizer.vocabulary(merges)) == len(set(tokenizer.vocabulary(merges)))
    out = tokenizer.decode_docs(tokenizer.encode_docs(docs, merges), merges).collect()
    assert [r.decoded for r in out] == [t or "" for t in texts]
    assert len(out[0].tokens) < len(texts[0])


def test_pretokens_are_the_librarys(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["I'm  here, 12 times!\n\n  Don't\t stop ", "été漢字 x²½", "a  b   c"]
    got = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tokenizer.pretokens(F.col("t")).alias("p")).collect()]
    assert got == [[t[a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(t)] for t in texts]


def test_gathering_and_sampling(spark):
    m = windows.shard_offsets(spark.createDataFrame([("b", 0, 4), ("a", 1, 2), ("a", 0, 3)], "source string, shard long, windows long"))
    assert sorted((r.source, r.shard, r.first) for r in m.collect()) == [("a", 0, 0), ("a", 1, 3), ("b", 0, 5)]
    wins = m.select("source", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1)).alias("win"))
    got = windows.gather(wins, m, spark.createDataFrame([(0, 8), (1, 0), (2, 4), (3, 99)], "pos long, idx long"))
    assert sorted((r.pos, r.source, r.shard, r.win) for r in got.collect()) == [(0, "b", 0, 3), (1, "a", 0, 0), (2, "a", 1, 1)]
    order = windows.epoch_order(1200, 1, spark).collect()
    assert sorted(r.pos for r in order) == list(range(1024)) and len({r.idx for r in order}) == 1024
    assert [r.idx for r in sorted(order)] != [r.idx for r in sorted(windows.epoch_order(1200, 2, spark).collect())]
    dealt = windows.rank_batches(windows.epoch_order(1200, 1, spark), start_step=1).collect()
    assert len(dealt) == 512 and {(r["rank"], r.micro) for r in dealt} == {(a, b) for a in range(4) for b in range(4)}


def test_schedule_tables(spark):
    lr = {r.step: r.lr for r in schedule.lr_schedule(spark, 2000).collect()}
    assert lr[0] == 6e-4 / 500 and lr[499] == 6e-4 and abs(lr[1250] - 3.3e-4) < 1e-9 and lr[1999] < 6.1e-5
    assert schedule.param_count() == 16384 * 768 + 12 * (4 * 768**2 + 3 * 768 * 3072)
    series = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 4, 4, 4.5, 3, 3, 3, 3, 3, 3, 1])], "step long, clean double")
    rows = schedule.early_stop(series).orderBy("step").collect()
    assert [r.bad for r in rows] == [0, 0, 1, 2, 0, 1, 2, 3, 4, 5] and rows[-1].stopped and not rows[-2].stopped
    p = spark.createDataFrame([(1, [9] * 10, 1020, True), (2, [1, 2, 3], 1024, False), (3, [], 5, False)], "id long, ids array<int>, max_new int, add_eos boolean")
    got = {r.id: (r.ids, r.truncated) for r in schedule.prompt_truncate(p).collect()}
    assert got == {1: ([9] * 4, 7), 2: ([3], 3), 3: ([], 0)}


def test_merges_equal_brute_force_and_use_the_whole_sample(spark):
    from collections import Counter

    from textloom.plans import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = tokenizer.word_counts(docs.limit(40)).collect()
    letters = tokenizer.byte_alphabet()
    base = [*tokenizer.SPECIAL_TOKENS, *sorted(letters)]
    ids = {c: i for i, c in enumerate(base)}
    table = [[[ids[letters[b]] for b in r.word.encode()], r.n] for r in rows]
    want = []
    for new in range(len(base), 600):
        pairs = Counter()
        for w, n in table:
            for p in zip(w, w[1:]):
                pairs[p] += n
        best = min(pairs, key=lambda p: (-pairs[p], p))
        want.append((base[best[0]], base[best[1]]))
        base.append("".join(want[-1]))
        for word in table:
            out = []
            for x in word[0]:
                # left to right: a merged pair doesn't take part again
                out[-1:] = [new] if out and (out[-1], x) == best else [*out[-1:], x]
            word[0] = out
    assert tokenizer.train_merges(spark.createDataFrame(rows), 600) == want
    whole = queries._merges(spark, "/root/testdata/sf0.001")
    assert len(whole) > 600 and whole == tokenizer.train_merges(tokenizer.word_counts(docs))


def test_training_in_rounds_gives_the_same_merges(spark):
    from collections import Counter
    from random import Random

    draw = Random(3)
    for letters in ("a", "ab", "aéb", "abcdefgh"):
        words = Counter("".join(draw.choices(letters, k=draw.randint(1, 14))) for _ in range(300))
        bytes_of = {c: i for i, c in enumerate(tokenizer.byte_alphabet())}
        base = sorted(bytes_of)
        ids = {c: i + 7 for i, c in enumerate(base)}
        table = [[[ids[tokenizer.byte_alphabet()[b]] for b in w.encode()], n] for w, n in words.items()]
        names, want = dict(enumerate(base, 7)), []
        while len(names) + 7 < 340:
            pairs = Counter()
            for w, n in table:
                for p in zip(w, w[1:]):
                    pairs[p] += n
            best = min(pairs, key=lambda p: (-pairs[p], p), default=None)
            if best is None or pairs[best] < 2:
                break
            new = len(names) + 7
            names[new] = names[best[0]] + names[best[1]]
            want.append((names[best[0]], names[best[1]]))
            for word in table:
                out = []
                for x in word[0]:
                    out[-1:] = [new] if out and (out[-1], x) == best else [*out[-1:], x]
                word[0] = out
        counts = spark.createDataFrame(list(words.items()), "word string, n long")
        assert tokenizer.train_merges(counts, 340) == want
        assert tokenizer.train_merges(counts, 340, most_places=20) == want  # many rounds


def test_lists_are_encoded_and_decoded_as_single_words_are():
    import pyarrow as pa

    bpe = tokenizer.Bpe([("l", "o"), ("lo", "w"), ("Ã", "©")])
    lists = [["low", " lower", "low"], None, [], ["é", "\x00漢"], ["low"] * 5]
    array = pa.array([["skipped"], *lists], pa.list_(pa.string())).slice(1)
    want = [[i for w in ws or [] for i in bpe.word(w)] for ws in lists]
    assert bpe.encode_lists(array).to_pylist() == want
    back = bpe.decode_lists(pa.array([*want, None, [1, *want[0]], want[3][1:], [want[3][-1]]], pa.list_(pa.int32())))
    texts = [bpe.decode(i).decode(errors="replace") for i in [*want, [], want[0], want[3][1:], [want[3][-1]]]]
    texts[5] = None
    assert back.to_pylist() == texts and "\ufffd" in texts[-1]
    sizes = [s.tolist() for _, s in tokenizer.list_slices(array, 3)]
    assert sizes == [[3, 0, 0], [2], [5]]


def test_streams_split_and_order_keys_only(spark):
    rows = [(None if i == 7 else i // 2 * 2, "a" if i % 3 else None, i % 2, None if i == 5 else list(range(7, 7 + (i * 37) % 300))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, shard int, tokens array<int>")
    got = pack.token_stream(docs, every=10).collect()
    assert sorted((r.length, r.tokens[-1]) for r in got) == sorted((len(r[3] or []) + 1, 1) for r in rows)
    for key in {(r[1], r[2]) for r in rows}:
        own = [r for r in got if (r.source, r.shard) == key]
        assert sum(r.split == "val" for r in own) == len(own) // 10
        for split in ("train", "val"):
            part = sorted((r for r in own if r.split == split), key=lambda r: r.start)
            assert [r.start for r in part] == [sum(x.length for x in part[:i]) for i in range(len(part))]
            assert all((a.doc_id or -1) <= (b.doc_id or -1) for a, b in zip(part, part[1:]))


def test_windows_come_from_one_stream_of_written_tokens(spark):
    from textloom.plans.queries import QUERIES

    for name in ("window_scan", "gather_windows"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "documents.parquet" not in plan and "transform(filter(split" not in plan and "arrow_udf" not in plan and "ids(" not in plan
