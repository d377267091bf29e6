from collections import Counter

import __spark_entry__
import corpus_pipeline
from textloom.llm import bpe, mixing, simhash, substring, toxicity
from textloom.scratch import written

DIR = "/root/testdata/sf0.001"


def test_stages_and_names():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["toxicity_stage", "simhash_stage", "substring_stage", "mixing_stage", "bpe_stage"]
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def brute_kept(rows, words=5, jaccard=0.8):
    """The smallest doc_id of each group of texts that are linked by their shingles."""
    sets = [{tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} for w in ((r.text or "").encode().lower().split() for r in rows)]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= jaccard * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        least[top(i)] = min(least.get(top(i), r.doc_id), r.doc_id)
    return set(least.values())


def test_each_stage_does_its_operators_work(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    cols, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, DIR), name)
        seen[name] = docs
        if name != "byte_level_bpe":
            assert docs.columns == cols
    start = {r.doc_id for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    clean = {r.doc_id for r in seen["toxicity"].collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{DIR}/labels.parquet").filter("toxic = 1").collect()}
    fine = {r.doc_id for r in spark.read.parquet(f"{DIR}/labels.parquet").filter("toxic = 0").collect()}
    assert clean < start and len(fine - clean) <= 2 and len(bad - clean) >= len(bad) * 2 / 3
    kept = {r.doc_id for r in seen["simhash_near_dedup"].collect()}
    assert kept == brute_kept(seen["toxicity"].collect())
    cut = Counter((r.doc_id, r.n_words - r.n_removed) for r in substring.find_repeats(seen["simhash_near_dedup"]).collect())
    assert Counter((r.doc_id, len(r.text.encode().split())) for r in seen["substring_dedup"].collect()) == cut
    words = Counter()
    for r in seen["mixing"].collect():
        words[r.source] += len(r.text.encode().split())
    want = Counter()
    for r in mixing.draw(seen["substring_dedup"]).collect():
        want[r.source] += sum(x.words for x in r.draws)
    assert words == want
    assert seen["byte_level_bpe"].count() == seen["mixing"].count()
    assert bpe and toxicity


def test_last_stage_returns_the_encoded_corpus(spark):
    import hashlib

    rows = [(1, "Ünï one  two\n"), (None, ""), (2, "word 12 " * 9000), (2, "word 12 " * 9000), (3, None)]
    out = corpus_pipeline.bpe_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), DIR).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in out) == sorted((str(d), t or "") for d, t in rows)
    import public_tokenizers

    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    for r in out:
        assert codec.decode(r.ids) == r.decoded and len(r.ids) == r.n_tokens
        assert hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256
