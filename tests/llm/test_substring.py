import hashlib
import random

from textloom.llm import substring


def brute(rows, window=13):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1) if d is not None else ():
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab") + rng.choice(" \n\t") for _ in range(rng.randrange(80)))) for i in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(200 + i, f"own{i} words {passage} tail{i}") for i in range(40)]
    return rows + [(None, "a b " * 50), (3, "a b " * 50), (3, "a b " * 50), (4, None), (5, ""), (6, "é x\x1cy " * 30), (7, "é x\x1cy " * 30)]


def test_same_as_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, spans string")
    assert sorted((tuple(r) for r in substring.find_repeats(df).collect()), key=str) == brute(rows)


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in substring.find_repeats(docs).collect()), key=str) == brute(rows)


def test_texts_lose_just_those_words_and_keep_the_rest(spark):
    rows = fixture()
    df = spark.createDataFrame([(d, t, 1, "kept") for d, t in rows], "doc_id long, text string, n_chars long, doc string")
    out = substring.remove_repeats(df)
    assert out.columns == df.columns
    got = out.collect()
    assert all(r.doc == "kept" and (r.n_chars == len(r.text) if r.text is not None else r.n_chars is None) for r in got)
    kept = lambda t: hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest()
    assert sorted(((r.doc_id, kept(r.text)) for r in got), key=str) == sorted(((d, h) for d, _, _, h in brute(rows)), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.find_repeats(df).count() == 0 and substring.remove_repeats(df).count() == 0


def test_long_words_that_polynomials_confuse(spark):
    """Two documents that differ in one word of 1,024 bytes share no window over it."""
    odd = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, " ".join([f"w{i}" for i in range(6)] + [odd] + [f"v{i}" for i in range(6)])), (2, " ".join([f"w{i}" for i in range(6)] + [odd.translate(str.maketrans("ab", "ba"))] + [f"v{i}" for i in range(6)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in substring.find_repeats(df).collect()] == [0, 0]


def test_hot_passages_in_many_partitions_and_a_very_long_text(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{rng.randrange(9)} {passage} t{i} " * rng.randrange(1, 4)) for i in rng.sample(range(10_000), 400)]
    rows += [(20_000, " ".join(f"u{i % 5000}" for i in range(60_000))), (20_001, " ".join(f"u{i}" for i in range(4000, 4100)))]
    for parts in (1, 17):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert sorted((tuple(r) for r in substring.find_repeats(df).collect()), key=str) == brute(rows)


def test_word_hashes_tell_words_apart():
    import numpy as np

    from textloom.llm import _text

    words = [b"a", b"\x00", b"\x00\x00", b"abcdefgh", b"abcdefg", b"abcdefghi", "é".encode(), b"a" * 5000]
    raw = b" ".join(words)
    h = _text.word_hashes(raw)
    assert len(h) == len(words) == len(set(h.tolist()))
    assert np.array_equal(h, np.concatenate([_text.word_hashes(w) for w in words])) and len(_text.word_hashes(b"")) == 0


def test_impossible_windows_are_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        substring.find_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), window=400, gram=5)
