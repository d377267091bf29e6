import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from textloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def texts(n, most, seed=1):
    rng = random.Random(seed)
    letters = "ab'sltre  \n\t\x85 é漢字12½Ⅷ.,!?‍👨\x1c　'll've"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize("size", [(40, 16), (200, 50), (bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS)])
def test_chunks_encode_as_the_library_does(spark, library, size):
    rows = list(enumerate(texts(150, 400))) + [(None, "x y"), (5, None), (5, None), (7, ""), (9, " " * 300), (10, "a" * 300), (10, "a" * 300), (11, "b'll" * 90)]
    df = spark.createDataFrame([(d, t, "clash", 3) for d, t in rows], "doc_id long, text string, ids string, h int")
    out = bpe.encode_documents(df, bpe.read_ranks(PATH), public_tokenizers.PATTERN, True, *size).collect()
    want = Counter()
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        want[(d, len(ids), sha(" ".join(map(str, ids))), sha(t or ""))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert all(sha(bytes(r.decoded)) == r.decoded_sha256 and sha(" ".join(map(str, r.ids))) == r.ids_sha256 for r in out)


def test_decoding_ids(spark, library):
    t = "Zwölf Boxkämpfer 漢字"
    df = spark.createDataFrame([(library.encode_ordinary(t),), (None,)], "ids array<int>")
    got = [r.decoded for r in bpe.decode_ids(df, bpe.read_ranks(PATH), public_tokenizers.PATTERN).collect()]
    assert bytes(got[0]).decode() == t and got[1] is None


def test_empty_table(spark):
    assert bpe.encode_documents(spark.createDataFrame([], "doc_id long, text string"), bpe.read_ranks(PATH), public_tokenizers.PATTERN).count() == 0
