"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts of at most ``chunk_chars`` code points are one chunk: they are split into
pre-tokens and encoded where they are read. Longer texts are cut into chunks
that overlap by ``overlap_chars``. Chunks are pre-tokenised in parallel; in each
overlap the first pre-token boundary that both neighbours find is a boundary of
the whole text, for the pattern looks only forward. The pieces between those
boundaries are encoded in parallel and put in order again. A text in which some
overlap has no common boundary (one run longer than the overlap) is encoded as
one piece, which is exact. Decoding concatenates the raw bytes of the ids.

Defined cases: null text is empty text; an empty text has no ids; repeated rows
each give a row; null ``doc_id`` is kept; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import _text
from textloom.sizes import spread

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: A match that ends this near the end of a cut chunk might change with what follows.
GUARD = 3
#: Pre-tokens whose ids a worker remembers: the older half goes when the newer is full.
MEMORY = 150_000
#: Unicode White_Space, fixed values: what ``\s`` means to the pattern.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> bytes:
    """The rank file, read once on the driver; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def splitter(pattern: str) -> regex.Pattern:
    """``pattern`` with its white space spelled out."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(WHITE if inside else f"[{WHITE}]")
        elif two == r"\S":
            out.append(f"[^{WHITE}]")
        elif two[:1] == "\\":
            out.append(two)
        else:
            inside = (inside or two[:1] == "[") and two[:1] != "]"
            out.append(two[:1])
            i -= 1
        i += 2
    return regex.compile("".join(out))


class Codec(dict):
    """Maps a pre-token to (number of ids, decimal ids, ids' raw bytes)."""

    def __init__(self, ranks: bytes, pattern: str):
        super().__init__()
        self.older: dict = {}
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.piece = self.encoding._core_bpe.encode_single_piece
        self.raw = {i: b for b, i in table.items()}
        self.find = splitter(pattern).findall
        self.iter = splitter(pattern).finditer

    def ids(self, text: str) -> list[int]:
        return [i for p in self.find(text) for i in self.piece(p.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def __missing__(self, pre: str):
        found = self.older.get(pre)
        if found is None:
            ids = self.piece(pre.encode())
            found = (len(ids), " ".join(map(str, ids)), self.decode(ids))
        if len(self) >= MEMORY // 2:
            self.older = dict(self)
            self.clear()
        self[pre] = found
        return found

    def pieces(self, text: str, end: int | None = None) -> tuple[int, str, bytes]:
        """Number of ids, decimal ids joined by one space, decoded bytes, up to the
        boundary ``end``; what stands behind it only serves the pattern's looking ahead."""
        pre = self.find(text)
        if end is not None:
            ends = list(accumulate(map(len, pre)))
            pre = pre[: bisect_right(ends, end)]
        found = [self[p] for p in pre]
        if not found:
            return 0, "", b""
        n, ids, raw = zip(*found)
        return sum(n), " ".join(ids), b"".join(raw)

    def ends(self, text: str) -> list[int]:
        return [m.end() for m in self.iter(text)]


_codecs: dict[tuple, Codec] = {}


def _get(ranks, pattern: str) -> Codec:
    """The worker's codec for a broadcast rank file."""
    key = (id(ranks), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks.value, pattern)
    return _codecs[key]


def common_boundary(codec: Codec, text: str, step: int, begin: int = 0) -> int | None:
    """The first position from ``step`` on that is a pre-token boundary both for a
    reader of ``text`` that began at ``begin`` and for one that begins at ``step``.

    ``text`` is cut at its end, so matches within GUARD of it don't count.
    """
    last = len(text) - GUARD
    own = {e for e in codec.ends(text[begin:]) if step <= e + begin <= last}
    own = {e + begin for e in own} | ({step} if begin == step else set())
    if step in own:
        return step
    return next((e + step for e in codec.ends(text[step:]) if e + step in own and e + step <= last), None)


def _shas(n: int, ids: str, raw: bytes) -> tuple[int, str, str]:
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, keep_ids: bool = False, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """A row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, with
    ``keep_ids``, ``ids`` (array of int) and ``decoded`` (binary)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    C, V = chunk_chars, overlap_chars
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * keep_ids
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] + ([pa.list_(pa.int32()), pa.binary()] if keep_ids else [])
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if keep_ids else [])

    def result(n: int, ids: str, raw: bytes) -> tuple:
        return _shas(n, ids, raw) + ((np.array(ids.split(), np.int32), raw) if keep_ids else ())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _get(shared, pattern)
        for b in _text.slices(batches):
            rows = [result(*codec.pieces(t)) for t in b.column(1).to_pylist()]
            cols = [b.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds[1:]))] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    short = base.filter(F.length("text") <= C).mapInArrow(whole, out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, h, text in zip(*(c.to_pylist() for c in b.columns)):
                last = (len(text) - 1) // C
                for i in range(last + 1):
                    yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([h], pa.int64()), pa.array([i]), pa.array([last]), pa.array([text[i * C : (i + 1) * C + V]])], names=["doc_id", "h", "i", "last", "chunk"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _get(shared, pattern)
        for b in batches:
            rows = []
            for doc, h, i, last, chunk in zip(*(c.to_pylist() for c in b.columns)):
                # the reader of chunk i began at its start; what it finds is true from its own first common boundary on
                q = common_boundary(codec, chunk, C) if i < last else 0
                rows.append((doc, h, i + 1, last, q))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5, names=["doc_id", "h", "i", "last", "q"])

    long = base.filter(F.length("text") > C).withColumn("h", F.xxhash64("text"))
    times = long.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("times"))
    chunks = long.select("doc_id", "h", "text").mapInArrow(cut, "doc_id long, h long, i long, last long, chunk string").dropDuplicates(["doc_id", "h", "i"])
    found = chunks.mapInArrow(meet, "doc_id long, h long, i long, last long, q long")
    # One number for each chunk: where its first piece begins, as met by the chunk before it.
    plan = found.groupBy("doc_id", "h").agg(F.max(F.col("q").isNull()).alias("torn"), F.map_from_entries(F.collect_list(F.struct("i", F.coalesce("q", F.lit(0))))).alias("q"))
    same = lambda a, b: a.doc_id.eqNullSafe(b.doc_id) & (a.h == b.h)
    ready = chunks.alias("c").join(plan.alias("p"), same(chunks, plan), "inner").select(
        F.col("c.doc_id"), F.col("c.h"), "i", "torn", (F.coalesce(F.col("q")[F.col("i")], F.lit(C)) - C).alias("begin"), F.when(F.col("i") == F.col("last"), F.lit(None).cast("long")).otherwise(F.col("q")[F.col("i") + 1]).alias("end"), "chunk")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _get(shared, pattern)
        for b in batches:
            rows = []
            for doc, h, i, torn, begin, end, chunk in zip(*(c.to_pylist() for c in b.columns)):
                rows.append((doc, h, i, torn, 0, chunk[:C], b"") if torn else (doc, h, i, torn, *codec.pieces(chunk[begin:], None if end is None else end - begin)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["doc_id", "h", "i", "torn", "n", "ids", "raw"])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _get(shared, pattern)
        key, n, ids, raw, kept, text = None, 0, None, None, ([], []), []

        def done() -> pa.RecordBatch:
            if text:
                row = result(*codec.pieces("".join(text)))
            else:
                row = (n, ids.hexdigest(), raw.hexdigest()) + ((np.concatenate(kept[0]), b"".join(kept[1])) if keep_ids else ())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, *row), [pa.int64(), *kinds])], names=["doc_id", "h", *names[1:]])

        for b in batches:
            for doc, h, i, torn, m, some, bits in zip(*(c.to_pylist() for c in b.columns)):
                if (doc, h) != key:
                    if key:
                        yield done()
                    key, n, ids, raw, kept, text = (doc, h), 0, hashlib.sha256(), hashlib.sha256(), ([], []), []
                if torn:
                    text.append(some)
                    continue
                ids.update((" " if n and m else "").encode() + some.encode())
                raw.update(bits)
                n += m
                if keep_ids:
                    kept[0].append(np.array(some.split(), np.int32))
                    kept[1].append(bits)
        if key:
            yield done()

    coded = ready.mapInArrow(encode, "doc_id long, h long, i long, torn boolean, n long, ids string, raw binary")
    joined = coded.repartition("doc_id", "h").sortWithinPartitions("doc_id", "h", "i").mapInArrow(stitch, out.replace("doc_id long,", "doc_id long, h long,"))
    whole_long = joined.alias("r").join(times.alias("t"), same(joined, times)).select(F.col("r.doc_id").alias("doc_id"), *(F.col(f"r.{c}").alias(c) for c in names[1:]), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")
    return short.unionByName(whole_long)


def decode_ids(df: DataFrame, ranks: bytes, pattern: str, column: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the raw bytes of the ids in ``column``; null stays null."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def decode(s):
        codec = _get(shared, pattern)
        return s.map(lambda x: None if x is None else codec.decode([int(i) for i in x]))

    return df.withColumn("decoded", decode(column))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return encode_documents(docs, read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


QUERIES = {"op6_byte_bpe": op6_byte_bpe}
