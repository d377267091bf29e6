"""Exact and near-duplicate removal: keys, n-grams, MinHash, LSH buckets, clusters.

Near duplicates are the components of the graph in which each member of a bucket is
linked with the bucket's first document if their signatures agree enough. Links are
stars, so a bucket of n documents gives n - 1 candidates, never all pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

try:
    from _md5 import md5  # without the cost of finding a provider for each shingle
except ImportError:
    from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.config import DEFAULT, PipelineConfig
from textloom.functions import text as T
from textloom.functions.batches import text_slices
from textloom.functions.hashing import MULTIPLIER, ngram_hashes
from textloom.operators.components import connected_components
from textloom.operators.rows import KEYS, attach, pick, row_keys
from textloom.scratch import written

#: Portable hashes are below this prime, so a * h + b stays within a long.
PRIME = 2147483647
#: Parts in which the members of a bucket, and the links to its first document, are joined.
SALTS = 16


def scope_key(scope: str) -> Column:
    """Duplicates are sought within a source, or in all rows."""
    return F.col("source") if scope == "source" else F.lit("*")


def exact_keys(docs: DataFrame) -> DataFrame:
    return docs.withColumn("exact_key", T.exact_key(F.coalesce("text", F.lit(""))))


def _first(none_last: str = "doc_id") -> Column:
    """Orders rows by doc_id, those without one last, then by what they hold."""
    return F.struct(F.col(none_last).isNull().alias("none"), F.col(none_last).alias("doc_id"), *KEYS)


def firsts(docs: DataFrame, scope: str = "source") -> DataFrame:
    """_k1, _k2, _scope, exact_key of the first row of each exact key, by doc_id; rows of one
    doc_id (or none) go by a hash. Combined before the shuffle, so that a key of many copies
    is a few partial rows."""
    rows = exact_keys(docs).select("doc_id", *row_keys(docs), scope_key(scope).alias("_scope"), "exact_key")
    return rows.groupBy("_scope", "exact_key").agg(F.min(_first()).alias("f")).select("f._k1", "f._k2", "_scope", "exact_key")


def exact_dedup(docs: DataFrame, scope: str = "source") -> DataFrame:
    """Of rows with one exact key the first by doc_id stays; of equal rows one. Null text is
    empty text; the null source is a source."""
    return pick(docs, firsts(docs, scope))


def exact_dup_counts(docs: DataFrame, scope: str = "source") -> DataFrame:
    """exact_key, n, keep: groups of more than one."""
    keyed = exact_keys(docs).withColumn("_scope", scope_key(scope))
    return keyed.groupBy("_scope", "exact_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keep")).filter("n > 1").select("exact_key", "n", "keep")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.crc32(w.cast("binary")))


def polynomial_hashes(words: Column, k: int) -> Column:
    """32-bit polynomial hashes of all runs of k words, sorted, each once."""
    grams = T.let(
        word_hashes(words),
        lambda h: F.when(F.size(h) < k, F.array().cast("array<long>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (k - 1), F.lit(1))), lambda i: F.aggregate(F.slice(h, i, k), F.lit(0).cast("long"), lambda a, x: (a * MULTIPLIER + x).bitwiseAND(F.lit(0xFFFFFFFF))))
        ),
    )
    return F.array_sort(F.array_distinct(grams))


def shingles(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, shingle: the distinct n-word shingles of each document."""
    return docs.select("doc_id", F.explode(F.array_distinct(T.ngrams(T.words(F.col("text")), n))).alias("shingle"))


@functools.cache
def permutations(n_perm: int, seed: int = 1337) -> list[tuple[int, int]]:
    """(a, b) of each portable permutation, from a linear congruential rule."""
    out, x = [], seed
    for _ in range(n_perm):
        x = (x * 48271 + 11) % PRIME
        a = x or 1
        x = (x * 48271 + 11) % PRIME
        out.append((a, x))
    return out


def portable_signature(words: list[str], cfg: PipelineConfig = DEFAULT) -> np.ndarray | None:
    """Minima of (a h + b) mod PRIME over 31-bit hashes of the shingles; None without any."""
    k = cfg.shingle_words
    if len(words) < k:
        return None
    line, ends = " ".join(words).encode(), np.cumsum([len(w.encode()) + 1 for w in words])
    starts = [0, *ends[:-k].tolist()]
    first = b"".join(md5(line[a:z]).digest()[:4] for a, z in zip(starts, (ends[k - 1 :] - 1).tolist()))
    h = np.frombuffer(first, ">u4").astype(np.uint64) & np.uint64(0x7FFFFFFF)
    a, b = np.array(permutations(cfg.n_perm, cfg.seed), np.uint64).T[:, :, None]
    least = np.full(cfg.n_perm, PRIME, np.uint32)
    p, bits, small = np.uint64(PRIME), np.uint64(31), np.uint32(PRIME)
    x, high = np.empty((2, cfg.n_perm, 512), np.uint64)
    for i in range(0, len(h), 512):
        part = h[None, i : i + 512]
        x, high = x[:, : part.shape[1]], high[:, : part.shape[1]]
        np.multiply(a, part, out=x)
        np.add(x, b, out=x)
        # PRIME is 2**31 - 1: folded once, x is below twice PRIME and has 32 bits; less PRIME it
        # wraps to more than it was if it was below PRIME
        np.right_shift(x, bits, out=high)
        np.bitwise_and(x, p, out=x)
        np.add(x, high, out=x)
        y = x.astype(np.uint32)
        np.minimum(y, y - small, out=y)
        np.minimum(least, y.min(axis=1), out=least)
    return least.astype(np.uint64)


def _signatures(docs: DataFrame, of, empty: list[int] | None) -> DataFrame:
    """doc_id, sig; without shingles ``empty``, or no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            sigs = [of((t or "").split()) for t in batch.column(1).to_pylist()]
            sigs = [empty if s is None else s.astype(np.int64) for s in sigs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.list_(pa.int64()))], names=["doc_id", "sig"])

    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, sig array<long>")
    return signed if empty else signed.filter("sig is not null")


def minhash(docs: DataFrame, cfg: PipelineConfig = DEFAULT, zeros: bool = False) -> DataFrame:
    """doc_id, sig: portable signatures, in one pass and without a row for each shingle.
    Documents without a shingle have none or, with ``zeros``, all zeros."""
    return _signatures(docs, lambda w: portable_signature(w, cfg), [0] * cfg.n_perm if zeros else None)


def compat_permutations(cfg: PipelineConfig = DEFAULT) -> tuple[np.ndarray, np.ndarray]:
    """a and b of each permutation in wrapping arithmetic."""
    rng = np.random.default_rng(cfg.seed)
    return tuple(rng.integers(low, (1 << 61) - 1, cfg.n_perm, dtype=np.uint64) for low in (1, 0))


def compat_signature(words: list[str], cfg: PipelineConfig = DEFAULT) -> np.ndarray | None:
    """The signature in wrapping 64-bit arithmetic; None below ``shingle_words`` words."""
    k = cfg.shingle_words
    if len(words) < k:
        return None
    a, b = compat_permutations(cfg)
    h = ngram_hashes(words, k, 32)[: cfg.max_shingles]
    least = np.full(cfg.n_perm, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 256):
        with np.errstate(over="ignore"):
            m = (a[None, :] * h[i : i + 256, None] + b[None, :]) % np.uint64((1 << 61) - 1)
        least = np.minimum(least, m.min(axis=0))
    return least.astype(np.uint32)


def minhash_compat(docs: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """doc_id, sig in wrapping arithmetic; documents of too few words have all zeros."""
    return _signatures(docs, lambda w: compat_signature(w, cfg), [0] * cfg.n_perm)


def lsh_buckets(signed: DataFrame, cfg: PipelineConfig = DEFAULT, keys: tuple[str, ...] = ()) -> DataFrame:
    """band, key and the ``keys`` columns, rep (first document), n: buckets of several."""
    r = cfg.rows_per_band
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(cfg.n_bands - 1)), lambda b: F.struct(b.alias("band"), F.array_join(F.slice("sig", b * r + 1, r), ",").alias("key"))))
    rows = signed.select("doc_id", *keys, band.alias("b")).select("doc_id", *keys, "b.band", "b.key")
    return rows.groupBy(*keys, "band", "key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def lsh_pairs(signed: DataFrame, cfg: PipelineConfig = DEFAULT, keys: tuple[str, ...] = ()) -> DataFrame:
    """rep_id, doc_id, agree: candidates that agree with a bucket's first document in at
    least the given share of positions."""
    signed = written(signed, "signatures")  # read four times below
    r = cfg.rows_per_band
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(cfg.n_bands - 1)), lambda b: F.struct(b.alias("band"), F.array_join(F.slice("sig", b * r + 1, r), ",").alias("key"))))
    rows = signed.select("doc_id", *keys, band.alias("b")).select("doc_id", *keys, "b.band", "b.key")
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    # a bucket and its first document go to all parts, so that large buckets are split; Spark
    # sizes an explode as its input and would broadcast them
    buckets = lsh_buckets(signed, cfg, keys).drop("n").select("*", salts)
    star = rows.withColumn("salt", salt).join(buckets.hint("merge"), [*keys, "band", "key", "salt"]).filter("doc_id <> rep").select("rep", "doc_id").distinct()
    first = signed.join(star.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    left = first.select(F.col("doc_id").alias("rep"), F.col("sig").alias("sig_a"), salts)
    right = signed.select("doc_id", F.col("sig").alias("sig_b"))
    agree = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    both = star.join(right, "doc_id").withColumn("salt", salt).join(left.hint("merge"), ["rep", "salt"]).withColumn("agree", agree)
    return both.filter(F.col("agree") / cfg.n_perm >= cfg.jaccard).select(F.col("rep").alias("rep_id"), "doc_id", "agree")


def near_dup_clusters(pairs: DataFrame) -> DataFrame:
    """doc_id, root_id for every document in a pair; the root is the smallest."""
    return connected_components(pairs.select("rep_id", "doc_id")).select(F.col("node").alias("doc_id"), F.col("component").alias("root_id"))


def near_duplicates(docs: DataFrame, cfg: PipelineConfig = DEFAULT, scope: str = "source", mode: str = "portable") -> DataFrame:
    """doc_id, root_id of documents that aren't their cluster's first one."""
    if cfg.minhash_sources is not None:
        docs = docs.filter(F.col("source").isin(*cfg.minhash_sources))
    signed = (minhash if mode == "portable" else minhash_compat)(docs, cfg)
    keys: tuple[str, ...] = ()
    if scope == "source":
        signed, keys = signed.join(docs.select("doc_id", "source"), "doc_id"), ("source",)
    return near_dup_clusters(lsh_pairs(signed, cfg, keys)).filter("doc_id <> root_id")


#: Ids of rows whose doc_id is null or another row's are above this.
OWN_IDS = 1 << 62


def _numbered(first: DataFrame, docs: DataFrame) -> DataFrame:
    """``first`` with the row's doc_id as ``_id``; of rows that share one, all but the first
    (and those without one) get a number of their own behind all others."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_keys(docs)).distinct()
    rows = first.join(ids, list(KEYS))
    own = F.lit(OWN_IDS).bitwiseOR(F.col("_k1").bitwiseAND(F.lit(OWN_IDS - 1)))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*KEYS))
    return rows.select(*first.columns, F.when(F.col("doc_id").isNotNull() & (nth == 1), F.col("doc_id")).otherwise(own).alias("_id"))


def mark_duplicates(docs: DataFrame, benchmark: DataFrame | None = None, cfg: PipelineConfig = DEFAULT, scope: str = "source", mode: str = "portable") -> DataFrame:
    """``docs`` with ``dedup_reason``: kept, exact, near or contaminated, by the first cause
    in that order; each step sees what the one before it left.

    Every row gets a reason: rows are told apart by all their columns, so doc_ids may be
    null or shared. Null text is empty text; of equal rows one is the first. Only keys of
    survivors are written; texts are read again.
    """
    from textloom.operators.decontam import contaminated

    first = written(_numbered(firsts(docs, scope), docs), "first")
    unique = pick(docs, first, "_id").select(F.col("_id").alias("doc_id"), "source", "text")
    near = written(near_duplicates(unique, cfg, scope, mode).select("doc_id"), "near")
    reason = F.when(F.col("_near"), "near")
    marks = first.join(near.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_near")), "_id", "left")
    if benchmark is not None:
        hit = contaminated(unique.join(near, "doc_id", "left_anti"), benchmark, cfg)
        marks = marks.join(hit.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_hit")), "_id", "left")
        reason = reason.when(F.col("_hit"), "contaminated")
    return attach(docs, marks.select(*KEYS, reason.otherwise("kept").alias("dedup_reason")), "dedup_reason", "exact")


def keep_survivors(marked: DataFrame) -> DataFrame:
    return marked.filter("dedup_reason = 'kept'").drop("dedup_reason")


def dedup_corpus(docs: DataFrame, folder: str | None = None, benchmark: DataFrame | None = None, cfg: PipelineConfig = DEFAULT, scope: str = "source", mode: str = "portable") -> DataFrame:
    """The report of :func:`mark_duplicates`; with ``folder`` survivors are written there as
    shards by the roll rule, replacing what is there. Without it nothing is."""
    from textloom.operators.clean import shard_assign
    from textloom.sources.documents import write_shards

    marked = written(mark_duplicates(docs, benchmark, cfg, scope, mode), "marked")
    if folder is not None:
        write_shards(shard_assign(keep_survivors(marked), cfg.shard_target), folder)
    return report(marked)


def report(marked: DataFrame) -> DataFrame:
    """source, n_docs, n_exact, n_near, n_contam, n_kept, pct_kept."""
    count = lambda r, name: F.count_if(F.col("dedup_reason") == r).alias(name)
    by = marked.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), count("exact", "n_exact"), count("near", "n_near"), count("contaminated", "n_contam"), count("kept", "n_kept"))
    return by.withColumn("pct_kept", F.round(100.0 * F.col("n_kept") / F.col("n_docs"), 2))
