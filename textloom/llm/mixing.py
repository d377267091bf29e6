"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of at most ``block_words`` words (shorter documents
are one block). Each source has a target in words: its weight's share of all
words, at most ``most_repeats`` times its size, the excess reshared by weight. A
source's blocks are permuted by a keyed hash; its quota is whole epochs of them and
the first part of one more. The exact block quotas are split among output shards by a
binary tree of multivariate-hypergeometric draws. Each shard takes its own range of
permuted draws from every source and orders them by another hash; what no shard's
range holds isn't taken. The last block of a quota is cut at the word, so the words
taken equal the rounded target. Shards grow in number with the input, not in size.

Only one row for each source comes to the driver (the catalogue), and one number
for each source and shard goes back. Ranks come from counts of hash buckets, so a
source that holds most rows is spread over many windows.

Defined cases: null text has size 0 and nothing of it is taken; the null source is
a source, last in order; repeated rows count each; null doc_id is kept; an empty
table gives an empty result; other columns are ignored or, in
:func:`mix_documents`, carried along.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.scratch import written
from textloom.sizes import pieces, spread

BLOCK_WORDS = 512
#: Fewest shards and rank buckets, and the bytes of input for which there is one more.
SHARDS, SHARD_BYTES = 64, 128 << 20
BUCKETS, BUCKET_BYTES = 4096, 16 << 20
MOST_REPEATS = 3
BROADCAST_NUMBERS = 1 << 20
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], most_repeats: float = MOST_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, none above most_repeats times its size."""
    left, cap = float(sum(sizes)), [most_repeats * n for n in sizes]
    out, free = [0.0] * len(sizes), list(range(len(sizes)))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > cap[i]]
        for i in over or free:
            out[i] = float(cap[i]) if over else left * weights[i] / total
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)] if over else []
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn without replacement; totals beyond numpy's 10**9 are
    drawn by inversion outward from the mode."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n and good else 0
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    first = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    u, up, down, a, b = rng.random() - first, mode, mode, first, first
    while u > 0 and (up < high or down > low):
        if up < high:
            a *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            u -= a
            if u <= 0:
                return up
        if down > low:
            b *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            u -= b
            if u <= 0:
                return down
    return mode


def split_quotas(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """Blocks of each source (rows) in each shard (columns); sums are exact and shard
    totals differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(quotas)
    room = [total * (k + 1) // shards - total * k // shards for k in range(shards)]
    out = [[0] * shards for _ in quotas]

    def split(have: list[int], lo: int, hi: int) -> None:
        if hi - lo == 1:
            for s, n in enumerate(have):
                out[s][lo] = n
            return
        mid = (lo + hi) // 2
        need, rest, left = sum(room[lo:mid]), sum(have), []
        for n in have:
            rest -= n
            k = hypergeometric(rng, n, rest, need)
            left.append(k)
            need -= k
        split(left, lo, mid)
        split([n - k for n, k in zip(have, left)], mid, hi)

    split(list(quotas), 0, shards)
    return out


def _key() -> list[Column]:
    """Two 64-bit hashes that stand for (doc_id, source, text), nulls included."""
    return [F.xxhash64(F.lit(n), "doc_id", "source", "text").alias(f"k{n}") for n in (1, 2)]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, source, k1, k2, size, copy: a row for each input row, in a small table, so
    that the texts are read once."""
    rows = docs.select("doc_id", "source", *_key(), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    same = rows.groupBy("doc_id", "source", "k1", "k2", "size").agg(F.count(F.lit(1)).alias("times"))
    return written(same, "mixing").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")


def shard_count(docs: DataFrame) -> int:
    return pieces(docs, SHARD_BYTES, SHARDS)


def _small(table: DataFrame, numbers: int) -> DataFrame:
    """A table of the catalogue's sources: broadcast up to BROADCAST_NUMBERS numbers, so that a
    hot source stays spread over tasks; beyond that joined as Spark chooses."""
    return F.broadcast(table) if numbers <= BROADCAST_NUMBERS else table


def draw(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS, shards: int | None = None, seed: int = 7, block_words: int = BLOCK_WORDS, buckets: int | None = None) -> DataFrame:
    """A row for each block of each document: doc_id, source, k1, k2, copy, size,
    source_size, target, block, words, and ``draws``, an array of (epoch, words taken,
    shard, place): where and when the mix takes it."""
    spark = docs.sparkSession
    B = block_words
    shards = shards or shard_count(docs)
    buckets = buckets or pieces(docs, BUCKET_BYTES, BUCKETS)
    keyed = _keyed(docs)
    blocks = (
        keyed.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("size") / B)).cast("int") - 1)))
        .withColumn("words", F.least(F.lit(B), F.col("size") - F.col("block") * B).cast("long"))
        .withColumn("prio", F.xxhash64(F.lit(seed), "k1", "k2", "copy", "block"))
        .withColumn("bucket", F.shiftrightunsigned("prio", 40) % buckets)
    )
    counts = blocks.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"))

    catalogue = sorted(((r.source, r.n, r.w) for r in counts.groupBy("source").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    goals = targets([w for _, _, w in catalogue], [weights[i % len(weights)] for i in range(len(catalogue))], most_repeats)
    plan = [(s, n, w, goal, *divmod(round(goal), max(w, 1))) for (s, n, w), goal in zip(catalogue, goals)]
    plan_df = _small(spark.createDataFrame(plan, "source string, n long, source_size long, target double, full long, rest long"), len(plan) * 8)

    in_bucket = Window.partitionBy("b.source", "b.bucket").orderBy("prio", "k1", "k2", "copy", "block")
    ranked = (
        blocks.alias("b")
        .join(starts.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")) & (F.col("b.bucket") == F.col("s.bucket")))
        .select("b.*", (F.col("n0") + F.row_number().over(in_bucket) - 1).alias("rank"), (F.col("w0") + F.sum("words").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("ahead"))
        .alias("r")
        .join(plan_df.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("r.*", "n", "source_size", "target", "full", F.least(F.col("words"), F.col("rest") - F.col("ahead")).alias("part"))
    )
    # Blocks of the last, partial epoch: those that begin before its words are full.
    last = {r.source: r.q for r in _partial(starts, blocks, plan_df).collect()}
    quotas = [n * full + last.get(s, 0) for s, n, _, _, full, _ in plan]
    ends = [np.cumsum(row).tolist() for row in split_quotas(quotas, shards, seed)]
    ends_df = _small(spark.createDataFrame([(p[0], e) for p, e in zip(plan, ends)], "source string, ends array<long>"), len(plan) * shards)

    steps = F.array(*(F.lit(1 << k) for k in reversed(range(shards.bit_length()))))
    at = lambda epoch: epoch * F.col("n") + F.col("rank")

    def place(epoch: Column) -> Column:
        # how many shards' ranges end at or before this draw, by halving
        shard = F.aggregate(steps, F.lit(0), lambda lo, k: F.when((lo + k <= shards) & (F.get("ends", lo + k - 1) <= at(epoch)), lo + k).otherwise(lo))
        return F.struct(epoch.cast("int").alias("epoch"), F.when(epoch < F.col("full"), F.col("words")).otherwise(F.col("part")).alias("words"), shard.alias("shard"), F.xxhash64(F.lit(seed + 1), shard, F.col("prio"), epoch).alias("place"))

    epochs = F.filter(F.sequence(F.lit(0).cast("long"), F.col("full")), lambda e: (F.col("words") > 0) & (at(e) < F.get("ends", F.lit(shards - 1))))
    return ranked.alias("x").join(ends_df.alias("e"), F.col("x.source").eqNullSafe(F.col("e.source"))).select("x.doc_id", "x.source", "k1", "k2", "copy", "size", "source_size", "target", "block", "words", F.transform(epochs, place).alias("draws"))


def _partial(starts: DataFrame, blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """source, q: blocks of the partial epoch with words in it (those without words,
    which nothing is taken of, keep their ranks and count as well)."""
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    need = plan.alias("p").join(starts.alias("s"), same("p", "s")).filter("w0 < rest").groupBy(F.col("p.source").alias("source"), "rest").agg(F.max_by(F.struct("bucket", "n0", "w0"), "bucket").alias("at"))
    edge = blocks.alias("b").join(need.alias("k"), same("b", "k") & (F.col("b.bucket") == F.col("k.at.bucket"))).select("b.*", "rest", "at")
    w = Window.partitionBy("source").orderBy("prio", "k1", "k2", "copy", "block")
    return edge.select("source", "at", "rest", F.row_number().over(w).alias("i"), (F.col("at.w0") + F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("ahead")).filter("ahead < rest").groupBy("source").agg(F.max(F.col("at.n0") + F.col("i")).alias("q"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``, a row for each document, epoch and shard:
    its text (whole when all its blocks are taken there, else those blocks, each as it
    stands, joined by a line break). Partition i is shard i, shuffled, so that files
    written from it are the shards and hold the drawn quotas."""
    B, shards = options.get("block_words", BLOCK_WORDS), options.get("shards") or shard_count(docs)
    drawn = draw(docs, **(options | {"shards": shards}))
    took = (
        drawn.filter(F.size("draws") > 0).withColumn("d", F.explode("draws"))
        .groupBy("k1", "k2", "copy", "size", "d.epoch", "d.shard")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("block"), F.col("d.words").alias("words")))).alias("parts"), F.sum("d.words").alias("taken"), F.min("d.place").alias("place"))
    )
    keep = F.when(F.col("taken") == F.col("size"), F.lit(None)).otherwise(F.col("parts"))
    take = took.groupBy("k1", "k2").agg(F.collect_list(F.struct(keep.alias("parts"), "shard", "place")).alias("takes"))
    # of rows that are equal in all that keys them one stands for all: ``takes`` has theirs
    one = docs.select(F.struct("*").alias("doc"), *_key()).withColumn("row", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))).filter("row = 1")
    # each word with the white space behind it, so that a block keeps its own; a text is cut
    # into words once, however many shards have some of it
    word = F.when(F.exists("takes", lambda t: t["parts"].isNotNull()), F.regexp_extract_all("doc.text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)")))
    piece = lambda w: lambda p: F.array_join(F.slice(w, (p["block"] * B + 1).cast("int"), p["words"].cast("int")), "")
    text = lambda w, t: F.when(t["parts"].isNull(), F.col("doc.text")).otherwise(F.array_join(F.transform(t["parts"], piece(w)), "\n"))
    rows = T.let(word, lambda w: F.transform("takes", lambda t: F.struct(text(w, t).alias("text"), t["parts"].isNull().alias("whole"), t["shard"].alias("shard"), t["place"].alias("place"))))
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != "text")).alias("rest")
    joined = one.join(take, ["k1", "k2"]).select(rest, F.explode(rows).alias("t")).select("rest", "t.*")
    out = {c: F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("whole"), F.col("rest.n_chars")).otherwise(F.length("text").cast("long"))
    return joined.repartitionById(shards, F.col("shard")).sortWithinPartitions("place").select(*(v.alias(c) for c, v in out.items()))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``taken`` sums what the shards' ranges hold of a document; first_shard is null and
    n_shards 0 if that is nothing."""
    drawn = draw(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    shards = F.size(F.array_distinct(F.flatten(F.collect_list(F.transform("draws", lambda d: d["shard"])))))
    by = drawn.groupBy("doc_id", "source", "k1", "k2", "copy", "size", "source_size", "target").agg(F.sum(taken).alias("taken"), shards.alias("n_shards"), F.min(F.array_min(F.transform("draws", lambda d: d["shard"]))).alias("first_shard"))
    return by.select("doc_id", "source", "size", "source_size", "target", "taken", "n_shards", "first_shard")


QUERIES = {"op10_mixing": op10_mixing}
