"""Splitting by document, and packing token streams into windows of fixed length.

A stream is all documents of one (source, shard, split) in order, each followed by the
end id. Windows take slices of documents, so a document becomes one row for each window
that it touches, not one for each token; shards bound what meets in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.config import DEFAULT, EOS_ID, PipelineConfig
from textloom.scratch import written

STREAM = ("source", "shard", "split")


def split_docs(docs: DataFrame, every: int = DEFAULT.val_every) -> DataFrame:
    """``docs`` with ``split``: in each shard every n-th row by doc_id is validation."""
    at = F.row_number().over(Window.partitionBy("source", "shard").orderBy("doc_id")) - 1
    return docs.withColumn("split", F.when(at % every == every - 1, "val").otherwise("train"))


def token_stream(docs: DataFrame, eos: int = EOS_ID, every: int | None = None) -> DataFrame:
    """``tokens`` ends with ``eos``; ``start`` is where a document begins in its stream, ``length``
    how many tokens it has. With ``every``, ``split`` is made here, as by :func:`split_docs`.

    Rows are written once; only their keys and lengths are put in order, and tokens are
    dealt to all tasks, however few shards there are.
    """
    ended = docs.withColumn("tokens", F.concat(F.coalesce("tokens", F.array().cast("array<int>")), F.array(F.lit(eos))))
    rows = written(ended.withColumn("length", F.size("tokens")).withColumn("_row", F.monotonically_increasing_id()), "stream")
    keys = rows.select(*STREAM[: 2 if every else 3], "doc_id", "_row", "length")
    if every:
        at = F.row_number().over(Window.partitionBy("source", "shard").orderBy("doc_id", "_row")) - 1
        keys = keys.withColumn("split", F.when(at % every == every - 1, "val").otherwise("train"))
    before = Window.partitionBy(*STREAM).orderBy("doc_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    places = keys.select("_row", *(["split"] if every else []), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("start"))
    return rows.join(places, "_row").drop("_row")


def pack_windows(stream: DataFrame, seq_len: int = DEFAULT.seq_len) -> DataFrame:
    """source, shard, split, win, tokens; an unfull last window is left out."""
    n, s = F.size("tokens"), F.col("start")
    wins = F.explode(F.sequence(F.floor(s / seq_len), F.floor((s + n - 1) / seq_len))).alias("win")
    rows = stream.select(*STREAM, "start", "tokens", wins)
    lo = F.greatest(F.col("win") * seq_len, s)
    hi = F.least((F.col("win") + 1) * seq_len, s + n)
    part = F.slice("tokens", (lo - s + 1).cast("int"), (hi - lo).cast("int"))
    pieces = rows.select(*STREAM, "win", F.struct(lo.alias("at"), part.alias("part")).alias("piece"))
    whole = pieces.groupBy(*STREAM, "win").agg(F.flatten(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["part"])).alias("tokens"))
    return whole.filter(F.size("tokens") == seq_len)


def stream_sizes(stream: DataFrame, seq_len: int = DEFAULT.seq_len) -> DataFrame:
    """source, shard, split, docs, n_tokens (in whole windows), windows, dropped."""
    by = stream.groupBy(*STREAM).agg(F.count(F.lit(1)).alias("docs"), F.sum("length").alias("n"))
    windows = F.floor(F.col("n") / seq_len)
    return by.select(*STREAM, "docs", (windows * seq_len).alias("n_tokens"), windows.alias("windows"), (F.col("n") % seq_len).alias("dropped"))


def pack_index(sizes: DataFrame, split: str, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row: split, dtype, seq_len, vocab_size, eos_id, total_windows, total_tokens and
    ``shards``, by (source, shard); those without windows are left out."""
    own = sizes.filter((F.col("split") == split) & (F.col("windows") > 0))
    name = F.format_string("%s_%05d.bin", F.col("source"), F.col("shard").cast("int"))
    shard = F.struct("source", "shard", name.alias("name"), "windows", F.col("n_tokens").alias("tokens"))
    lists = F.transform(F.array_sort(F.collect_list(shard)), lambda x: F.struct(x["name"].alias("name"), x["source"].alias("source"), x["windows"].alias("windows"), x["tokens"].alias("tokens")))
    return own.agg(F.lit(split).alias("split"), F.lit("uint16").alias("dtype"), F.lit(cfg.seq_len).alias("seq_len"), F.lit(cfg.vocab_size).alias("vocab_size"), F.lit(EOS_ID).alias("eos_id"), F.coalesce(F.sum("windows"), F.lit(0)).alias("total_windows"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total_tokens"), lists.alias("shards"))


def pack_report(sizes: DataFrame) -> DataFrame:
    """source (TOTAL: all), train_tokens, val_tokens, train_windows, val_windows, docs, val_pct,
    dropped, dropped_pct."""
    part = lambda c, s: F.coalesce(F.sum(F.when(F.col("split") == s, F.col(c))), F.lit(0))
    by = sizes.rollup("source").agg(
        F.grouping("source").alias("all"), part("n_tokens", "train").alias("train_tokens"), part("n_tokens", "val").alias("val_tokens"), part("windows", "train").alias("train_windows"), part("windows", "val").alias("val_windows"), F.sum("docs").alias("docs"), F.sum("dropped").alias("dropped")
    )
    packed = F.col("train_tokens") + F.col("val_tokens")
    return by.select(
        F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), "train_tokens", "val_tokens", "train_windows", "val_windows", "docs",
        F.round(100.0 * F.col("val_tokens") / F.nullif(packed, F.lit(0)), 4).alias("val_pct"), "dropped", F.round(100.0 * F.col("dropped") / F.nullif(packed + F.col("dropped"), F.lit(0)), 4).alias("dropped_pct"),
    )


def pack_verify(windows: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row: windows, bad_length, max_id, ids_ok, eos_per_window."""
    eos = F.size(F.filter("tokens", lambda t: t == EOS_ID))
    top = F.max(F.array_max("tokens"))
    return windows.agg(F.count(F.lit(1)).alias("windows"), F.count_if(F.size("tokens") != cfg.seq_len).alias("bad_length"), top.alias("max_id"), (top < cfg.vocab_size).alias("ids_ok"), F.round(F.sum(eos) / F.count(F.lit(1)), 6).alias("eos_per_window"))


def verify_bytes(bins: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """source, shard, split, ok: whether the stored bytes are those of the counted windows of
    16-bit ids. ``bins`` as write_bins() stores them."""
    return bins.select("source", "shard", "split", (F.octet_length("data") == F.col("windows") * cfg.seq_len * 2).alias("ok"))


def corpus_tokens(index: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """tokens: the index's total, or the budget where there is none."""
    return index.agg(F.coalesce(F.max(F.nullif("total_tokens", F.lit(0))), F.lit(int(cfg.token_budget_b * 1e9))).alias("tokens"))
