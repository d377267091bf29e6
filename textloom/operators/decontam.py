"""Documents that share word n-grams with a benchmark, and overlap between splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import DEFAULT, PipelineConfig
from textloom.functions import text as T
from textloom.functions.batches import text_slices
from textloom.functions.hashing import ngram_hashes
from textloom.scratch import written
from textloom.sources.documents import field_texts
from textloom.sizes import estimated_bytes

#: An index up to this size is broadcast; beyond it grams are shuffled.
BROADCAST_BYTES = 64 << 20


def _grams(column: Column, n: int) -> Column:
    return F.explode(F.array_distinct(T.ngrams(T.words(F.lower(column)), n)))


def contam_index(benchmark: DataFrame, cfg: PipelineConfig = DEFAULT, columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """gram: the distinct lower-case n-grams of all benchmark fields."""
    return field_texts(benchmark, columns).select(_grams(F.col("_text"), cfg.contam_ngram).alias("gram")).distinct()


def gram_hashes(rows: DataFrame, text: Column, n: int, *keep: str) -> DataFrame:
    """``keep`` columns and ``gram``: a row for each distinct n-gram of a row, as its 64-bit
    polynomial hash. Null text and texts of fewer words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, len(keep)):
            grams = [ngram_hashes((t or "").split(), n).view(np.int64) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(grams, pa.list_(pa.int64()))], names=[*keep, "grams"])

    given = rows.select(*keep, text.alias("_text"))
    kinds = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in keep)
    return given.mapInArrow(run, f"{kinds}{', ' * bool(keep)}grams array<long>").select(*keep, F.explode("grams").alias("gram"))


def contam_hits(docs: DataFrame, benchmark: DataFrame, cfg: PipelineConfig = DEFAULT, columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """doc_id, hits: how many distinct n-grams of a document are in the index; 8 bytes an
    n-gram on both sides."""
    n = cfg.contam_ngram
    index = gram_hashes(field_texts(benchmark, columns), F.lower("_text"), n).distinct()
    # an n-gram for each word of the benchmark
    if estimated_bytes(benchmark) * n <= BROADCAST_BYTES:
        index = F.broadcast(index)
    grams = gram_hashes(docs, F.lower("text"), n, "doc_id")
    return grams.join(index, "gram", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"))


def contaminated(docs: DataFrame, benchmark: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return contam_hits(docs, benchmark, cfg).filter(F.col("hits") >= cfg.contam_min_hits)


def contam_histogram(hits: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """bucket, n for flagged documents."""
    h = F.col("hits")
    bucket = F.when(h >= 200, "200+").when(h >= 50, "50-199").when(h >= 10, "10-49").otherwise("5-9")
    return hits.filter(h >= cfg.contam_min_hits).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def leakage_audit(split_docs: DataFrame, n: int = 40) -> DataFrame:
    """source, n_grams, n_leaked, pct: share of the distinct n-grams of a source's
    validation documents that occur in its training documents. Columns: source, split,
    text. N-grams are 64-bit hashes; those of validation are few and, if they surely fit,
    sent to the training rows, which are otherwise dealt by n-gram."""
    part = lambda name: gram_hashes(split_docs.filter(F.col("split") == name), F.col("text"), n, "source")
    val = written(part("val").distinct(), "val-grams")
    few = F.broadcast(val) if estimated_bytes(val) <= BROADCAST_BYTES else val
    same = F.col("t.source").eqNullSafe(F.col("v.source")) & (F.col("t.gram") == F.col("v.gram"))
    leaked = part("train").alias("t").join(few.alias("v"), same, "left_semi").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("n_leaked")).withColumnRenamed("source", "_s")
    all_ = val.groupBy("source").agg(F.count(F.lit(1)).alias("n_grams"))
    out = all_.join(leaked, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "n_grams", F.coalesce("n_leaked", F.lit(0)).alias("n_leaked"))
    return out.withColumn("pct", F.round(100.0 * F.col("n_leaked") / F.col("n_grams"), 2))
