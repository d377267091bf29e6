"""Incremental ingest: clean micro-batches as they arrive, exactly once.

The checkpoint's offset log stands for progress files: a restarted query goes on behind
the last committed batch. A batch that is run again after a failure overwrites its own
folder, so nothing is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.config import DEFAULT, PipelineConfig
from textloom.functions import text as T
from textloom.operators.clean import clean_documents
from textloom.sources.documents import free_bytes


def ingest(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, cfg: PipelineConfig = DEFAULT, files_per_batch: int = 1, budgets: dict[str, int] | None = None, min_free: int = 0) -> StreamingQuery:
    """Starts a query over the Parquet files of ``source`` that stops when it has read all;
    kept rows go to ``out``/docs, tallies by source and reason to ``out``/tally.

    ``budgets``: estimated tokens by source. A source takes no more rows once the batches
    before brought it to its budget, so it stops at the end of a batch; sources without a
    budget are read whole. ``min_free``: with fewer bytes free where ``out`` is, the query
    fails before it writes the batch, and a restart goes on with it.
    """

    def batch(df: DataFrame, number: int) -> None:
        if free_bytes(spark, out.rsplit("/", 1)[0] or "/") < min_free:
            raise OSError(f"less than {min_free} bytes are free for {out}")
        if budgets:
            full = [s for s, n in taken(spark, out, number, cfg).items() if s in budgets and n >= budgets[s]]
            df = df.filter(F.col("source").isNull() | ~F.col("source").isin(*full)) if full else df
        # a file's row group is one task
        cores = spark.sparkContext.defaultParallelism
        df = df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df
        done = clean_documents(df, cfg).select("doc_id", "source", "reason", "clean").persist()
        kept = done.filter(F.col("reason") == "kept").select("doc_id", "source", F.col("clean").alias("text"))
        kept.write.mode("overwrite").parquet(f"{out}/docs/batch={number}")
        done.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("clean")).alias("chars")).write.mode("overwrite").parquet(f"{out}/tally/batch={number}")
        done.unpersist()

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def taken(spark: SparkSession, out: str, before: int, cfg: PipelineConfig = DEFAULT) -> dict[str, int]:
    """Estimated tokens that each source gave in the batches before ``before``."""
    if not before:
        return {}
    tally = spark.read.parquet(f"{out}/tally").filter(F.col("batch") < before)
    by = tally.groupBy("source").agg(T.est_tokens(F.sum("chars"), cfg.chars_per_token).alias("tokens"))
    return {r.source: r.tokens for r in by.collect()}  # a row a source


def progress(spark: SparkSession, out: str) -> DataFrame:
    """source, docs_seen, docs_kept over all committed batches."""
    tally = spark.read.parquet(f"{out}/tally")
    return tally.groupBy("source").agg(F.sum("n").alias("docs_seen"), F.coalesce(F.sum(F.when(F.col("reason") == "kept", F.col("n"))), F.lit(0)).alias("docs_kept"))
