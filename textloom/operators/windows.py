"""Reading packed windows: global offsets, gathering by index, epoch order, rank slices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.config import DEFAULT, PipelineConfig


def shard_offsets(shards: DataFrame) -> DataFrame:
    """``shards`` (source, shard, windows) with ``first``: the global index of its first
    window. One row a shard: the manifest is small, so one ordered window is enough."""
    before = Window.orderBy("source", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("first", F.coalesce(F.sum("windows").over(before), F.lit(0)))


def global_index(windows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``windows`` with ``idx``, their place in the whole store."""
    return windows.join(F.broadcast(offsets.select("source", "shard", "first")), ["source", "shard"]).withColumn("idx", F.col("first") + F.col("win")).drop("first")


def gather(windows: DataFrame, offsets: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (pos, idx) with the windows it asks for. A range join on the manifest finds
    shard and place, an equality join fetches."""
    off = F.broadcast(offsets.select("source", "shard", "first", "windows"))
    at = wanted.join(off, (F.col("idx") >= F.col("first")) & (F.col("idx") < F.col("first") + F.col("windows"))).select("pos", "idx", "source", "shard", (F.col("idx") - F.col("first")).alias("win"))
    return at.join(windows, ["source", "shard", "win"])


def source_windows(offsets: DataFrame, sources: list[str]) -> DataFrame:
    """idx of all windows of the named sources; none for unknown names."""
    own = offsets.filter(F.col("source").isin(*sources) & (F.col("windows") > 0))
    return own.select("source", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("windows") - 1)).alias("idx"))


def source_names(offsets: DataFrame) -> DataFrame:
    """source, first: names in the order in which they are first met."""
    return offsets.groupBy("source").agg(F.min("first").alias("first"))


def order_key(idx: Column, epoch: int, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(epoch)), idx.cast("string")).cast("binary"))


def epoch_order(n_windows: int, epoch: int, spark, cfg: PipelineConfig = DEFAULT, buckets: int = 256) -> DataFrame:
    """pos, idx: a permutation keyed by (seed, epoch), cut to whole steps.

    The key's first byte deals rows to ``buckets``; ranks inside a bucket and counts of
    those before it give positions, so no task orders everything.
    """
    keyed = spark.range(n_windows).select(F.col("id").alias("idx"), order_key(F.col("id"), epoch, cfg.seed).alias("key")).withColumn("b", F.substring("key", 1, 2))
    sizes = keyed.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))  # 256 rows
    rank = F.row_number().over(Window.partitionBy("b").orderBy("key")) - 1
    whole = n_windows // cfg.windows_per_step * cfg.windows_per_step
    return keyed.withColumn("r", rank).join(F.broadcast(starts), "b").select((F.col("first") + F.col("r")).alias("pos"), "idx").filter(F.col("pos") < whole)


#: Most windows whose order one generator can draw on the driver.
COMPAT_WINDOWS = 100_000_000


def epoch_order_compat(n_windows: int, epoch: int, spark, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """pos, idx as numpy's default generator permutes them: one stream of draws, so it runs
    on the driver, for at most COMPAT_WINDOWS windows."""
    if n_windows > COMPAT_WINDOWS:
        raise ValueError("too many windows for one generator; use epoch_order")
    order = np.random.default_rng(cfg.seed + epoch).permutation(n_windows)
    idx = order[: n_windows // cfg.windows_per_step * cfg.windows_per_step]
    return spark.createDataFrame(pa.table({"pos": np.arange(len(idx)), "idx": idx}))


def rank_batches(order: DataFrame, cfg: PipelineConfig = DEFAULT, start_step: int = 0) -> DataFrame:
    """step, rank, micro, slot, idx: each step's windows dealt to ranks in runs, each rank's
    to micro-batches."""
    per_step, per_rank = cfg.windows_per_step, cfg.windows_per_step // cfg.n_gpu
    in_rank = F.col("pos") % per_step % per_rank
    rows = order.select(F.floor(F.col("pos") / per_step).alias("step"), F.floor(F.col("pos") % per_step / per_rank).alias("rank"), F.floor(in_rank / cfg.micro_batch).alias("micro"), (in_rank % cfg.micro_batch).alias("slot"), "idx")
    return rows.filter(F.col("step") >= start_step)
