"""The tabular parts of training and serving: schedules, evaluation, retention, checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators.rows import running
from textloom.scratch import written
from textloom.config import DEFAULT, EOS_ID, PipelineConfig


def param_count(cfg: PipelineConfig = DEFAULT) -> int:
    block = 4 * cfg.d_model**2 + 3 * cfg.d_model * cfg.d_ffn
    return cfg.vocab_size * cfg.d_model + cfg.n_layer * block


def schedule(tokens: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """tokens, steps_per_epoch, max_steps, params, tokens_per_param (over all epochs)."""
    steps = F.floor(F.col("tokens") / cfg.tokens_per_step)
    return tokens.select("tokens", steps.alias("steps_per_epoch"), (steps * cfg.epochs).alias("max_steps"), F.lit(param_count(cfg)).cast("long").alias("params"), F.round(F.col("tokens") * cfg.epochs / param_count(cfg), 4).alias("tokens_per_param"))


def lr_at(step: Column, max_steps: int, cfg: PipelineConfig = DEFAULT) -> Column:
    """Linear warm-up, then a cosine down to the least rate, which stays."""
    done = F.least(F.lit(1.0), (step - cfg.warmup_steps) / max(1, max_steps - cfg.warmup_steps))
    cosine = F.lit(0.5) * (F.cos(done * math.pi) + 1)
    return F.when(step < cfg.warmup_steps, F.lit(cfg.lr_peak) * (step + 1) / cfg.warmup_steps).otherwise(F.lit(cfg.lr_min) + cosine * (cfg.lr_peak - cfg.lr_min))


def lr_schedule(spark: SparkSession, max_steps: int, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    steps = spark.range(max_steps).select(F.col("id").alias("step"))
    return steps.select("step", F.round(lr_at(F.col("step"), max_steps, cfg), 12).alias("lr"))


def eval_loss(losses: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """source, loss: mean over batches of the mean over windows, for the seeded sample of
    eval_batches * micro_batch windows a source. Columns: source, idx, loss."""
    key = F.md5(F.concat_ws("|", F.lit(str(cfg.seed)), F.col("idx").cast("string")).cast("binary"))
    ranked = losses.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy(key)) - 1).filter(F.col("r") < cfg.eval_batches * cfg.micro_batch)
    batches = ranked.groupBy("source", F.floor(F.col("r") / cfg.micro_batch).alias("batch")).agg(F.avg("loss").alias("loss"))
    return batches.groupBy("source").agg(F.round(F.avg("loss"), 6).alias("loss"))


def clean_val(per_source: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """step, clean: mean over the sources that count for early stopping."""
    return per_source.filter(F.col("source").isin(*cfg.early_stop_sources)).groupBy("step").agg(F.avg("loss").alias("clean"))


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(F.lit(20.0), loss))


def early_stop(series: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """step, clean, best, bad, stopped. ``series``: step, clean (a row an evaluation).

    A row improves if it is below all before it; ``bad`` counts rows since the last that
    did, and nothing after the first row with ``patience`` of them is seen.
    """
    w = Window.orderBy("step")  # one short run's evaluations
    before = F.min("clean").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = series.withColumn("better", before.isNull() | (F.col("clean") < before))
    rows = rows.withColumn("island", F.sum(F.col("better").cast("int")).over(w))
    bad = F.row_number().over(Window.partitionBy("island").orderBy("step")) - 1
    rows = rows.withColumn("bad", bad).withColumn("best", F.min("clean").over(w))
    ended = F.max((F.col("bad") >= cfg.patience).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("ended", F.coalesce(ended, F.lit(0))).filter("ended = 0").select("step", "clean", "best", "bad", (F.col("bad") >= cfg.patience).alias("stopped"))


def retain_latest(checkpoints: DataFrame, keep: int = DEFAULT.keep_checkpoints, by: str = "step") -> DataFrame:
    return checkpoints.orderBy(F.desc(by)).limit(keep)


def throughput(logs: DataFrame, max_steps: int, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """step, s_per_step, tokens_per_s, eta_s. ``logs``: step, seconds (since the start). Lines
    are numbered in ranges and each meets the one before it by its number."""
    lines = written(running(logs.select("step", "seconds", F.lit(0).alias("_none")), [], ["step", "seconds"], "_none"), "log-lines")
    past = lines.select((F.col("_n") + 1).alias("_n"), F.col("step").alias("step0"), F.col("seconds").alias("seconds0"))
    rows = lines.join(past, "_n").withColumn("per", (F.col("seconds") - F.col("seconds0")) / (F.col("step") - F.col("step0")))
    return rows.select("step", F.round("per", 6).alias("s_per_step"), F.round(cfg.tokens_per_step / F.col("per"), 2).alias("tokens_per_s"), F.round((max_steps - F.col("step")) * F.col("per"), 2).alias("eta_s"))


def downsample(series: DataFrame, every: int, value: str = "loss", at: str = "line") -> DataFrame:
    """point, value: means of runs of ``every`` lines."""
    return series.groupBy(F.floor(F.col(at) / every).alias("point")).agg(F.round(F.avg(value), 6).alias(value))


def prompt_truncate(prompts: DataFrame, seq_len: int = DEFAULT.seq_len) -> DataFrame:
    """id, ids (the last that leave room for ``max_new``), truncated. Columns: id, ids,
    max_new, add_eos (an end id is put in front first)."""
    full = F.when(F.col("add_eos"), F.concat(F.array(F.lit(EOS_ID)), F.col("ids"))).otherwise(F.col("ids"))
    budget = (F.lit(seq_len) - F.col("max_new")).cast("int")
    room = F.greatest(F.lit(1), budget)  # without a budget the last id stays
    cut = F.when(F.size("full") > room, F.slice("full", -room, room)).otherwise(F.col("full"))
    return prompts.withColumn("full", full).select("id", cut.alias("ids"), F.greatest(F.lit(0), F.size("full") - budget).alias("truncated"))


def nonascii_tokens(vocab: DataFrame) -> DataFrame:
    """id, token of those that decode to anything beyond ASCII."""
    return vocab.filter(F.col("token").rlike(r"[^\x00-\x7f]")).select("id", "token")


#: Bounds of a generation request: field, condition.
REQUEST_BOUNDS = ("length(prompt) >= 1", "max_new between 1 and {most}", "min_new >= 0", "temperature > 0 and temperature <= 2", "top_p > 0 and top_p <= 1", "top_k >= 0", "repetition_penalty between 1 and 2")


def request_valid(requests: DataFrame, seq_len: int = DEFAULT.seq_len) -> DataFrame:
    """``requests`` with ``valid``: the prompt isn't empty and all numbers are in bounds."""
    ok = F.lit(True)
    for bound in REQUEST_BOUNDS:
        ok = ok & F.expr(bound.format(most=seq_len - 1))
    return requests.withColumn("valid", F.coalesce(ok, F.lit(False)))


def smoke_report(docs: DataFrame, n: int, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """source, n_seen, n_kept, ok, before, after: cleaning the first n rows of each source,
    with the start of its first kept text before and after."""
    from textloom.operators.clean import clean_documents, limit_per_source

    c = clean_documents(limit_per_source(docs, n), cfg)
    first = F.min_by(F.struct(F.substring("text", 1, 80).alias("b"), F.substring("clean", 1, 80).alias("a")), F.when(F.col("reason") == "kept", F.col("doc_id")))
    return c.groupBy("source").agg(F.count(F.lit(1)).alias("n_seen"), F.count_if(F.col("reason") == "kept").alias("n_kept"), first.alias("s")).select("source", "n_seen", "n_kept", (F.col("n_kept") > 0).alias("ok"), F.col("s.b").alias("before"), F.col("s.a").alias("after"))
