"""The cleaning chain, its reports, and the bounds on what is taken from a source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.config import DEFAULT, PipelineConfig
from textloom.functions import text as T
from textloom.operators.rows import KEYS, attach, pick, row_keys, running
from textloom.scratch import written

REASONS = ("kept", "empty", "no_lines_left", "too_short", "repetitive", "non_english", "ocr_garbage")


def kept_lines(text: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """Stripped lines that are long enough and not mostly punctuation."""
    good = lambda x: (F.length(x) >= cfg.min_line_chars) & (T.non_alnum_ratio(x) <= cfg.max_non_alnum_ratio)
    return F.filter(F.transform(T.split_lines(text), T.strip), good)


def filter_lines(text: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    return F.array_join(kept_lines(text, cfg), "\n")


def strip_boilerplate(text: Column) -> Column:
    return F.array_join(F.filter(T.split_lines(text), lambda x: ~T.is_boilerplate(x)), "\n")


def ascii_gate(text: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """The rule that stands in for a language detector."""
    return T.mostly_ascii(F.substring(text, 1, cfg.language_prefix_chars), cfg.min_ascii_ratio)


def speaks_english(text: str | None, cfg: PipelineConfig = DEFAULT) -> bool:
    """A language detector's answer for a text's beginning, if one is installed and has one;
    else that of the rule of :func:`ascii_gate`."""
    head = (text or "")[: cfg.language_prefix_chars]
    try:
        import langdetect
    except ImportError:
        return _mostly_ascii(head, cfg)
    langdetect.DetectorFactory.seed = cfg.seed
    try:
        return langdetect.detect(head) == "en"
    except langdetect.LangDetectException:
        return _mostly_ascii(head, cfg)


def _mostly_ascii(head: str, cfg: PipelineConfig) -> bool:
    return bool(head) and len(head.encode("ascii", "ignore")) / len(head) >= cfg.min_ascii_ratio


def detected_english(cfg: PipelineConfig = DEFAULT) -> Callable[[Column], Column]:
    """For ``clean_documents(is_english=...)``: :func:`speaks_english` in Arrow batches."""

    @F.pandas_udf("boolean")
    def detect(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: speaks_english(t, cfg))

    return detect


def clean_documents(docs: DataFrame, cfg: PipelineConfig = DEFAULT, column: str = "text", is_english: Callable[[Column], Column] | None = None) -> DataFrame:
    """``docs`` with ``reason`` and ``clean`` (the cleaned text of kept rows, else empty).

    Rules run cheapest first and the first that fails names the reason; later ones
    aren't evaluated for that row. Null text counts as empty.
    """
    english = is_english or (lambda t: ascii_gate(t, cfg))
    raw = F.coalesce(F.col(column), F.lit(""))
    lines = docs.withColumn("_lines", F.filter(kept_lines(raw, cfg), lambda x: ~T.is_boilerplate(x)))
    staged = lines.withColumn("_text", T.normalize_whitespace(F.array_join("_lines", "\n")))
    text = F.col("_text")
    reason = (
        F.when(F.length(T.strip(raw)) == 0, "empty")
        .when(F.size("_lines") == 0, "no_lines_left")
        .when(F.length(text) < cfg.min_doc_chars, "too_short")
        .when(T.repetitive(F.split(text, " "), cfg.ngram_n, cfg.repetition_top_k, cfg.max_repetition_ratio), "repetitive")
        .when(~english(text), "non_english")
    )
    if cfg.ocr_filter:
        reason = reason.when(T.ocr_ratio(T.single_spaced_words(F.substring(text, 1, cfg.language_prefix_chars)), cfg.min_ocr_tokens) > cfg.max_ocr_word_ratio, "ocr_garbage")
    return staged.withColumn("reason", reason.otherwise("kept")).withColumn("clean", F.when(F.col("reason") == "kept", text).otherwise("")).drop("_lines", "_text")


def funnel(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


def report(cleaned: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """source (null: all), reason, n, pct of what was seen, est_tokens of what was kept."""
    # read four times below; a row for each source and reason
    by = written(cleaned.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("clean")).alias("chars")), "reasons")
    total = by.groupBy("reason").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars")).select(F.lit("TOTAL").alias("source"), "reason", "n", "chars")
    both = by.union(total)
    sums = by.groupBy("source").agg(F.sum("n").alias("seen")).union(by.agg(F.sum("n").alias("seen")).select(F.lit("TOTAL"), "seen"))
    seen = sums.select(F.col("source").alias("s"), "seen")
    return both.join(F.broadcast(seen), both.source.eqNullSafe(seen.s)).select("source", "reason", "n", F.round(100.0 * F.col("n") / F.col("seen"), 2).alias("pct"), T.est_tokens(F.col("chars"), cfg.chars_per_token).alias("est_tokens"))


def drops(cleaned: DataFrame) -> DataFrame:
    """source, seen, kept and a map from reason to number of dropped documents."""
    by = cleaned.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))
    lost = F.filter(F.collect_list(F.struct("reason", "n")), lambda x: x["reason"] != "kept")
    return by.groupBy("source").agg(F.sum("n").alias("seen"), F.coalesce(F.sum(F.when(F.col("reason") == "kept", F.col("n"))), F.lit(0)).alias("kept"), F.map_from_entries(F.array_sort(lost)).alias("drops"))


def limit_per_source(docs: DataFrame, n: int) -> DataFrame:
    """The first n rows of each source by doc_id (a bound that the caller asks for)."""
    first = Window.partitionBy("source").orderBy("doc_id")
    return docs.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= n).drop("_rn")


def token_budgets(spark: SparkSession, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """source, token_budget of the configured sources, as budget_cut() takes them."""
    return spark.createDataFrame([(s.name, s.token_budget(cfg.token_budget_b)) for s in cfg.sources], "source string, token_budget long")


def budget_cut(docs: DataFrame, budgets: DataFrame | int, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Rows of whole chunks of ``cfg.chunk_docs``, up to the chunk in which a source's
    estimated tokens reach its budget. ``budgets``: source, token_budget, or one number.

    A last chunk that isn't full is kept if no full chunk before it reached the budget.
    The null source is a source; null text has length 0; equal rows count each; rows of one
    doc_id go by a hash. Only keys and lengths are put in order, in ranges.
    """
    keys = docs.select("source", "doc_id", *row_keys(docs), F.coalesce(F.length("text"), F.lit(0)).alias("_chars"))
    rows = running(keys, ["source"], ["doc_id", *KEYS], "_chars").withColumn("_chunk", F.floor(F.col("_n") / cfg.chunk_docs))
    before = F.min("_sum").over(Window.partitionBy("source", "_chunk"))
    rows = rows.withColumn("_before", T.est_tokens(before, cfg.chars_per_token))
    if isinstance(budgets, int):
        rows = rows.filter(F.col("_before") < budgets)
    else:
        most = budgets.select(F.col("source").alias("_s"), "token_budget")
        rows = rows.join(F.broadcast(most), F.col("source").eqNullSafe(F.col("_s"))).filter(F.col("_before") < F.col("token_budget"))  # a row a source
    return pick(docs, rows)


def roll(sizes: np.ndarray, target: int, total: int = 0) -> tuple[np.ndarray, int]:
    """Shards of consecutive rows, counted from 0, and the sum left over: a shard ends with
    the row that brings the running sum to ``target``, and the sum restarts."""
    ends, shards, first = np.cumsum(sizes), np.zeros(len(sizes), np.int64), 0
    base, target = -total, max(1, target)
    while True:
        last = int(np.searchsorted(ends, base + target))
        if last >= len(sizes):
            return shards, int(ends[-1] - base) if len(sizes) else total
        shards[last + 1 :] += 1
        base = int(ends[last])


def shard_assign(docs: DataFrame, target: int, unit: str = "chars") -> DataFrame:
    """``docs`` with ``shard``: a new one begins after the row that brings the running sum of
    (length + 1) to ``target``, and the sum restarts at 0.

    The rule is sequential in a source, so only keys and lengths are folded, in order, as a
    stream and a shard at a time; the texts stay where they are until the join. The null
    source is a source; equal rows get a shard each; rows of one doc_id go by a hash.
    """
    size = F.length("text") if unit == "chars" else F.octet_length("text")
    keys = docs.select("source", "doc_id", *row_keys(docs), (F.coalesce(size, F.lit(0)) + 1).cast("long").alias("n"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, shard, total = b"", 0, 0  # no name is bytes
        for batch in batches:
            same, sizes = pc.run_end_encode(batch.column(0)), batch.column(3).to_numpy()
            out, start = np.zeros(len(sizes), np.int64), 0
            for name, stop in zip(same.values.to_pylist(), same.run_ends.to_pylist()):
                if name != source:
                    source, shard, total = name, 0, 0
                own, total = roll(sizes[start:stop], target, total)
                out[start:stop] = own + shard
                # a sum that was just brought to the target opens the next shard
                shard = int(out[stop - 1]) + (total == 0)
                start = stop
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out.astype(np.int32))], names=[*KEYS, "shard"])

    ordered = keys.repartition("source").sortWithinPartitions("source", "doc_id", *KEYS).select("source", *KEYS, "n")
    return attach(docs, ordered.mapInArrow(fold, "_k1 long, _k2 long, shard int"), "shard")
