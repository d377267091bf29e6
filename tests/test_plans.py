"""The shape of physical plans: what is read, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from textloom.operators import clean, decontam, dedup
from textloom.plans.queries import QUERIES
from textloom.sources.documents import table

DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_is_one_pass_and_reads_two_columns(spark):
    df = clean.clean_documents(table(spark, DIR, "documents")).select("doc_id", "reason")
    p = plan(df)
    assert "Exchange" not in p and "Python" not in p and "ArrowEval" not in p
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", p)


def test_filters_reach_the_scan(spark):
    df = clean.limit_per_source(table(spark, DIR, "documents").filter("source = 'src3'"), 5).select("doc_id")
    assert "EqualTo(source,src3)" in plan(df)


def test_funnel_combines_before_its_only_shuffle(spark):
    p = plan(QUERIES["clean_funnel"](spark, DIR))
    assert p.count("Exchange hashpartitioning") == 1 and "partial_count" in p


def test_benchmark_index_is_broadcast_when_small_and_shuffled_when_not(spark, monkeypatch):
    docs, bench = table(spark, DIR, "documents"), table(spark, DIR, "benchmark")
    assert "BroadcastHashJoin" in plan(decontam.contam_hits(docs, bench))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(decontam.contam_hits(docs, bench))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p


def test_exact_dedup_shuffles_no_text(spark):
    p = plan(dedup.exact_dedup(table(spark, DIR, "documents").select("doc_id", "source", "text")).select("doc_id"))
    shuffled = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and "partial_min" in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, name):
    p = plan(QUERIES[name](spark, DIR))
    assert "CartesianProduct" not in p and not re.search(r"BroadcastNestedLoopJoin.*Cross", p)


def test_only_manifests_and_short_series_meet_in_one_partition(spark):
    small = {"shard_offsets", "window_scan", "gather_windows", "source_windows", "source_names", "epoch_order", "rank_batches", "early_stop", "throughput", "retain_latest", "pack_index", "pack_verify", "corpus_tokens", "compression_weighted", "schedule"}
    for name in QUERIES:
        p = plan(QUERIES[name](spark, DIR))
        ordered = re.search(r"Window \[.*\n(?:.*\n){0,3}?.*Exchange SinglePartition", p)
        assert not ordered or name in small, name


def test_rollup_report_has_totals(spark):
    df = clean.report(clean.clean_documents(table(spark, DIR, "documents")))
    total = df.filter("source = 'TOTAL'").agg(F.sum("n")).first()[0]
    assert total == table(spark, DIR, "documents").count()
