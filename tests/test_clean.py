import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.config import DEFAULT
from textloom.functions import text as T
from textloom.operators import clean

VARIED = " ".join(f"Sentence number {i} speaks about topic {w} and its many {w} consequences here." for i, w in enumerate("rivers mountains harbours forests deserts meadows glaciers volcanoes islands canyons".split()))


def spec(raw, cfg=DEFAULT):
    """The rules in plain Python."""
    if not raw or not raw.strip():
        return "empty"
    ratio = lambda x: 1.0 - len(re.findall("[a-zA-Z0-9]", x)) / len(x)
    keep = [x.strip() for x in raw.splitlines()]
    keep = [x for x in keep if len(x) >= 40 and ratio(x) <= 0.30]
    keep = [x for x in keep if not any(re.match(p, x, re.I) for p in T.BOILERPLATE)]
    if not keep:
        return "no_lines_left"
    text = " ".join("\n".join(keep).split())
    if len(text) < cfg.min_doc_chars:
        return "too_short"
    w = text.split()
    grams = Counter(tuple(w[i : i + 4]) for i in range(len(w) - 3))
    if len(w) >= 8 and sum(n for _, n in grams.most_common(10)) / sum(grams.values()) > 0.5:
        return "repetitive"
    head = text[:5000]
    if sum(c.isascii() for c in head) / len(head) < 0.9:
        return "non_english"
    tokens = head.split()
    damage = [re.compile(p.replace(r"\p{Nd}", r"\d")) for p in T.OCR_DAMAGE]
    if len(tokens) >= 20 and sum(any(p.search(t) for p in damage) for t in tokens) / len(tokens) > 0.02:
        return "ocr_garbage"
    return "kept"


def reasons(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.reason for r in clean.clean_documents(df).orderBy("doc_id").collect()]


def test_documented_cases(spark):
    texts = [VARIED, "One sentence that is repeated again and again in this document. " * 12, "x" * 59, "FORM 10-K " + "annual report pursuant to section thirteen\n" * 1, "", None, "  \x1c  "]
    assert reasons(spark, texts) == ["kept", "repetitive", "too_short", "no_lines_left", "empty", "empty", "empty"]


def test_edges(spark):
    line = "abcdefghij" * 4
    texts = [line[:39] + "\n" + VARIED, line + "\x0b" + line, "a" * 28 + "." * 12 + "\n" + VARIED, VARIED.replace(" ", "\xa0"), VARIED + " 10th aaaaa abCD bcdfghj" * 3, VARIED[:599], VARIED[:600], "é" * 200 + VARIED]
    assert reasons(spark, texts) == [spec(t) for t in texts]
    ratio = spark.createDataFrame([("a" * 7 + "...",), ("",)], "t string").select(T.non_alnum_ratio(F.col("t")).alias("r")).collect()
    assert ratio[0].r == 1 - 0.7 > 0.30 and ratio[1].r == 1.0


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from(list("abz AZ09.,-\n\r\x0b\x1c\x85\xa0 é漢")), max_size=900), min_size=1, max_size=8))
def test_same_reasons_as_plain_python(spark, texts):
    assert reasons(spark, texts) == [spec(t) for t in texts]


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r.reason for r in clean.clean_documents(docs).select("doc_id", "reason").collect()}
    assert got == {r.doc_id: spec(r.text) for r in rows}
    assert Counter(got.values()) == {"kept": 126, "too_short": 32, "no_lines_left": 18, "ocr_garbage": 16, "repetitive": 8}


def test_shards_restart_at_zero(spark):
    df = spark.createDataFrame([(i, "s", "x" * n) for i, n in enumerate([5, 3, 9, 1, 1, 1, 20])] + [(50, None, "y"), (51, None, None)], "doc_id long, source string, text string")
    got = clean.shard_assign(df.filter("source = 's'"), 10).orderBy("doc_id").collect()
    assert [r.shard for r in got] == [0, 0, 1, 2, 2, 2, 2]


def test_budget_keeps_the_crossing_chunk(spark):
    from dataclasses import replace

    df = spark.createDataFrame([(i, "s", "x" * 10) for i in range(10)], "doc_id long, source string, text string")
    cfg = replace(DEFAULT, chunk_docs=3, chars_per_token=1.0)
    assert clean.budget_cut(df, 31, cfg).count() == 6
    budgets = spark.createDataFrame([("s", 1000)], "source string, token_budget long")
    assert clean.budget_cut(df, budgets, cfg).count() == 10


def test_a_language_detector_decides_where_there_is_one(spark, monkeypatch):
    import sys
    import types

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rule = {r.doc_id: r.reason for r in clean.clean_documents(docs).select("doc_id", "reason").collect()}
    # none is installed here, so the column gives what the rule gives
    assert {r.doc_id: r.reason for r in clean.clean_documents(docs, is_english=clean.detected_english()).select("doc_id", "reason").collect()} == rule

    class Unsure(Exception):
        pass

    def detect(text):
        if "?" in text:
            raise Unsure
        return "en" if "the" in text else "de"

    fake = types.SimpleNamespace(detect=detect, LangDetectException=Unsure, DetectorFactory=types.SimpleNamespace(seed=None))
    monkeypatch.setitem(sys.modules, "langdetect", fake)
    assert [clean.speaks_english(t) for t in ("the house", "das Haus", "what ?", "é?", "", None)] == [True, False, True, False, False, False]
    assert fake.DetectorFactory.seed == DEFAULT.seed


def test_ascii_queries_divide_as_their_sql_does(spark, tmp_path):
    import duckdb

    from textloom.plans.queries import ORACLE_SQL, QUERIES

    rows = [(1, ""), (2, None), (3, "plain"), (4, "éé"), (5, "a" * 9 + "é"), (6, "a" * 89 + "é" * 11), *((7 + k, "é" * k + "a" * (5120 - k)) for k in range(60))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("ascii_ratio", "english_gate"):
        df, rel = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLE_SQL[name])
        assert df.columns == rel.columns
        # repr: a number that is none equals itself
        assert sorted((tuple(map(repr, r)) for r in df.collect())) == sorted((tuple(map(repr, r)) for r in rel.fetchall())), name


def test_shortcuts_decide_as_the_ratios_do(spark):
    texts = ["", "a", "é", "a" * 9 + "é", "a" * 90 + "é" * 11, "ab" * 45 + "🏛" * 10, "ab" * 45 + "🏛" * 12, "a b c d " * 9, " ".join(f"w{i % 30}" for i in range(70)), " ".join(f"w{i}" for i in range(40)) + " x y z v" * 9]
    t, w = F.col("t"), F.split("t", " ")
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(T.mostly_ascii(t, 0.9).alias("a"), (T.ascii_ratio(t) >= 0.9).alias("b"), T.repetitive(w, 4, 10, 0.5).alias("c"), (T.repetition_ratio(w, 4, 10) > 0.5).alias("d")).collect()
    assert [(r.a, r.c) for r in rows] == [(r.b, r.d) for r in rows] and {r.a for r in rows} == {r.c for r in rows} == {True, False}


def test_report_cleans_once(spark):
    docs = spark.createDataFrame([(1, "s", VARIED), (2, "s", ""), (3, None, "")], "doc_id long, source string, text string")
    report = clean.report(clean.clean_documents(docs))
    assert "xxhash64" not in report._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.source or "", r.reason, r.n, r.pct) for r in report.collect()) == [("", "empty", 1, 100.0), ("TOTAL", "empty", 2, 66.67), ("TOTAL", "kept", 1, 33.33), ("s", "empty", 1, 50.0), ("s", "kept", 1, 50.0)]
