from textloom.operators.clean import clean_documents
from textloom.streaming.ingest import ingest, progress

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_restart_goes_on_behind_the_last_batch(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first, rest = docs.filter("doc_id < 90"), docs.filter("doc_id >= 90")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    first.coalesce(2).write.parquet(source)
    ingest(spark, source, SCHEMA, out, state).awaitTermination()
    half = spark.read.parquet(f"{out}/docs").count()
    rest.coalesce(1).write.mode("append").parquet(source)
    ingest(spark, source, SCHEMA, out, state).awaitTermination()
    got = {r.doc_id: r.text for r in spark.read.parquet(f"{out}/docs").collect()}
    want = {r.doc_id: r.clean for r in clean_documents(docs).filter("reason = 'kept'").collect()}
    assert got == want and 0 < half < len(want) and spark.read.parquet(f"{out}/docs").count() == len(want)
    tally = progress(spark, out).agg({"docs_seen": "sum", "docs_kept": "sum"}).first()
    assert sorted(tally) == sorted([docs.count(), len(want)])


def test_rates_are_told(spark, tmp_path):
    from textloom.streaming.rates import RateListener

    told = []
    listener = RateListener(lambda seen, rate, left: told.append((seen, left)), total=200)
    spark.streams.addListener(listener)
    try:
        source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1).write.parquet(source)
        ingest(spark, source, SCHEMA, out, state).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert told and told[-1][0] == 200


def test_the_query_reads_a_folder_as_it_reads_a_file(spark, tmp_path):
    from textloom.plans.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    one, many = (sorted(map(tuple, QUERIES["stream_ingest"](spark, d).collect())) for d in ("/root/testdata/sf0.001", str(tmp_path)))
    assert one == many and one
