"""Readers and writers of documents, benchmarks and packed windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_scan(rows: DataFrame, field: str = "text") -> DataFrame:
    """doc_id, source, text: one text field of raw rows; null and missing become empty."""
    value = F.coalesce(F.col(field).cast("string"), F.lit("")) if field in rows.columns else F.lit("")
    return rows.select("doc_id", "source", value.alias("text"))


def not_blank(docs: DataFrame) -> DataFrame:
    """Rows whose text is more than white space, as a shard reader skips blank lines."""
    return docs.filter(F.length(T.strip(F.col("text"))) > 0)


def benchmark_scan(spark: SparkSession, specs: list[tuple[str, tuple[str, ...]]], splits: tuple[str, ...] = ("test", "validation"), reader: str = "parquet") -> tuple[DataFrame, list[str]]:
    """_text of all fields of all benchmarks, and a line for each one that couldn't be read:
    it is left out. ``specs``: (folder, fields); each folder has one table a split."""
    found, skipped = spark.createDataFrame([], "_text string"), []
    for folder, fields in specs:
        try:
            rows = [spark.read.format(reader).load(f"{folder}/{split}") for split in splits]
            texts = [field_texts(r, tuple(f for f in fields if f in r.columns)) for r in rows]
        except (AnalysisException, Py4JJavaError) as e:
            skipped.append(f"{folder}: {type(e).__name__}")
            continue
        for t in texts:
            found = found.union(t)
    return found, skipped


def field_texts(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """_text: all fields of all items. A field may be a string, an array of strings or an
    array of arrays."""
    kinds = dict(rows.dtypes)
    out = rows.select(F.lit("").alias("_text")).limit(0)
    for c in columns:
        value = F.col(c)
        if kinds[c] == "array<array<string>>":
            value = F.array_join(F.flatten(value), " ")
        elif kinds[c] == "array<string>":
            value = F.array_join(value, " ")
        out = out.union(rows.select(value.cast("string").alias("_text")))
    return out


def free_bytes(spark: SparkSession, folder: str) -> int:
    """What is free in the store that holds ``folder``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getStatus(path).getRemaining()


def write_shards(docs: DataFrame, folder: str) -> None:
    """Gzip text with a document a line, in folders source=/shard=, replacing what is there.
    Line breaks inside a text become spaces, so that a line stays a document."""
    line = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\r\\n]+", " ")
    rows = docs.select("source", "shard", "doc_id", line.alias("value")).repartition("source", "shard").sortWithinPartitions("source", "shard", "doc_id").drop("doc_id")
    rows.write.mode("overwrite").option("compression", "gzip").partitionBy("source", "shard").text(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """source, shard, text of non-blank lines; file formats and gzip are Spark's."""
    return not_blank(spark.read.text(folder).select("source", "shard", F.col("value").alias("text")))


def list_shards(spark: SparkSession, folder: str) -> DataFrame:
    """source, shard, files of what :func:`write_shards` wrote."""
    files = spark.read.text(folder).select("source", "shard", F.input_file_name().alias("file")).distinct()
    return files.groupBy("source", "shard").agg(F.count(F.lit(1)).alias("files"))


def write_stats(report: DataFrame, folder: str) -> None:
    report.write.mode("overwrite").json(folder)


def write_bins(windows: DataFrame, folder: str) -> None:
    """Packed windows as little-endian 16-bit ids, one binary value a (source, shard, split),
    with its window count; Parquet keeps them splittable and committed atomically."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("win")
        ids = np.array(rows.column("tokens").combine_chunks().flatten().to_numpy(), "<u2")
        return pa.table({"source": [key[0].as_py()], "shard": pa.array([key[1].as_py()], pa.int64()), "split": [key[2].as_py()], "windows": pa.array([rows.num_rows], pa.int64()), "data": pa.array([ids.tobytes()], pa.binary())})

    out = windows.groupBy("source", "shard", "split").applyInArrow(run, "source string, shard long, split string, windows long, data binary")
    out.write.mode("overwrite").partitionBy("split").parquet(folder)


def read_bins(spark: SparkSession, folder: str, seq_len: int) -> DataFrame:
    """source, shard, split, win, tokens of what :func:`write_bins` wrote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source, shard, split, data in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(data, "<u2").astype(np.int32).reshape(-1, seq_len)
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([source] * n), pa.array([shard] * n, pa.int64()), pa.array([split] * n), pa.array(range(n), pa.int64()), pa.array(list(ids), pa.list_(pa.int32()))], names=["source", "shard", "split", "win", "tokens"])

    rows = spark.read.parquet(folder).select("source", "shard", "split", "data")
    return rows.mapInArrow(run, "source string, shard long, split string, win long, tokens array<int>")
