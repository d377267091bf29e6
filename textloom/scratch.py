"""Tables that cut lineage, written to the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where that is unset a local session, as
    in tests, gets one of its own; on a cluster it must be set, for executors can't read the
    driver's disk. A context that already has a checkpoint directory keeps it.
    """
    sc = spark.sparkContext
    set_dir = sc._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="textloom-")
        atexit.register(shutil.rmtree, named, True)
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder as Parquet and reads it again.

    A lost executor costs at most the tasks that ran on it: what later plans
    read is a finished table.
    """
    spark = df.sparkSession
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _ours:
        atexit.register(_clear)
    _ours.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables written by this session that weren't forgotten.
_ours: list[str] = []


def _clear() -> None:
    """Deletes this session's tables when it ends, if its context is still there."""
    sc = SparkContext._active_spark_context
    with contextlib.suppress(Py4JError, OSError):  # the context may be going down
        for path in _ours if sc is not None and sc._jsc is not None else ():
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame) -> None:
    """Deletes a table made by :func:`written` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    top = root(spark)
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if top.split(":", 1)[-1].strip("/") in folder:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, name: str) -> DataFrame:
    """:func:`written`, after which the plan that made the table goes: its shuffle files, and
    the driver's heap shrinks to what is in use. For operators of many steps, whose finished
    plans would add up in the driver until Spark next happens to collect its garbage."""
    out = written(df, name)
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished plans that nothing refers to."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
