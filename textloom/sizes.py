"""How large a table is, before it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An estimate beyond this is the optimizer's "unknown", or a product of unknowns.
UNKNOWN = 1 << 56


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df`` (for a scan, that of its files); where it has none,
    the bytes of the text columns are summed by a job."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < UNKNOWN:
        return size
    texts = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return sum(df.agg(F.count(F.lit(1)) * 8, *texts).first())


def pieces(df: DataFrame, bytes_each: int, least: int = 1, most: int = 1 << 20) -> int:
    """Into how many pieces of ``bytes_each`` to deal out ``df``."""
    return max(least, min(most, -(-estimated_bytes(df) // bytes_each)))


def spread(df: DataFrame, least: int = 1 << 20, most_each: int = 8 << 20) -> DataFrame:
    """``df`` dealt to all cores if it is a small scan of fewer files than there are cores: a
    file's row group is one task, however much is to be done with its rows. Larger scans
    stay as they are, so nothing that grows is shuffled for this."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not least <= estimated_bytes(df) <= most_each * cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
