"""Identity of rows that may share or lack an id, and running totals in an order.

Rows that are equal in every column, ids included, are told apart by a count within their
group, which meets in one task; copies of a text under other ids don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.scratch import written

KEYS = ("_k1", "_k2")


def row_keys(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns, nulls included: only equal rows share them."""
    nulls = F.array(*(F.col(f"`{c}`").isNull() for c in df.columns))
    return [F.xxhash64(F.lit(n), nulls, *(F.col(f"`{c}`") for c in df.columns)).alias(k) for n, k in enumerate(KEYS, 1)]


def keyed(df: DataFrame) -> DataFrame:
    return df.select("*", *row_keys(df))


def _nth() -> Column:
    return F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.lit(0)))


def pick(df: DataFrame, chosen: DataFrame, *carry: str) -> DataFrame:
    """The rows of ``df`` that ``chosen`` names by their keys, as often as it names them;
    ``carry``: columns of ``chosen`` to go with them."""
    times = chosen.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_times"), *(F.first(c).alias(c) for c in carry))
    rows = keyed(df).join(times, list(KEYS)).withColumn("_nth", _nth()).filter("_nth <= _times")
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), *carry)


def attach(df: DataFrame, values: DataFrame, name: str, other=None) -> DataFrame:
    """``df`` with the column ``name`` that ``values`` (keys and that column) has for each
    row; equal rows get their values in order, rows without one ``other``."""
    lists = values.groupBy(*KEYS).agg(F.array_sort(F.collect_list(name)).alias("_values"))
    rows = keyed(df).join(lists, list(KEYS), "left").withColumn("_nth", _nth())
    value = F.get("_values", F.col("_nth") - 1)
    return rows.select(*(F.col(f"`{c}`") for c in df.columns if c != name), (value if other is None else F.coalesce(value, F.lit(other))).alias(name))


def running(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """``rows`` with ``_n`` and ``_sum``: how many rows are before each one in its group, and
    the sum of ``value`` over them.

    Rows are dealt by ranges of (group, order), so a group that holds most rows is spread
    over tasks; totals of ranges, one row for each group and range, give the offsets.
    """
    ranged = written(rows.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    here = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_n", F.count(F.lit(1)).over(here)).withColumn("_sum", F.coalesce(F.sum(value).over(here), F.lit(0)))
    totals = ranged.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(value), F.lit(0)).alias("s"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_s0"))
    starts = starts.withColumnRenamed("_range", "_r")
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    both = local.join(starts, same)
    return both.select(*(F.col(f"`{c}`") for c in rows.columns), (F.col("_n") + F.col("_n0")).alias("_n"), (F.col("_sum") + F.col("_s0")).alias("_sum"))
