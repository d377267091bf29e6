"""Shared helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def usual_size(vectors: DataFrame, column: str = "embedding") -> int:
    """The commonest number of components (the smaller of equally common ones)."""
    row = vectors.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return row.n if row else 0


def matrix(blob: bytes, width: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(blob, kind).reshape(-1, width)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that squares stay finite."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
