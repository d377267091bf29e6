"""Connected components of an undirected graph of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.scratch import forget, written

#: Links contracted at once by one task; more than that are contracted in turn.
BATCH = 1_000_000


def smallest_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b), and the smallest node that each reaches."""
    nodes, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces a task's links (u, v) by a star (node, smallest node) for each of the
    components they form; those without use are left out."""
    u = v = np.zeros(0, np.int64)
    for b in batches:
        u = np.concatenate((u, b.column(0).to_numpy()))
        v = np.concatenate((v, b.column(1).to_numpy()))
        if len(u) >= 2 * BATCH:
            n, r = smallest_labels(u, v)
            u, v = n[n != r], r[n != r]
            if len(u) >= BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u = v = np.zeros(0, np.int64)
    if len(u):
        n, r = smallest_labels(u, v)
        yield pa.RecordBatch.from_arrays([pa.array(n[n != r]), pa.array(r[n != r])], names=["u", "v"])


def connected_components(links: DataFrame, max_rounds: int = 60, one_task: int = BATCH) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns); component is the
    smallest node reachable. Null ends and self-links are ignored.

    Links are contracted inside tasks first. What is left is counted: up to ``one_task``
    links are finished by one task. Beyond that, each round takes a large-star and a
    small-star step, until every node points at a root. Rounds grow with the logarithm of
    the longest path. Lineage is cut by a written table each round; no links reach the
    driver, only their count and a checksum.
    """
    a, b = links.columns[:2]
    stars = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u is not null and v is not null and u <> v")
    kind = "u long, v long"
    stars = written(stars.mapInArrow(contract, kind), "links")
    seen = None
    for _ in range(max_rounds):
        sign = stars.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if sign == seen or sign[0] == 0:
            break
        seen, old = sign, stars
        if sign[0] <= one_task:
            stars = written(stars.coalesce(1).mapInArrow(contract, kind), "links")
            forget(old)
            break
        both = stars.union(stars.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour points at the smallest
        large = both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: of each node's smaller neighbours all point at the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        stars = written(small.distinct(), "links")
        forget(old)
    # When a round changes nothing, every node points at its component's smallest.
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
