"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Only distinct vectors of a label take part; copies count by their number. Every label has
centroids of its own, from a bounded sample of all vectors. Each vector has a home cell,
that of its nearest centroid, and visits every cell in which a vector within the threshold
could be at home: y at home with d is on d's side of the plane between d and c, and x.y can
only reach the threshold t if x is at most sqrt(1 - t * t) behind that plane. So no link is
lost. How many cells a label has is what makes least work for its sample: with more cells
fewer vectors meet, but a vector visits more. Cells are cut into
blocks of ``BLOCK`` vectors by a hash; each pair of blocks is one matrix product in
double precision, of which only link counts and a spanning forest leave the task, never
all pairs. The smallest vec_id of each component is kept.

Vectors far from any structure visit nearly all cells, few of which are then made, and the
work is that of comparing all vectors of a label in blocks.

Defined cases: null, empty, zero and non-finite vectors and null labels link with
nothing; vectors of different length link with nothing of another length; repeated rows
are copies and link with each other; null vec_id takes part, but the smallest vec_id
ignores it; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import _vectors
from textloom.operators.components import connected_components, smallest_labels
from textloom.scratch import written

THRESHOLD = 0.93
#: Most vectors that centroids are fitted on; of these a label needs so many for each cell.
SAMPLE, FEWEST = 20_000, 64
#: What it costs to send a vector to one more cell, in vectors that it is compared with.
VISIT = 64
BLOCK = 2048
ROUNDS = 8


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 5, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids (fewer if there are fewer vectors) of unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), c)
    return c


def cells_of(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and a table of the cells that each visits."""
    dots = x @ c.T
    home = dots.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))[home]
    most = np.sqrt(max(0.0, 1 - threshold * threshold)) if threshold > 0 else np.inf
    return home, dots.max(axis=1, keepdims=True) - dots <= most * apart + 1e-9


def centroids(x: np.ndarray, vectors: float, threshold: float) -> np.ndarray:
    """Centroids of one label from its sample; ``vectors``: how many the label has. Their
    number is doubled as long as that lowers the work for a vector."""
    best, least, k = x[:1], vectors + VISIT, 2
    while k * FEWEST <= len(x):
        c = spherical_kmeans(x, k)
        visits = cells_of(x, c, threshold)[1]
        work = (visits.sum(axis=1).mean() / k) * vectors + VISIT * visits.sum(axis=1).mean()
        # two cells are made in any case: whether more are of use shows from there on
        if k > 2 and work >= least:
            break
        best, least, k = c, work, 2 * k
    return best


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors``: node (long), label, embedding, m (copies), one row for each node.
    Gives (a, b, n): with null b, n links of a (copies counted, its own not); else b is
    linked with a, enough pairs to span each component."""
    spark = vectors.sparkSession
    width = _vectors.usual_size(vectors)
    count = vectors.count()
    few = vectors.filter(F.size("embedding") == width).orderBy(F.xxhash64("node")).limit(SAMPLE).select("label", "embedding").toArrow()
    of_label: dict = {}
    for label, e in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
        of_label.setdefault(label, []).append(e)
    c = {label: centroids(_vectors.unit(np.array(e, np.float64)), count * len(e) / few.num_rows, threshold) for label, e in sorted(of_label.items(), key=str) if len(e) >= 2 * FEWEST}
    shared = spark.sparkContext.broadcast(c)  # at most SAMPLE / FEWEST vectors

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for b in batches:
            lists, labels = b.column(1).to_pylist(), b.column(2).to_pylist()
            groups: dict = {}
            for i, (e, label) in enumerate(zip(lists, labels)):
                groups.setdefault(label if len(e) == width and label in c else None, []).append(i)
            alone = groups.pop(None, [])
            row, cell, home = [np.array(alone, np.int64)], [np.zeros(len(alone), np.int64)], [np.ones(len(alone), bool)]
            for label, own in groups.items():
                h, visits = cells_of(_vectors.unit(np.array([lists[i] for i in own])), c[label], threshold)
                r, to = np.nonzero(visits)
                row, cell, home = [*row, np.array(own)[r]], [*cell, to], [*home, h[r] == to]
            row = np.concatenate(row)
            out = [pa.array(row), pa.array(np.concatenate(cell)), pa.array(np.concatenate(home))]
            take = b.take(out[0])
            yield pa.RecordBatch.from_arrays([*take.columns, out[1], out[2]], names=["node", "embedding", "label", "m", "cell", "home"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    dealt = vectors.select("node", "embedding", "label", "m").mapInArrow(deal, f"node long, embedding {kind}, label {vectors.schema['label'].dataType.simpleString()}, m long, cell long, home boolean")
    dealt = written(dealt.withColumn("size", F.size("embedding")), "dealt")
    cell = ["label", "size", "cell"]
    sizes = dealt.groupBy(*cell).agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("guests"))
    blocks = sizes.withColumn("hb", F.ceil(F.col("homes") / BLOCK).cast("int")).withColumn("gb", F.ceil(F.col("guests") / BLOCK).cast("int")).filter("hb > 0")
    packed = F.collect_list(F.struct("node", "m", "embedding"))
    at = dealt.join(blocks, cell)
    homes = at.filter("home").withColumn("h", F.pmod(F.xxhash64("node"), F.col("hb"))).groupBy(*cell, "h", "gb").agg(packed.alias("own"))
    guests = at.withColumn("g", F.pmod(F.xxhash64("node"), F.col("gb"))).groupBy(*cell, "g").agg(packed.alias("guest"))
    units = homes.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gb").cast("long") - 1))).join(guests, [*cell, "g"])

    def arrays(cell) -> tuple:
        rows = cell.as_py()
        return np.array([r["node"] for r in rows]), np.array([r["m"] for r in rows]), _vectors.unit(np.array([r["embedding"] for r in rows]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                home, m, y = arrays(b.column(0)[i])
                guest, _, x = arrays(b.column(1)[i])
                near = (x @ y.T >= threshold) & (guest[:, None] != home[None, :])
                n = near @ m
                p, q = np.nonzero(near)
                nodes, root = smallest_labels(guest[p], home[q]) if len(p) else (guest[:0], guest[:0])
                tie = nodes != root
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((guest[some], nodes[tie]))), pa.array([None] * int(some.sum()) + root[tie].tolist(), pa.int64()), pa.array(np.concatenate((n[some], np.zeros(tie.sum(), np.int64))))], names=["a", "b", "n"])

    return units.select("own", "guest").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row of ``vectors``."""
    node = F.when(_vectors.usable() & F.col("label").isNotNull(), F.xxhash64("label", "embedding"))
    rows = vectors.select("vec_id", "label", "embedding").withColumn("node", node)
    distinct = written(rows.filter("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("m")), "vectors")
    found = written(links(distinct, threshold), "vector-links")
    comp = connected_components(found.filter("b is not null").select("a", "b"))
    n = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = distinct.select("node", "least", "m").join(comp, "node", "left").join(n, "node", "left").select("node", "least", F.coalesce("component", "node").alias("c"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    by_node = named.join(least, "c").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    first = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), first.cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == first, F.lit(False)).alias("kept"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op4_embedding_dedup": op4_embedding_dedup}

ORACLE_SQL = {
    "op4_embedding_dedup": """WITH RECURSIVE ok AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a AS node, a AS root FROM p UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.node),
c AS (SELECT node, min(root) AS root FROM r GROUP BY node), n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.root, vec_id) AS component_id, coalesce(c.root, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.node = vec_id"""
}
