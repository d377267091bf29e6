"""Approximate nearest neighbours over a robust-pruned directed graph.

Distinct vectors of one length are dealt to shards by a hash: of ``SHARD`` vectors while
these are fewer than ``SPREAD`` shards, and of up to ``MOST`` beyond. In each shard a graph
is built from random out-edges: points go in by batches, a greedy beam search proposes
neighbours, and pruning with a relaxed distance (``ALPHA``) keeps near and diverse ones;
edges are added backwards and overfull nodes pruned again. The index is a table with one
row for a shard. Blocks of queries go to every shard of vectors of their length, which stays
in its task for ``SLICE`` blocks, and run a beam search there; the best of all shards are
ranked by cosine in double precision on the original vectors.

Every vector is indexed. With random 64-dimensional vectors (the hardest case, no
structure) measured recall of the five nearest is in the README.

Defined cases: null, empty, zero and non-finite vectors take no part, nor do null
vec_id; vectors of different length aren't near each other; rows equal in vec_id and vector
are one row; rows that share a vec_id with different vectors are candidates and queries each,
also of one another; equal vectors are one node with all their vec_ids in order, of which a
query needs k + 1 at most; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm import _vectors
from textloom.scratch import written

SHARD, SPREAD, MOST = 4096, 16, 65_536
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 64
BEAM = 192
#: Nodes opened at once in a step of a beam search, points inserted at once, queries in a block.
OPEN, BATCH, QUERIES_AT_ONCE = 4, 256, 256
#: Blocks of queries for which a shard is sent to a task once.
SLICE = 64


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The beam's nodes and their dot products with each query, best first; -1 where
    fewer were reached. ``graph`` has -1 for a missing edge."""
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1, np.int64)
    dots = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    ids[:, 0], dots[:, 0], done[:, 0] = start, q @ x[start], False
    seen = np.zeros((n, len(x) + 1), bool)  # the last column stands for missing edges
    seen[:, start] = seen[:, -1] = True
    live = np.arange(n)
    while len(live):
        todo = np.where(done[live], -np.inf, dots[live])
        pick = np.argpartition(-todo, OPEN - 1, axis=1)[:, :OPEN] if beam > OPEN else np.argsort(-todo, axis=1)
        ok = np.take_along_axis(todo, pick, 1) > -np.inf
        r = rows[: len(live)]
        flags = done[live]
        flags[r, pick] = True
        nodes = np.where(ok, np.take_along_axis(ids[live], pick, 1), -1)
        near = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near = np.where(seen[live[:, None], near], -1, near)
        seen[live[:, None], near] = True
        new = np.einsum("nrd,nd->nr", x[near], q[live])
        new[near < 0] = -np.inf
        all_dots = np.concatenate((dots[live], new), axis=1)
        top = np.argpartition(-all_dots, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(np.concatenate((ids[live], near), axis=1), top, 1)
        dots[live] = np.take_along_axis(all_dots, top, 1)
        done[live] = np.take_along_axis(np.concatenate((flags, near < 0), axis=1), top, 1)
        live = live[(~done[live]).any(axis=1)]
    order = np.argsort(-dots, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(dots, order, 1)


def robust_prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point up to ``degree`` of its candidates (-1: none): the nearest one
    stays and drops all those that it is nearer to, by the factor alpha, than the point."""
    cand = np.where(cand == points[:, None], -1, cand)
    cand.sort(axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    far = 2 - 2 * np.einsum("ncd,nd->nc", x[cand], x[points])
    far[cand < 0] = np.inf
    order = np.argsort(far, axis=1)[:, : 3 * degree]
    cand, far = np.take_along_axis(cand, order, 1), np.take_along_axis(far, order, 1)
    v = x[cand]
    between = 2 - 2 * (v @ v.transpose(0, 2, 1))
    out = np.full((len(points), degree), -1, np.int64)
    rows, alive = np.arange(len(points)), far < np.inf
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, k] = cand[rows, first][some]
        alive &= alpha * alpha * between[rows, first] > far
        alive[rows, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 3) -> tuple[np.ndarray, int]:
    """Graph (-1: no edge) and start node for unit vectors in single precision."""
    n, rng = len(x), np.random.default_rng(seed)
    start = int((x @ x.mean(axis=0)).argmax())
    if n <= degree + 1:
        return np.where(np.arange(n)[None, :] == np.arange(n)[:, None], -1, np.arange(n)[None, :]).astype(np.int32), start
    graph = rng.integers(0, n, (n, degree))
    graph[graph == np.arange(n)[:, None]] = -1
    order = rng.permutation(n)
    for lo in range(0, n, BATCH):
        points = order[lo : lo + BATCH]
        found, _ = beam_search(x, graph, start, x[points], beam)
        graph[points] = robust_prune(x, points, np.concatenate((found, graph[points]), axis=1), degree, alpha)
        # edges backwards, by target
        src, dst = np.repeat(points, degree), graph[points].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        node, begin, many = np.unique(dst, return_index=True, return_counts=True)
        extra = np.full((len(node), min(int(many.max()), 2 * degree)), -1, np.int64)
        k = np.arange(len(dst)) - np.repeat(begin, many)
        fits = k < extra.shape[1]
        extra[np.repeat(np.arange(len(node)), many)[fits], k[fits]] = src[fits]
        graph[node] = robust_prune(x, node, np.concatenate((graph[node], extra), axis=1), degree, alpha)
    return graph.astype(np.int32), start


def build_index(vectors: DataFrame, k: int, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM) -> DataFrame:
    """width, shard, start, ids (k + 1 longs a node), raw (original components), graph: one row
    for a shard. ``vectors``: embedding, ids (array of long)."""
    kind = "width int, shard int, start int, ids binary, raw binary, graph binary"

    def run(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        width = keys[0].as_py()
        raw = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("embedding").chunks]).astype(np.float64).reshape(-1, width)
        ids = np.full((len(raw), k + 1), -1, np.int64)
        for i, row in enumerate(table.column("ids").to_pylist()):
            ids[i, : len(row)] = row
        order = np.lexsort((*raw.T[:1], ids[:, 0]))
        raw, ids = raw[order], ids[order]
        graph, start = build(_vectors.unit(raw).astype(np.float32), degree, alpha, beam)
        cell = lambda x, t: pa.array([x], t)
        return pa.table({"width": cell(width, pa.int32()), "shard": cell(keys[1].as_py(), pa.int32()), "start": cell(start, pa.int32()), "ids": cell(ids.tobytes(), pa.binary()), "raw": cell(raw.tobytes(), pa.binary()), "graph": cell(graph.tobytes(), pa.binary())})

    own = vectors.withColumn("width", F.size("embedding"))
    n = F.count(F.lit(1))
    shards = F.greatest(F.lit(1), F.least(F.lit(SPREAD), F.round(n / SHARD)), F.ceil(n / MOST))
    counts = own.groupBy("width").agg(shards.cast("int").alias("shards"))
    dealt = own.join(counts, "width").withColumn("shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by number: a graph takes long for its bytes, so small partitions mustn't be joined
    return dealt.select("embedding", "ids", "width", "shard").repartition(parts, "width", "shard").groupBy("width", "shard").applyInArrow(run, kind)


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """query_id, q, vec_id, score: the k best found by each shard for each query (query_id,
    embedding), its own row left out; q is a hash of the query's vector."""
    rows = queries.withColumn("width", F.size("embedding"))
    blocks = rows.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / QUERIES_AT_ONCE).alias("blocks"))
    packed = rows.join(blocks, "width").withColumn("block", F.pmod(F.xxhash64("query_id", "embedding"), F.col("blocks"))).groupBy("width", "block").agg(F.collect_list(F.struct("query_id", F.xxhash64("embedding").alias("q"), "embedding")).alias("rows"))
    # the stated query set, in blocks, goes to each shard; the graphs stay
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / SLICE)))
    graphs = index.join(blocks, "width").select("width", "shard", slices.alias("slice"), F.lit(0).alias("kind"), "start", "ids", "raw", "graph", F.lit(None).cast(packed.schema["rows"].dataType).alias("rows"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("ids", "binary"), ("raw", "binary"), ("graph", "binary"))]
    asked = packed.join(index.select("width", "shard"), "width").select("width", "shard", F.floor(F.col("block") / SLICE).alias("slice"), F.lit(1).alias("kind"), *nothing, "rows")

    def answers(graph: tuple, rows: list[dict]) -> pa.RecordBatch:
        full, single, ids, edges, start = graph
        q = _vectors.unit(np.array([x["embedding"] for x in rows]))
        me = np.array([x["query_id"] for x in rows])
        found, _ = beam_search(single, edges, start, q.astype(np.float32), min(beam, max(len(full), OPEN + 1)))
        found = found[:, : 4 * k + 8]
        score = np.einsum("nfd,nd->nf", full[found], q)
        score[found < 0] = -np.inf
        out = ([], [], [], [])
        for i in range(len(rows)):
            vec = ids[found[i]]
            # the query's own row: its id at its own vector
            own = (vec == me[i]) & (full[found[i]] == q[i]).all(axis=1)[:, None]
            s = np.where((vec >= 0) & ~own & (score[i] > -np.inf)[:, None], score[i][:, None], -np.inf).ravel()
            vec = vec.ravel()
            best = np.lexsort((vec, -s))[:k]
            best = best[s[best] > -np.inf]
            out[0].extend([int(me[i])] * len(best))
            out[1].extend([rows[i]["q"]] * len(best))
            out[2].extend(vec[best].tolist())
            out[3].extend(s[best].tolist())
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.float64())], names=["query_id", "q", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = None
        for b in batches:
            for i in range(b.num_rows):
                r = {name: b.column(at)[i] for at, name in enumerate(b.schema.names)}
                if r["kind"].as_py() == 0:
                    raw = np.frombuffer(r["raw"].as_buffer(), np.float64).reshape(-1, r["width"].as_py())
                    full = _vectors.unit(raw)
                    ids = np.frombuffer(r["ids"].as_buffer(), np.int64).reshape(len(raw), -1).copy()
                    edges = np.frombuffer(r["graph"].as_buffer(), np.int32).reshape(len(raw), -1).astype(np.int64)
                    graph = full, full.astype(np.float32), ids, edges, r["start"].as_py()
                else:
                    yield answers(graph, r["rows"].as_py())

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = graphs.union(asked).repartition(parts, "width", "shard", "slice").sortWithinPartitions("width", "shard", "slice", "kind")
    return units.mapInArrow(run, "query_id long, q long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, k: int = 5, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` that ``is_query`` (a
    condition on vec_id) names."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & _vectors.usable()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    distinct = rows.withColumn("i", first).filter(F.col("i") <= k + 1).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    index = written(build_index(written(distinct, "distinct-vectors"), k), "graph-index")
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "embedding")
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return search(index, queries, k, beam).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


QUERIES = {"op9_graph_ann": op9_graph_ann}
