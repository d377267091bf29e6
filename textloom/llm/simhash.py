"""SimHash near-dedup with deletion-variant signatures.

A document's fingerprint has 64 bits: a bit is 1 if it is set in over half of the
XXH64 hashes (seed 42, unsigned) of its 4-word shingles. To find all pairs within
``distance`` bits, fingerprints are cut into ``distance // 2 + 1`` segments, so that
in one of them a pair differs by one bit at most. Each segment is indexed once for
every bit with that bit deleted; two fingerprints that differ by one bit at most in a
segment share such a variant. An equality join on variants with the exact Hamming
test in its condition gives the links. Only distinct fingerprints are indexed, so
copies cost nothing, and links already known from a single-deletion pass over whole
fingerprints aren't emitted again.

:func:`keep_one` deletes rows, so with ``jaccard`` a link also needs that similarity of
the texts' sets of shingles. At 0.8 fingerprints differ by 10 bits on average and by 17
at times, too many for segments; MinHash bands give the candidates beyond ``distance``.
Every pair of a band or of a chain of fingerprints is a candidate.
Texts without shingles are alike.

Defined cases: null text and text without words have fingerprint zero and link like
any other; fewer than four words are one shingle; repeated rows each give a row;
null doc_id takes part, but the smallest doc_id ignores it; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm import _text
from textloom.operators.components import connected_components, smallest_labels
from textloom.scratch import settled, written
from textloom.sizes import spread

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
#: Hashes summed at once.
BLOCK = 16_384
#: MinHash bands and minima in a band: a pair of Jaccard similarity 0.8 shares no band with
#: a probability of 0.0007, one of 0.85 of 0.00001.
BANDS, ROWS = 24, 6
#: Shingles in a block of a bucket, and columns of a block's matrix worked on at once.
BLOCK_GRAMS, COLUMNS = 1 << 15, 8192
_RANDOM = np.random.default_rng(SEED)
_TIMES, _PLUS = (_RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(odd) for odd in (1, 0))


def shingle_hashes(raw: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each shingle of a text's UTF-8 bytes, in order; none without words."""
    parts = raw.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    n = max(1, len(parts) - words + 1)
    line = b" ".join(parts)
    upto = np.cumsum([len(p) + 1 for p in parts])
    start = (upto - [len(p) + 1 for p in parts])[:n].tolist()
    end = (upto[min(words, len(parts)) - 1 :] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(start, end)), np.uint64, n)


def folded(hashes: np.ndarray) -> int:
    """The unsigned fingerprint of shingle hashes."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        total += np.unpackbits(hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(raw: bytes, words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a text's UTF-8 bytes."""
    return folded(shingle_hashes(raw, words))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, h: Column | None = None) -> DataFrame:
    """doc_id, fp (signed 64-bit) and, if given, ``h``: a row for each row of ``docs``."""
    more = [] if h is None else ["h"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.parts(batches):
            fp = np.fromiter((fingerprint(t or b"", shingle_words) for t in b.column(1).cast(pa.binary()).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *more])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(h.alias("h") for _ in more)).mapInArrow(run, "doc_id long, fp long" + ", h long" * len(more))


def segments(distance: int = DISTANCE, bits: int = 64) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    n = distance // 2 + 1
    return [(bits * k // n, bits * (k + 1) // n - bits * k // n) for k in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_fingerprints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between the distinct values of ``fp`` that differ by at most
    ``distance`` bits. Pairs that a chain of one-bit links already connects may be left
    out; the components are those of all links."""
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # 8-byte rows become 64 variants each: keep them spread over all tasks
    distinct = fps.select("fp").distinct().repartition(parts)
    # pass 1: fingerprints that share a whole-length one-bit deletion point at its smallest
    # the masks are one literal: with an expression for each, every step of planning holds 64 of them
    masks = [_signed(~(1 << k) & (1 << 64) - 1) for k in range(64)]
    key = F.col("fp").bitwiseAND(F.col("mask"))
    low = distinct.select("fp", F.posexplode(F.lit(masks)).alias("k", "mask")).select("fp", F.col("k").cast("byte").alias("k"), key.alias("key")).groupBy("k", "key").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a <> b").select("a", "b")
    near = settled(low, "near") if distance else low.limit(0)
    comp = connected_components(near)
    table = settled(distinct.join(comp, distinct.fp == comp.node, "left").select("fp", F.coalesce("component", "fp").alias("c")), "prints")
    # pass 2: one-deletion variants of segments
    parted = [(((1 << width) - 1) << lo, k) for lo, width in segments(distance) for k in range(lo, lo + width)]
    number = F.lit([64 * s + k for s, (lo, width) in enumerate(segments(distance)) for k in range(lo, lo + width)])
    variants = F.posexplode(F.lit([_signed(seg & ~(1 << k)) for seg, k in parted])).alias("i", "mask")
    x = table.select("fp", "c", variants).select("fp", "c", F.get(number, "i").cast("short").alias("k"), key.alias("key"))
    y = x.select(*(F.col(c).alias(d) for c, d in (("fp", "fp2"), ("c", "c2"), ("k", "k2"), ("key", "key2"))))
    differ = F.col("fp").bitwiseXOR(F.col("fp2"))
    masks = [_signed(((1 << width) - 1) << lo) for lo, width in segments(distance)]
    # each pair is emitted once: in its first segment with at most one differing bit, and
    # there under that bit's deletion, or the first deletion if none differs
    once = F.lit(False)
    for s, (lo, _) in enumerate(segments(distance)):
        here = differ.bitwiseAND(F.lit(masks[s]))
        earlier = [F.bit_count(differ.bitwiseAND(F.lit(m))) > 1 for m in masks[:s]]
        holds = (F.col("k") == s * 64 + lo) | (here != 0)
        for e in earlier:
            holds = holds & e
        once = once | (F.col("k").between(s * 64, s * 64 + 63) & holds)
    close = (F.col("c") < F.col("c2")) & (F.bit_count(differ) <= distance) & once
    # Spark sizes an explode as its input, 64 times too low here, and would broadcast it
    far = x.join(y.hint("merge"), (x.k == y.k2) & (x.key == y.key2) & close).groupBy("c", "c2").agg(F.min("fp").alias("a")).select(F.col("c").alias("a"), F.col("c2").alias("b"))
    return near.union(far)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable by links): a row for each row."""
    fps = written(fingerprints(docs, shingle_words), "fingerprints")
    comp = connected_components(link_fingerprints(fps, distance))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = classes.join(comp, classes.fp == comp.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    least = named.groupBy("c").agg(F.min("first").alias("component_id"))
    of_fp = named.join(least, "c").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def minhash_bands(distinct: np.ndarray) -> np.ndarray:
    """BANDS hashes, each of ROWS minima of the distinct shingle hashes."""
    h = (distinct ^ distinct >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(h), 2048):
        np.minimum(least, (_TIMES[:, None] * h[None, i : i + 2048] + _PLUS[:, None]).min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = _text.mix(key * np.uint64(_text.BASE) + column)
    return key


def _sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, h (hash of the text as it stands), fp, shape (hash of the words in lower
    case), n (distinct shingles), bands: a row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.parts(batches):
            rows = []
            for t in b.column(2).cast(pa.binary()).to_pylist():
                h = shingle_hashes(t or b"", shingle_words)
                u = np.unique(h)
                rows.append((folded(h), xxhash.xxh64_intdigest(b" ".join((t or b"").lower().split())), len(u), minhash_bands(u).view(np.int64)))
            fp, shape, n, bands = zip(*rows) if rows else ((), (), (), ())
            cols = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fp, shape)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "h", "fp", "shape", "n", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("h"), "text")
    return rows.mapInArrow(run, "doc_id long, h long, fp long, shape long, n long, bands array<long>")


def _text_key() -> Column:
    return F.xxhash64(F.lit(SEED), "text")


def _row(doc_id: str = "doc_id", h: str = "h") -> Column:
    """Orders rows by doc_id, those without one last, then by the hash of the text."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col(h).alias("h"))


def _is_row(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``rows`` (doc_id, h) names; null is a doc_id like any other."""
    named = rows.select(F.col("doc_id").alias("_id"), F.col("h").alias("_named"))
    return docs.withColumn("_h", _text_key()).join(named, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_named")), "left_semi")


def _members(shapes: DataFrame) -> DataFrame:
    """key, shape and ``n``: the buckets of each shape, which are its MinHash bands and the
    cluster of its fingerprint."""
    return shapes.select("shape", "n", F.explode(F.concat("bands", F.array("print"))).alias("key"))


def _stars(shapes: DataFrame, jaccard: float) -> DataFrame:
    """(a, b): each shape with the smallest one of every bucket it is in, if their sizes
    allow the similarity; a bucket of n shapes gives n - 1 candidates at most, never all pairs.
    """
    # two numbers a row: this is what the stage shuffles most of
    member = _members(shapes).select("shape", "key")
    several = member.groupBy("key").agg(F.min("shape").alias("a"), F.max("shape").alias("other")).filter("a <> other").select("key", "a")
    # Spark sizes an explode as its input and would broadcast what comes of it
    met = member.join(several.hint("merge"), "key").filter("shape <> a").select("a", F.col("shape").alias("b")).distinct()
    sizes = [shapes.select(F.col("shape").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab"]
    pairs = met.join(sizes[0], "a").join(sizes[1], "b")
    return pairs.filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(jaccard) - 1e-6).select("a", "b")


def alike_apart(sets: list[np.ndarray], side: np.ndarray, comp: np.ndarray, jaccard: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of pairs of sets with that Jaccard similarity that are in different
    components and, where both sides occur, on different sides."""
    sizes = np.array([len(x) for x in sets])
    grams, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    # only grams of several sets count; they are numbered anew
    place = np.cumsum(many > 1) - 1
    row, column = row[many[column] > 1], place[column[many[column] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[a:b], column[a:b] - lo] = 1
        both += held @ held.T
    near = both >= jaccard * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    near &= comp[:, None] != comp[None, :]
    if side.any() and not side.all():
        near &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(near, 1))
    return i, j


def _rest(shapes: DataFrame, sets: DataFrame, comp: DataFrame, jaccard: float) -> DataFrame:
    """(a, b): a spanning forest of the links between members of a bucket that are in
    different components. Buckets are cut into blocks of about ``BLOCK_GRAMS`` shingles; a
    task compares two blocks and returns what ties components together, never all pairs."""
    member = _members(shapes).join(comp, F.col("shape") == F.col("node"), "left").select("key", "shape", "n", F.coalesce("component", "shape").alias("c"))
    apart = member.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.sum("n").alias("all")).filter("low <> high").select("key", F.ceil(F.col("all") / BLOCK_GRAMS).cast("int").alias("blocks"))
    rows = member.join(apart.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("shape"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("p"), F.greatest("block", o).alias("q")))
    units = rows.select("key", "shape", "c", "block", F.explode(others).alias("u")).select("key", "u.*", "shape", "c", (F.col("block") == F.col("u.q")).alias("side"))

    def run(table: pa.Table) -> pa.Table:
        shape, c = table.column("shape").to_numpy(), table.column("c").to_numpy()
        some = [np.asarray(x) for x in table.column("grams").to_numpy()]
        i, j = alike_apart(some, table.column("side").to_numpy().astype(bool), c, jaccard)
        nodes, root = smallest_labels(shape[i], shape[j]) if len(i) else (shape[:0], shape[:0])
        return pa.table({"a": root[nodes != root], "b": nodes[nodes != root]})

    return units.join(sets, "shape").groupBy("key", "p", "q").applyInArrow(run, "a long, b long")


def similar_shapes(docs: DataFrame, sketches: DataFrame, jaccard: float, distance: int, shingle_words: int) -> DataFrame:
    """(a, b): links between shapes whose sets of shingles have that Jaccard similarity;
    pairs that others already connect may be left out.

    Buckets are MinHash bands and clusters of fingerprints that chains of links within
    ``distance`` join. Every shape meets the smallest one of each of its buckets first, then
    members of a bucket that are in different components by then meet each other. All are
    compared by their whole sets.
    """
    prints = settled(connected_components(link_fingerprints(sketches.select("fp"), distance)), "clusters")
    shapes = sketches.groupBy("shape").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.min(_row()).alias("row"))
    cluster = F.xxhash64(F.lit("print"), F.coalesce("component", "fp")).alias("print")
    shapes = settled(shapes.join(prints, F.col("fp") == F.col("node"), "left").select("shape", "n", "bands", "row", cluster), "shapes")
    pairs = settled(_stars(shapes, jaccard), "pairs")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches):
            texts = [t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()]
            shape = np.array([xxhash.xxh64_intdigest(b" ".join(t.lower().split())) for t in texts], np.uint64)
            sets = [np.unique(shingle_hashes(t, shingle_words)).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(shape.view(np.int64)), pa.array(sets, pa.list_(pa.int64()))], names=["shape", "grams"])

    several = _members(shapes).select("shape", "key")
    shared = several.groupBy("key").agg(F.min("shape").alias("low"), F.max("shape").alias("high")).filter("low <> high").select("key")
    wanted = several.join(shared.hint("merge"), "key", "left_semi").select("shape").union(pairs.select("a")).union(pairs.select("b")).distinct()
    texts = _is_row(docs.select("doc_id", "text"), shapes.join(wanted, "shape", "left_semi").select("row.*"))
    sets = settled(texts.select("text").mapInArrow(grams, "shape long, grams array<long>").dropDuplicates(["shape"]), "grams")
    both = pairs.join(sets.select(F.col("shape").alias("b"), F.col("grams").alias("g_b")), "b").join(sets.select(F.col("shape").alias("a"), F.col("grams").alias("g_a")), "a")
    shared = both.select("a", "b", F.size(F.array_intersect("g_a", "g_b")).alias("both"), (F.size("g_a") + F.size("g_b")).alias("sum"))
    near = settled(shared.filter(F.col("both") / (F.col("sum") - F.col("both")) >= jaccard).select("a", "b"), "similar")
    return near.union(settled(_rest(shapes, sets, connected_components(near), jaccard), "similar"))


def keep_one(docs: DataFrame, distance: int = DISTANCE, shingle_words: int = SHINGLE_WORDS, jaccard: float | None = None) -> DataFrame:
    """One row of each near-duplicate group stays: that with the smallest doc_id (null is
    last), of several the one whose text has the smallest hash. Links are fingerprints
    within ``distance`` or, with ``jaccard``, texts whose shingles are that similar."""
    if jaccard is None:
        rows = settled(fingerprints(docs, shingle_words, _text_key()), "fingerprints")
        node, links = "fp", link_fingerprints(rows, distance)
    else:
        rows = settled(_sketches(docs, shingle_words), "sketches")
        node, links = "shape", similar_shapes(docs, rows, jaccard, distance, shingle_words)
    comp = connected_components(links)
    first = rows.groupBy(node).agg(F.min(_row()).alias("row"))
    named = first.join(comp, first[node] == comp.node, "left").select("row", F.coalesce("component", node).alias("c"))
    kept = settled(named.groupBy("c").agg(F.min("row").alias("row")).select("row.doc_id", "row.h"), "kept")
    # rows of one doc_id and one text: the first by all their columns
    order = F.xxhash64(*docs.columns)
    row = F.row_number().over(Window.partitionBy("doc_id", "_h").orderBy(order))
    return _is_row(docs, kept).select("*", row.alias("_row")).filter("_row = 1").drop("_row", "_h")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
