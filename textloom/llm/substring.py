"""Substring dedup by seed and extend.

Words (runs of bytes other than white space, unchanged) are hashed; every window of
``window`` words is represented by its anchor, the smallest of the hashes of the
``gram``-word runs in it (winnowing), so equal windows have equal anchors at the same
place. Documents are joined on anchors: a task gets all occurrences of its anchors,
leaves those of one document only, and extends the others both ways by all the
windows that each anchor stands for, at most ``window - gram`` words to either side.
A window whose words occur in a document with a smaller doc_id is marked; runs of
marked windows are the maximal repeats of at least ``window`` words, and every word in
one is removed.

Occurrences travel as packed arrays, a few dozen bytes an anchor and one anchor for
about five words. Two windows count as equal if a 64-bit anchor hash, the place of the
anchor and 32 further bits of a hash of the window agree (96 bits and more, of word hashes
in which words of up to 8 bytes are told apart exactly and longer ones by XXH64).

Each batch of about ``PACK_BYTES`` of text is judged by itself first: an occurrence all of
whose windows a smaller doc_id of the same batch has is marked there and doesn't travel. So
the task of a passage that a third of all documents share gets an occurrence for each batch
and window, not for each document.

Defined cases: null and empty texts have no words and sha256 of the empty string; a
text shorter than the window loses nothing; a document with null doc_id neither loses
words nor makes others lose them; rows with equal doc_id don't count as smaller than
each other; repeated rows each give a row; other columns are ignored or, in
:func:`remove_repeats`, carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import _text
from textloom.sizes import pieces, spread

WINDOW = 13
GRAM = 5
#: Bytes of input for each bucket of anchors, and of text packed at once.
BUCKET_BYTES = 2 << 20
PACK_BYTES = 4 << 20

_B = np.uint64(_text.BASE)


def runs_of_hashes(words: np.ndarray, n: int, multiplier: np.uint64) -> np.ndarray:
    """A hash of each run of n words; the last n - 1 places are left out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        out *= multiplier
        out += words[j : len(words) - n + 1 + j]
    return _text.mix(out)


def anchors(words: np.ndarray, counts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """For consecutive documents with ``counts`` words each: anchor hashes, their
    document's place, word position, how far before it its first window starts, how many
    windows it stands for; and 32 bits for each of those windows, in order."""
    span = window - gram + 1
    grams = runs_of_hashes(words, gram, _B)
    whole = (runs_of_hashes(words, window, _text.MIX_B) >> np.uint64(32)).astype(np.uint32)
    doc = np.repeat(np.arange(len(counts)), counts)
    n = len(whole)
    if not n:
        z = np.zeros(0, np.int64)
        return grams[:0], z, z, z, z, whole
    least, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, span):
        g = grams[j : n + j]
        low = g < least
        least[low] = g[low]
        at[low] = j
    s = np.arange(n)
    ok = doc[:n] == doc[window - 1 :]
    a = s + at
    s, a, least = s[ok], a[ok], least[ok]
    if not len(s):
        z = np.zeros(0, np.int64)
        return least, z, z, z, z, whole[:0]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (doc[s[1:]] != doc[s[:-1]]))))
    many = np.diff(np.append(first, len(s)))
    begin = np.cumsum(counts) - counts
    d = doc[s[first]]
    return least[first], d, a[first] - begin[d], a[first] - s[first], many, whole[s]


def pack(docs: DataFrame, buckets: int, window: int, gram: int) -> DataFrame:
    """bucket, blob: the occurrences of a batch's anchors that fall in the bucket; with a
    null blob k1, k2, spans that the batch itself decides."""

    def emit(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, d, p, o, m, f, ids = (np.concatenate(c) for c in zip(*held))
        row, begin, marked = judged(h, ids[:, 0][d], p, o, m, f)
        done = np.ones(len(h), bool)
        done[row[~marked]] = False
        done[np.isin(np.arange(len(h)), row, invert=True)] = False
        yield _spans(ids, *runs_of_windows(d, row[done[row]], begin[done[row]], window))
        left = np.repeat(~done, m)
        h, d, p, o, m, f = h[~done], d[~done], p[~done], o[~done], m[~done], f[left]
        to = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        ends = np.searchsorted(to[order], np.arange(buckets + 1))
        start = np.cumsum(m) - m
        out_b, out = [], []
        for b in np.flatnonzero(np.diff(ends)):
            r = order[ends[b] : ends[b + 1]]
            used, local = np.unique(d[r], return_inverse=True)
            n = m[r]
            which = np.repeat(start[r] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            head = np.array([len(used), len(r)], np.int64)
            out_b.append(int(b))
            out.append(b"".join(x.tobytes() for x in (head, ids[used], h[r], p[r].astype(np.uint32), local.astype(np.uint32), o[r].astype(np.uint8), n.astype(np.uint8), f[which])))
        none = pa.nulls(len(out), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(out_b, pa.int64()), pa.array(out, pa.binary()), none, none, pa.nulls(len(out), pa.binary())], names=["bucket", "blob", "k1", "k2", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, base = [], 0, 0
        for b in _text.slices(batches):
            texts = b.column(3).cast(pa.binary()).to_pylist()
            words, counts = _text.tokens(texts)
            h, d, *rest = anchors(words, counts, window, gram)
            keys = np.stack([c.to_numpy() for c in b.columns[:3]], axis=1)
            held.append((h, d + base, *rest, keys))
            size, base = size + sum(map(len, texts)), base + len(texts)
            if size >= PACK_BYTES:
                full, held, size, base = held, [], 0, 0
                yield from emit(full)
        if held:
            yield from emit(held)

    rows = docs.filter("text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), *_key(), "text")
    return rows.mapInArrow(run, "bucket long, blob binary, k1 long, k2 long, spans binary")


def _key() -> list:
    """Two 64-bit hashes that stand for (doc_id, text), nulls included."""
    return [F.xxhash64(F.lit(n), "doc_id", "text").alias(f"k{n}") for n in (1, 2)]


def unpack(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """The occurrences of several blobs: ids of documents, then columns as in pack()."""
    ids, cols, base = [], [], 0
    for blob in blobs:
        used, r = np.frombuffer(blob, np.int64, 2)
        at = 16
        part = []
        for kind, n in ((np.int64, 3 * used), (np.uint64, r), (np.uint32, r), (np.uint32, r), (np.uint8, r), (np.uint8, r)):
            part.append(np.frombuffer(blob, kind, n, at))
            at += part[-1].nbytes
        part.append(np.frombuffer(blob, np.uint32, offset=at))
        ids.append(part[0].reshape(-1, 3))
        cols.append((*part[1:3], part[3].astype(np.int64) + base, *part[4:]))
        base += used
    return np.concatenate(ids), *(np.concatenate(c) for c in zip(*cols))


def judged(h: np.ndarray, doc: np.ndarray, p: np.ndarray, o: np.ndarray, m: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the windows of anchors that several documents have: the occurrence that each belongs
    to, the window's first word, and whether a smaller document has it as well."""
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1]))) if len(h) else np.zeros(0, np.int64)
    z = np.zeros(0, np.int64)
    if not len(first):
        return z, z, z.astype(bool)
    low, high = np.minimum.reduceat(doc[order], first), np.maximum.reduceat(doc[order], first)
    shared = np.repeat(low < high, np.diff(np.append(first, len(order))))
    rows = np.sort(order[shared])
    if not len(rows):
        return z, z, z.astype(bool)
    n = m[rows].astype(np.int64)
    row = np.repeat(rows, n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.cumsum(m.astype(np.int64)) - m
    place = o[row].astype(np.int64) - k
    tail = (place.astype(np.uint64) << np.uint64(32)) | f[start[row] + k]
    by = np.lexsort((tail, h[row]))
    new = np.concatenate(([True], (h[row][by][1:] != h[row][by][:-1]) | (tail[by][1:] != tail[by][:-1])))
    least = np.minimum.reduceat(doc[row][by], np.flatnonzero(new))
    marked = np.zeros(len(row), bool)
    marked[by] = doc[row][by] > least[np.cumsum(new) - 1]
    return row, p[row].astype(np.int64) - place, marked


def runs_of_windows(d: np.ndarray, row: np.ndarray, begin: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Places of the documents that lose words, and for each run of marked windows its document
    among them and (first word, end) of what it covers."""
    if not len(row):
        return row, row, np.zeros((0, 2), np.int64)
    # windows of one anchor that start one after another are one run
    head = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (begin[1:] != begin[:-1] + 1))))
    last = np.append(head[1:], len(row)) - 1
    used, local = np.unique(d[row[head]], return_inverse=True)
    return used, local, np.stack((begin[head], begin[last] + window), axis=1)


def _spans(ids: np.ndarray, used: np.ndarray, local: np.ndarray, spans: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(local, kind="stable")
    ends = np.searchsorted(local[order], np.arange(len(used) + 1))
    flat = spans[order].astype(np.int32)
    own = ids[used]
    # any task can pass them on
    columns = [pa.array(own[:, 1]), pa.nulls(len(own), pa.binary()), pa.array(own[:, 1]), pa.array(own[:, 2]), pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "blob", "k1", "k2", "spans"])


def extend(blobs: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Ids of the documents in a bucket, and what runs_of_windows() finds in it."""
    ids, h, p, d, o, m, f = unpack(blobs)
    row, begin, marked = judged(h, ids[:, 0][d], p, o, m, f)
    return ids, *runs_of_windows(d, row[marked], begin[marked], window)


def marks(packed: DataFrame, partitions: int, window: int) -> DataFrame:
    """k1, k2, spans (binary pairs of int32): what each document loses, a row for each
    bucket or batch that found something."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            ready = batch.filter(pc.is_null(batch.column(1)))
            yield ready.select(["k1", "k2", "spans"])
            rest = batch.filter(pc.is_valid(batch.column(1)))
            for b, blob in zip(rest.column(0).to_pylist(), rest.column(1).to_pylist()):
                if b != bucket and held:
                    yield _spans(*extend(held, window)).select(["k1", "k2", "spans"])
                    held = []
                bucket = b
                held.append(blob)
        if held:
            yield _spans(*extend(held, window)).select(["k1", "k2", "spans"])

    # by number, not by hash: every partition gets as many buckets
    return packed.repartitionById(partitions, F.pmod("bucket", F.lit(partitions)).cast("int")).sortWithinPartitions("bucket").mapInArrow(run, "k1 long, k2 long, spans binary")


def lost_words(n: int, spans: list[bytes] | None) -> np.ndarray:
    """Which of n words are covered."""
    step = np.zeros(n + 1, np.int32)
    for s in spans or ():
        pairs = np.frombuffer(s, np.int32).reshape(-1, 2)
        np.add.at(step, pairs[:, 0], 1)
        np.add.at(step, pairs[:, 1], -1)
    return np.cumsum(step[:n]) > 0


def _with_spans(docs: DataFrame, window: int, gram: int):
    if not 0 < gram <= window <= gram + 255:
        raise ValueError("a window has 1 to 255 words more than a gram")
    partitions = pieces(docs, 4 * BUCKET_BYTES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # as many partitions for the texts, so that a task's share doesn't grow with the input
    found = marks(pack(docs, 4 * partitions, window, gram), partitions, window).repartition(partitions, "k1", "k2")
    spans = found.groupBy("k1", "k2").agg(F.collect_list("spans").alias("spans"))
    rest = F.struct(*(c for c in docs.columns if c != "text")) if len(docs.columns) > 1 else F.struct(F.lit(0).alias("none"))
    keyed = docs.select(rest.alias("doc"), *_key(), "text")
    kind = keyed.schema["doc"].dataType.simpleString()

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast = zstandard.ZstdCompressor(level=1)
        for b in _text.parts(batches):
            texts = [None if t is None else fast.compress(t) for t in b.column(3).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(texts, pa.binary())], names=["doc", "k1", "k2", "text"])

    return keyed.mapInArrow(press, f"doc {kind}, k1 long, k2 long, text binary").repartition(partitions, "k1", "k2").join(spans, ["k1", "k2"], "left")


def _unpressed() -> Callable[[bytes | None], bytes | None]:
    back = zstandard.ZstdDecompressor()
    return lambda x: None if x is None else back.decompress(x)


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: a row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.parts(batches):
            total, lost, shas, text_of = [], [], [], _unpressed()
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = (text_of(text) or b"").split()
                n = 0
                if spans:
                    gone = lost_words(len(words), spans)
                    n = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                total.append(len(words) + n)
                lost.append(n)
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(shas, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _with_spans(docs.select("doc_id", "text"), window, gram)
    return rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "text", "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut(raw: bytes, spans: list[bytes]) -> bytes:
    """``raw`` without its covered words and the white space behind each."""
    _, start, _ = _text.spans(raw)
    gone = lost_words(len(start), spans)
    upto = np.append(start[1:], len(raw))
    left = [raw[: start[0]] if len(start) else raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8)))
    for a, b in zip(edge[::2], edge[1::2]):
        left.append(raw[start[a] : upto[b - 1]])
    return b"".join(left)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with repeats cut from ``text`` (and ``n_chars`` to match); texts that lose
    nothing stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = _unpressed()
        for b in _text.parts(batches):
            text = [cut(text_of(t), s) if s and t is not None else text_of(t) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.binary()).cast(pa.string())], names=["doc", "kept"])

    rows = _with_spans(docs, window, gram)
    out = rows.select("doc", "text", "spans").mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, kept string")
    cols = {c: F.col("kept") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns}
    if "n_chars" in cols:
        cols["n_chars"] = F.length("kept").cast("long")
    return out.select(*(v.alias(c) for c, v in cols.items()))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))


QUERIES = {"op3_substring_dedup": op3_substring_dedup}

ORACLE_SQL = {
    "op3_substring_dedup": r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(list_slice(w, i, i + 12), ' '))) AS g FROM d WHERE len(w) >= 13),
m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
lost AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM g JOIN m USING (g) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN lost USING (doc_id, k) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM lost GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""
}
