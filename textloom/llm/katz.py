"""Katz backoff language model scores.

A trigram model backs off to a bigram and that to a unigram model, which leaves its own
discounted mass to unknown words. Good-Turing discounts hold up to count ``CUT``, by order;
for every context the probabilities of all words sum to one exactly. Where Good-Turing's
ratio is of no use (too few counts of counts) the discount is (r - 1/2) / r; a context
whose counts are all above ``CUT`` gets one more in its total, and that mass goes to the
words it hasn't seen. A text stands behind two marks of its beginning.

Text is read four times and travels as packed arrays. (0) A bounded sample says which
words are frequent; that only decides how things are packed and dealt. (1) Word counts,
dealt by word: each context bucket gets the counts of the words that occur in it, as
numbers in the order of the words' hashes, which the bucket has itself. (2) Bigrams and
trigrams as hashes, dealt by hash: counts of counts, and so the discounts. (3) Trigrams with
the documents they are in, dealt by their middle word. So a bucket holds all trigrams and
bigrams of its contexts: it builds both tables, finds what each context leaves over and
evaluates each token recursively. What it finds is summed by document.

A context word that many tokens follow is dealt into pieces by the word before it. Bigram
counts of such hot words come with the word counts, and what they leave over is added up
from the pieces. Buckets grow in number with the input, not in size; only tokens after one
and the same frequent pair of words stay together.

:func:`write_tables` stores the model as rows of (context, word, probability) and (context,
backoff weight), partitioned by order, and :func:`score_texts` evaluates any texts against
the stored tables, order by order. :func:`score_documents`, for the documents that the model
is of, does both where a bucket's tables are built: storing them as well would go beyond
the disk that op1 may use (README).

Defined cases: null text is empty text, which has the end token only; without training
documents every score and base score is 0 (N = V = 0); null doc_id counts as training;
repeated rows each count and each give a row; other columns are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import _text
from textloom.scratch import forget, release, written
from textloom.sizes import estimated_bytes, pieces, spread

CUT = 5
BUCKET_BYTES = 7 << 20
PACK_BYTES = 6 << 20
#: Bytes sent to a Python worker at once. A bucket is tens of MB of blobs, and what is sent stands
#: in the JVM, in the worker's Arrow pool and as Python objects at the same time.
SENT_BYTES = 4 << 20
#: Words with codes of two bytes, and the bytes of text they are found in.
FREQUENT, SAMPLE_BYTES = 60_000, 32 << 20
#: A context word with more than 1 / (HOT * buckets) of the tokens is dealt in pieces.
HOT = 4
BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_KINDS = [np.dtype(k) for k in ("u1", "u2", "u4", "u8", "i8", "f8")]
_press, _back = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def dump(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (_KINDS.index(a.dtype), len(a)))], np.int64)
    return _press.compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


def load(blob: bytes) -> list[np.ndarray]:
    raw = _back.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head, at, out = np.frombuffer(raw, np.int64, 2 * n, 8), 8 + 16 * n, []
    for kind, size in head.reshape(-1, 2):
        out.append(np.frombuffer(raw, _KINDS[kind], size, at))
        at += out[-1].nbytes
    return out


def small(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint16 if top < 1 << 16 else np.uint32)


def spare(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts as bytes; places and values of those that don't fit."""
    big = np.flatnonzero(counts > 255)
    return np.minimum(counts, 255).astype(np.uint8), small(big), counts[big].astype(np.int64)


def full(counts: np.ndarray, big: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = counts.astype(np.int64)
    out[big] = value
    return out


def steps(sorted_: np.ndarray) -> np.ndarray:
    """Differences of sorted hashes, byte by byte, so that the high bytes are mostly zero."""
    return np.ascontiguousarray(np.diff(sorted_, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).ravel()


def unsteps(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def starts(sorted_: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in sorted arrays."""
    if not len(sorted_):
        return np.zeros(0, np.int64)
    new = sorted_[1:] != sorted_[:-1]
    for m in more:
        new = new | (m[1:] != m[:-1])
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def runs(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(first, n))


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Deals hashes by ranges: parts in order hold hashes in order."""
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _text.mix(_text.mix(a + np.uint64(_text.BASE)) ^ b)


def held_out(remainder: int = 2, of: int = 7):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder, F.lit(False))


@dataclass
class Layout:
    """How things are dealt and packed; no result depends on it."""

    buckets: int
    frequent: np.ndarray  # sorted hashes, FREQUENT + 2 at most
    hot: np.ndarray  # sorted hashes of hot context words
    pieces: np.ndarray  # of each hot word

    def hot_place(self, v: np.ndarray) -> np.ndarray:
        """Place among the hot words, -1 for others."""
        if not len(self.hot):
            return np.full(len(v), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
        return np.where(self.hot[at] == v, at, -1)

    def bucket(self, u: np.ndarray, v: np.ndarray, hot: np.ndarray) -> np.ndarray:
        out = v % np.uint64(self.buckets)
        some = np.flatnonzero(hot >= 0)
        piece = _text.mix(u[some]) % self.pieces[hot[some]].astype(np.uint64)
        out[some] = _text.mix(v[some] + piece) % np.uint64(self.buckets)
        return out.astype(np.uint32)

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two bytes a word, 0 for those that aren't frequent; the hashes of these."""
        at = np.minimum(np.searchsorted(self.frequent, x), len(self.frequent) - 1)
        code = np.where(self.frequent[at] == x, at + 1, 0).astype(np.uint16)
        return code, x[code == 0]

    def words(self, code: np.ndarray, rare: np.ndarray) -> np.ndarray:
        out = self.frequent[np.maximum(code, 1) - 1]
        out[code == 0] = rare
        return out


@dataclass
class Batch:
    """Tokens of about PACK_BYTES of text: the two words before each and itself, the place of
    its document, and for each document its key and whether it teaches."""

    u: np.ndarray
    v: np.ndarray
    w: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    train: np.ndarray


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Columns: k, train, text."""
    held, size, base = [], 0, 0

    def whole() -> Batch:
        out = Batch(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        return out

    for b in _text.slices(batches):
        texts = [t.lower() for t in b.column(2).cast(pa.binary()).to_pylist()]
        words, n = _text.tokens(texts)
        ends = np.cumsum(n + 1)
        w = np.empty(int(ends[-1]), np.uint64)
        last = np.zeros(len(w), bool)
        last[ends - 1] = True
        w[~last], w[last] = words, END
        first = ends - n - 1
        v = np.roll(w, 1)
        v[first] = BEGIN
        u = np.roll(v, 1)
        u[first] = BEGIN
        held.append((u, v, w, (np.repeat(np.arange(len(n)), n + 1) + base).astype(np.uint32), b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)))
        size, base = size + sum(map(len, texts)), base + len(texts)
        if size >= PACK_BYTES:
            size = base = 0
            yield whole()
    if held:
        yield whole()


def layout_of(rows: DataFrame, buckets: int, size: int) -> Layout:
    """From a bounded sample of whole texts; another sample would give the same results."""
    share = min(1.0, SAMPLE_BYTES / max(1, size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            h, n = np.unique(b.v, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    some = rows if share == 1 else rows.sample(share, 5)
    counts = some.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).select("h", "n").toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    hot = n * HOT * buckets > n.sum()
    order = np.argsort(h[hot])
    pieces_ = -(-n[hot] * HOT * buckets // max(1, n.sum()))
    return Layout(buckets, np.unique(np.append(h, (BEGIN, END))), h[hot][order], pieces_[order])


def _keys(h: np.ndarray, bucket: np.ndarray, own: np.ndarray, name: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, blob): each hash with its training count, its name and the buckets it occurs in."""
    order = np.lexsort((bucket, h))
    h, bucket, own, name = h[order], bucket[order], own[order], name[order]
    first = starts(h, bucket)
    n = np.add.reduceat(own.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    h, bucket = h[first], bucket[first]
    word = starts(h)
    many, n = runs(word, len(h)), np.add.reduceat(n, word) if len(word) else n
    begin, h, name = np.cumsum(many) - many, h[word], name[first][word]
    ends = np.searchsorted(part_of(h, parts), np.arange(parts + 1, dtype=np.uint64))
    for p in np.flatnonzero(np.diff(ends)):
        r = slice(ends[p], ends[p + 1])
        yield int(p), dump(steps(h[r]), *spare(n[r]), *spare(many[r]), small(bucket[begin[r.start] : begin[r.stop - 1] + many[r.stop - 1]]), small(name[r]))


class Sums:
    """Places of the numbers that parts of the word table add up to: counts of counts 1..CUT + 1,
    number of words and of tokens, then counts of hot words, then of their bigrams."""

    def __init__(self, hot: int):
        self.total, self.few = slice(CUT + 3, CUT + 3 + hot), slice(CUT + 3 + hot, CUT + 3 + hot * (CUT + 1))
        self.size = self.few.stop


def word_table(rows: DataFrame, lay: Layout) -> DataFrame:
    """bucket, kind, part, blob, at, n. kind 0: training counts of the words of a bucket, 1:
    counts of its bigrams behind hot words, and whether the bucket owns them; both in the
    order of the hashes, by part. bucket -1: parts ``n`` of the sums at places ``at`` (Sums)."""
    parts = lay.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            hot = lay.hot_place(b.v)
            to, own = lay.bucket(b.u, b.v, hot), b.train[b.doc]
            out = [(p, 0, blob) for p, blob in _keys(b.w, to, own, np.zeros(len(to), np.uint8), parts)]
            some = hot >= 0
            out += [(p, 1, blob) for p, blob in _keys(pair_hash(b.v[some], b.w[some]), to[some], own[some], hot[some], parts)]
            p, kind, blob = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=["bucket", "kind", "blob"])

    def merged(blobs: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
        """Hashes, counts, and (bucket, place) of where they occur, in that order."""
        hashes = [unsteps(x[0]) for x in blobs]
        counts = [full(*x[1:4]) for x in blobs]
        h = np.concatenate(hashes)
        word, place = np.unique(h, return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts), minlength=len(word)).astype(np.int64)
        where = np.repeat(place, np.concatenate([full(*x[4:7]) for x in blobs]))
        key = np.unique(np.concatenate([x[7] for x in blobs]).astype(np.uint64) * np.uint64(len(word)) + where.astype(np.uint64))
        return word, total, place, (key // np.uint64(len(word))).astype(np.int64), (key % np.uint64(len(word))).astype(np.int64)

    sums = Sums(len(lay.hot))

    def merge(held: list[tuple[int, bytes]], part: int) -> Iterator[pa.RecordBatch]:
        out, n = [], np.zeros(sums.size, np.int64)
        for k in (0, 1):
            blobs = [load(x) for kind, x in held if kind == k]
            if not blobs:
                continue
            word, total, place, to, w = merged(blobs)
            ends = np.searchsorted(to, np.arange(lay.buckets + 1))
            owner = np.zeros(len(w), np.uint8)
            owner[np.unique(w, return_index=True)[1]] = 1
            for b in np.flatnonzero(np.diff(ends)):
                own = slice(ends[b], ends[b + 1])
                out.append((int(b), k, dump(*spare(total[w[own]]), *([np.packbits(owner[own])] if k else []))))
            low = (total > 0) & (total <= CUT + 1 - k)
            if k == 0:
                at = lay.hot_place(word)
                n[: CUT + 1] = np.bincount(total[low], minlength=CUT + 2)[1:]
                n[CUT + 1 : CUT + 3] = (total > 0).sum(), total.sum()
                n[sums.total][at[at >= 0]] = total[at >= 0]
            else:
                name = np.zeros(len(word), np.int64)
                name[place] = np.concatenate([x[8] for x in blobs])
                n[sums.few] = np.bincount(name[low] * CUT + total[low] - 1, minlength=len(lay.hot) * CUT)
        at = np.flatnonzero(n)
        b, kind, blob = zip(*out) if out else ((), (), ())
        null = [None] * len(out)
        yield pa.RecordBatch.from_arrays([pa.array([*b, -1], pa.int64()), pa.array([*kind, 3], pa.int32()), pa.array([part] * (len(b) + 1), pa.int64()), pa.array([*blob, None], pa.binary()), pa.array([*null, at], pa.list_(pa.int64())), pa.array([*null, n[at]], pa.list_(pa.int64()))], names=["bucket", "kind", "part", "blob", "at", "n"])

    packed = rows.mapInArrow(count, "bucket long, kind int, blob binary")
    return by_bucket(packed, parts, merge, "bucket long, kind int, part long, blob binary, at array<long>, n array<long>", "kind")


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile sends ``SENT_BYTES`` to a worker at once, or one longer row."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(SENT_BYTES, int(before.rstrip("b")))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def by_bucket(packed: DataFrame, partitions: int, done, schema: str, *sort: str) -> DataFrame:
    """Calls ``done`` with all (sort columns, blob) of a bucket, in that order, and its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            cols = [batch.column(batch.schema.names.index(x)).to_pylist() for x in ("bucket", *sort, "blob")]
            for b, *rest in zip(*cols):
                if b != bucket and held:
                    yield from done(held, bucket)
                    held = []
                    _text.give_back()
                bucket = b
                held.append(tuple(rest))
        if held:
            yield from done(held, bucket)
            held = []
            _text.give_back()

    # by number, not by hash: no partition gets several buckets while others have none
    return packed.repartitionById(partitions, F.pmod("bucket", F.lit(partitions)).cast("int")).sortWithinPartitions("bucket", *sort).mapInArrow(run, schema)


def counts_of_counts(rows: DataFrame, parts: int) -> np.ndarray:
    """Two rows, of bigrams and trigrams: how many occur 1..CUT + 1 times in training."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            own = b.train[b.doc]
            u, v, w = b.u[own], b.v[own], b.w[own]
            pair = pair_hash(v, w)
            out = []
            for order, h in ((2, pair), (3, pair_hash(u, pair))):
                h, n = np.unique(h, return_counts=True)
                ends = np.searchsorted(part_of(h, parts), np.arange(parts + 1, dtype=np.uint64))
                out += [(int(p), order, dump(steps(h[ends[p] : ends[p + 1]]), *spare(n[ends[p] : ends[p + 1]]))) for p in np.flatnonzero(np.diff(ends))]
            p, order, blob = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(order, pa.int32()), pa.array(blob, pa.binary())], names=["bucket", "kind", "blob"])

    def count(held: list[tuple[int, bytes]], part: int) -> Iterator[pa.RecordBatch]:
        for order in (2, 3):
            some = [load(x) for k, x in held if k == order]
            if some:
                h, n = np.concatenate([unsteps(x[0]) for x in some]), np.concatenate([full(*x[1:]) for x in some])
                by = np.argsort(h)
                total = np.add.reduceat(n[by], starts(h[by]))
                few = np.bincount(total[total <= CUT + 1], minlength=CUT + 2)[1:]
                yield pa.RecordBatch.from_arrays([pa.array([order], pa.int32()), pa.array([few.tolist()], pa.list_(pa.int64()))], names=["kind", "few"])

    found = by_bucket(rows.mapInArrow(pack, "bucket long, kind int, blob binary"), parts, count, "kind int, few array<long>", "kind")
    out = np.zeros((2, CUT + 1), np.int64)
    for r in found.select("kind", F.posexplode("few").alias("r", "n")).groupBy("kind", "r").agg(F.sum("n").alias("n")).collect():
        out[r.kind - 2, r.r] = r.n
    return out


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discounts for counts 1..CUT from counts of counts 1..CUT + 1."""
    r = np.arange(1, CUT + 1)
    plain = (r - 0.5) / r
    if not (n > 0).all():
        return plain
    cut = (CUT + 1) * n[CUT] / n[0]
    d = ((r + 1) * n[1:] / (r * n[:-1]) - cut) / (1 - cut) if cut < 1 else plain
    return np.where((d > 0) & (d < 1), d, plain)


def discounted(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    return n * np.append(np.insert(d, 0, 1.0), 1.0)[np.minimum(n, CUT + 1)]


class Unigrams:
    """Probabilities of words by their training counts; 0 stands for unknown words."""

    def __init__(self, stats: np.ndarray):
        self.n, self.v, self.total = stats[: CUT + 1], int(stats[-2]), int(stats[-1])
        few = self.n[:CUT].sum() > 0
        self.d = discounts(self.n) if few else np.ones(CUT)
        self.size = max(1, self.total + (0 if few else 1))
        self.unknown = float(((1 - self.d) * np.arange(1, CUT + 1) * self.n[:CUT]).sum() / self.size) if few else 1 / self.size

    def __call__(self, c: np.ndarray) -> np.ndarray:
        p = discounted(c, self.d) / self.size
        p[c == 0] = self.unknown
        return p

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.v + 1))


@dataclass
class Model:
    """What all buckets share; sizes are those of the layout."""

    lay: Layout
    uni: Unigrams
    d: tuple[np.ndarray, np.ndarray]  # discounts of bigrams and trigrams
    hot_total: np.ndarray  # tokens behind each hot word
    hot_few: np.ndarray  # its bigrams with counts 1..CUT


def trigram_blobs(rows: DataFrame, lay: Layout) -> DataFrame:
    """bucket, kind, part, blob. kind 1: the trigrams of a batch in the bucket, with the
    documents (places in the batch, and whether they teach) of each; kind 2: the keys of a
    batch's documents, once a batch. Nothing is stored for each document of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            name = np.array([xxhash.xxh64_intdigest(b.key.tobytes())], np.uint64)
            doc = b.doc * np.uint32(2) + b.train[b.doc].astype(np.uint32)
            to = lay.bucket(b.u, b.v, lay.hot_place(b.v))
            # equal trigrams stand together; what order they have in a context is no matter
            order = np.lexsort((pair_hash(b.u, b.w), b.v, small(to)))
            u, v, w, to, doc = b.u[order], b.v[order], b.w[order], to[order], small(doc[order])
            row = starts(to, v, w, u)
            m = runs(row, len(to))
            u, v, w, to = u[row], v[row], w[row], to[row]
            ends = np.searchsorted(to, np.arange(lay.buckets + 1, dtype=np.uint32))
            at = np.append(row, len(doc))
            out, where = [], np.flatnonzero(np.diff(ends))
            for p in where:
                r = slice(ends[p], ends[p + 1])
                context = starts(v[r])
                out.append(dump(name, *lay.codes(v[r][context]), *spare(runs(context, r.stop - r.start)), *lay.codes(w[r]), *lay.codes(u[r]), *spare(m[r]), doc[at[r.start] : at[r.stop]]))
            out.append(dump(name, b.key))
            yield pa.RecordBatch.from_arrays([pa.array([*where, int(name[0] % np.uint64(lay.buckets))], pa.int64()), pa.array([5] * len(where) + [6], pa.int32()), pa.array([0] * len(out), pa.int64()), pa.array(out, pa.binary())], names=["bucket", "kind", "part", "blob"])

    return rows.mapInArrow(run, "bucket long, kind int, part long, blob binary")


class Bucket:
    """The tables of one bucket and its tokens."""

    def __init__(self, held: list[tuple[int, int, bytes]], model: Model):
        lay, base = model.lay, 0
        u, v, w, m, docs, self.names, self.sizes = [], [], [], [], [], [], []
        for i, (kind, _, blob) in enumerate(held):
            if kind == 5:
                held[i] = (kind, 0, b"")
                name, vc, vr, c0, c1, c2, wc, wr, uc, ur, m0, m1, m2, doc = load(blob)
                v.append(np.repeat(lay.words(vc, vr), full(c0, c1, c2)))
                w.append(lay.words(wc, wr))
                u.append(lay.words(uc, ur))
                m.append(full(m0, m1, m2).astype(np.uint32))
                docs.append(doc.astype(np.uint32) + np.uint32(2 * base))
                self.names.append(name[0])
                self.sizes.append(int(doc.max() >> 1) + 1)
                base += self.sizes[-1]
        # one by one: each is there twice only while it is put together
        u = np.concatenate(u)
        v = np.concatenate(v)
        w = np.concatenate(w)
        m = np.concatenate(m)
        d = np.concatenate(docs)
        del docs, doc
        teach = (d & np.uint32(1)).astype(bool)
        self.doc, self.docs = d >> np.uint32(1), base
        rows = np.repeat(np.arange(len(u), dtype=np.uint32), m)
        own = np.bincount(rows[teach], minlength=len(u)).astype(np.int64)
        del d, m, teach
        # trigrams by context
        order = np.lexsort((w, u, v))
        u = u[order]
        v = v[order]
        w = w[order]
        first = starts(v, u, w)
        self.n3 = np.add.reduceat(own[order], first)
        back = np.empty(len(order), np.uint32)
        back[order] = np.repeat(np.arange(len(first), dtype=np.uint32), runs(first, len(order)))
        self.token = back[rows]
        del rows, own, back, order
        self.u, self.v, self.w = u[first], v[first], w[first]
        del u, v, w, first
        # words
        words, word = np.unique(self.w, return_inverse=True)
        counts = [full(*load(x)) for kind, _, x in held if kind == 0]
        self.c1 = np.concatenate(counts)[word]
        # bigrams
        context = np.cumsum(np.concatenate(([False], self.v[1:] != self.v[:-1]))).astype(np.uint64)
        by = np.argsort((context << np.uint64(32)) | word.astype(np.uint64), kind="stable")
        pair_first = starts(self.v[by], self.w[by])
        self.pair = np.empty(len(by), np.int64)
        self.pair[by] = np.repeat(np.arange(len(pair_first)), runs(pair_first, len(by)))
        self.n2 = np.add.reduceat(self.n3[by], pair_first)
        some = by[pair_first]
        self.v2, self.w2, self.p1 = self.v[some], self.w[some], model.uni(self.c1[some])
        self.hot = lay.hot_place(self.v2)
        self.owned = np.zeros(len(some), bool)
        hot = np.flatnonzero(self.hot >= 0)
        if len(hot):
            sent = [load(x) for kind, _, x in held if kind == 1]
            _, place = np.unique(pair_hash(self.v2[hot], self.w2[hot]), return_inverse=True)
            self.n2[hot] = np.concatenate([full(*x[:3]) for x in sent])[place]
            self.owned[hot] = np.concatenate([np.unpackbits(x[3], count=len(x[0])) for x in sent]).astype(bool)[place]
        self.evaluate(model)

    def evaluate(self, model: Model) -> None:
        """log10 probabilities of all trigrams, by recursion; behind hot words what backs off to
        the unigrams still lacks its context's share (``rest``)."""
        # bigrams: (context, word) and (context) tables
        first = starts(self.v2)
        self.of2 = of = np.repeat(np.arange(len(first)), runs(first, len(self.v2)))
        seen = self.n2 > 0
        total = np.add.reduceat(self.n2, first)
        few = np.stack([np.bincount(of[self.n2 == r], minlength=len(first)) for r in range(1, CUT + 1)])
        self.hot2 = hot = self.hot[first]
        is_hot = hot >= 0
        if is_hot.any():
            total[is_hot], few[:, is_hot] = model.hot_total[hot[is_hot]], model.hot_few[hot[is_hot]].T
        plus = (few.sum(axis=0) == 0) & (total > 0)
        size = np.maximum(total + plus, 1)
        left = 1 - np.bincount(of[seen], weights=self.p1[seen], minlength=len(first))
        left[is_hot] = 1
        r = np.arange(1, CUT + 1)
        mass = (((1 - model.d[0]) * r) @ few + plus) / size
        self.alpha2 = np.where(total > 0, mass / left, 1.0)
        self.p2 = np.where(seen, discounted(self.n2, model.d[0]) / size[of], self.alpha2[of] * self.p1)
        rest2 = ~seen & (is_hot & (total > 0))[of]
        # trigrams
        first = starts(self.v, self.u)
        self.of3 = of = np.repeat(np.arange(len(first)), runs(first, len(self.v)))
        seen = self.n3 > 0
        total = np.add.reduceat(self.n3, first)
        few = np.stack([np.bincount(of[self.n3 == r], minlength=len(first)) for r in range(1, CUT + 1)])
        plus = (few.sum(axis=0) == 0) & (total > 0)
        size = np.maximum(total + plus, 1)
        lower = self.p2[self.pair]
        left = 1 - np.bincount(of[seen], weights=lower[seen], minlength=len(first))
        mass = (((1 - model.d[1]) * r) @ few + plus) / size
        self.alpha3 = np.where(total > 0, mass / left, 1.0)
        self.p3 = np.where(seen, discounted(self.n3, model.d[1]) / size[of], self.alpha3[of] * lower)
        self.rest = np.where(~seen & rest2[self.pair], self.hot[self.pair], -1)

    def scores(self, model: Model) -> bytes:
        """Of the documents of each batch that the bucket has tokens of: place, score, base score,
        known and all tokens; and the places and hot words of tokens that lack a share."""
        add = lambda x: np.bincount(self.doc, weights=x[self.token], minlength=self.docs)
        tokens = np.bincount(self.doc, minlength=self.docs)
        here = np.flatnonzero(tokens)
        batch = np.repeat(np.arange(len(self.names)), self.sizes)[here]
        local = here - (np.cumsum(self.sizes) - self.sizes)[batch]
        lack = np.flatnonzero(self.rest[self.token] >= 0)
        place = np.cumsum(tokens > 0) - 1
        return dump(np.array(self.names, np.uint64), np.bincount(batch, minlength=len(self.names)), small(local), add(np.log10(self.p3))[here], add(model.uni.base(self.c1))[here], small(add(self.c1 > 0)[here].astype(np.int64)), small(tokens[here]), small(place[self.doc[lack]]), small(self.rest[self.token[lack]]))

    def shares(self, hot: int) -> np.ndarray:
        """For each hot word the unigram probability of the words seen behind it that the bucket owns."""
        own = self.owned & (self.n2 > 0)
        return np.bincount(self.hot[own], weights=self.p1[own], minlength=hot)


def finish(blob: bytes, left: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(batch, blob) with place, score, base score, known and all tokens of the documents of
    each batch that the bucket has tokens of. ``left``: log10 of what hot words leave over."""
    names, many, local, score, plain, known, tokens, doc, hot = load(blob)
    score = score - np.bincount(doc, weights=left[hot], minlength=len(score)) if len(doc) else score
    ends = np.cumsum(many)
    for name, a, b in zip(names.tolist(), ends - many, ends):
        yield name, dump(np.array([name], np.uint64), local[a:b], score[a:b], plain[a:b], small(known[a:b]), small(tokens[a:b]))


def _prepared(docs: DataFrame, held) -> tuple[DataFrame, DataFrame]:
    """One key for equal rows (they have equal scores, and their sums are shared out): the rows
    with their ids, and (k, train, text)."""
    held = held_out() if held is None else held
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"), held.alias("held_out"))
    return rows, rows.select("k", (~F.col("held_out")).alias("train"), "text")


def train(plain: DataFrame, buckets: int, size: int) -> tuple[Model, DataFrame]:
    """What all buckets share, and the word table. ``size``: bytes of the input."""
    lay = layout_of(plain, buckets, size)
    few = counts_of_counts(plain, buckets)
    release(plain.sparkSession)
    table = written(word_table(plain, lay), "words")
    release(plain.sparkSession)
    sums = Sums(len(lay.hot))
    n = np.zeros(sums.size, np.int64)
    parts = table.filter("bucket = -1").select(F.explode(F.arrays_zip("at", "n")).alias("x")).groupBy("x.at").agg(F.sum("x.n").alias("n"))
    for r in parts.collect():  # a few numbers for each hot word
        n[r["at"]] = r.n
    hot_total = n[sums.total].copy()
    # the beginning is no token: it has been followed once for each end
    begin = lay.hot_place(np.array([BEGIN]))[0]
    if begin >= 0:
        hot_total[begin] = plain.filter("train").count()
    return Model(lay, Unigrams(n[: CUT + 3]), tuple(discounts(x) for x in few), hot_total, n[sums.few].reshape(-1, CUT)), table


def score_documents(docs: DataFrame, held=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for
    each row of ``docs``. ``held`` is a condition on doc_id: those don't teach."""
    spark = docs.sparkSession
    rows, plain = _prepared(docs, held)
    buckets = pieces(docs, BUCKET_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with small_batches(spark):
        model, table = train(plain, buckets, estimated_bytes(docs))
    shared = spark.sparkContext.broadcast(model)

    def evaluate(held: list[tuple[int, int, bytes]], _: int) -> Iterator[pa.RecordBatch]:
        out = [(6, blob) for kind, _, blob in held if kind == 6]
        if any(kind == 5 for kind, _, _ in held):
            bucket = Bucket(held, shared.value)
            out.append((5, bucket.scores(shared.value)))
            share = bucket.shares(len(shared.value.lay.hot))
            at = np.flatnonzero(share)
            out.append((7, b""))
        none = [None] * (len(out) - 1)
        hot = [[*none, at], [*none, share[at]]] if out[-1][0] == 7 else [[None] * len(out)] * 2
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary()), pa.array(hot[0], pa.list_(pa.int64())), pa.array(hot[1], pa.list_(pa.float64()))], names=["kind", "blob", "at", "share"])

    both = table.filter("bucket >= 0").drop("at", "n").unionByName(trigram_blobs(plain, model.lay))
    with small_batches(spark):
        evaluated = written(by_bucket(both, buckets, evaluate, "kind int, blob binary, at array<long>, share array<double>", "kind", "part"), "evaluated")
    del both
    forget(table)
    release(spark)
    left = np.ones(len(model.lay.hot))
    shares = evaluated.filter("kind = 7").select(F.explode(F.arrays_zip("at", "share")).alias("x")).groupBy("x.at").agg(F.sum("x.share").alias("share"))
    for r in shares.collect():  # a number for each hot word
        left[r["at"]] -= r.share
    left = np.log10(np.maximum(left, 1e-300))
    groups = max(1, buckets // 2)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = list(finish(blob, left)) if kind == 5 else [(int(load(blob)[0][0]), blob)]
                yield pa.RecordBatch.from_arrays([pa.array([name % groups for name, _ in found], pa.int64()), pa.array([kind] * len(found), pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["bucket", "kind", "blob"])

    def total(held: list[tuple[int, bytes]], _: int) -> Iterator[pa.RecordBatch]:
        keys = {int(name[0]): k for name, k in (load(x) for kind, x in held if kind == 6)}
        sums = {name: np.zeros((4, len(k))) for name, k in keys.items()}
        for kind, blob in held:
            if kind == 5:
                name, local, *cols = load(blob)
                for row, c in zip(sums[int(name[0])], cols):
                    row[local] += c
        for name, k in keys.items():
            yield pa.RecordBatch.from_arrays([pa.array(k), *map(pa.array, sums[name])], names=["k", "score", "base_score", "n_known", "n_tokens"])

    parts = by_bucket(evaluated.filter("kind < 7").select("kind", "blob").mapInArrow(final, "bucket long, kind int, blob binary"), groups, total, "k long, score double, base_score double, n_known double, n_tokens double", "kind")
    sums = parts.groupBy("k").agg(*(F.sum(c).alias(c) for c in ("score", "base_score", "n_known", "n_tokens")))
    keyed = rows.select("doc_id", "k", "held_out")
    times = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("times"), F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"))
    whole = lambda c: F.round(F.col(c) / F.col("times")).cast("long").alias(c)
    one = times.join(sums, "k").select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", whole("n_tokens"), whole("n_known"), F.lit(model.uni.total).cast("long").alias("train_tokens"), (F.col("base_score") / F.col("times")).alias("base_score"), (F.col("score") / F.col("times")).alias("score"), "times")
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("copy", "times")


def write_tables(docs: DataFrame, folder: str, held=None) -> None:
    """Stores the model of ``docs`` under ``folder``, partitioned by ``order``: rows with a word
    have its discounted probability ``p`` in the context (u, v), those without the context's
    backoff weight ``p``. Order 1 has no context; its row without a word is of unknown words."""
    spark = docs.sparkSession
    _, plain = _prepared(docs, held)
    buckets = pieces(docs, BUCKET_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with small_batches(spark):
        model, table = train(plain, buckets, estimated_bytes(docs))
    shared = spark.sparkContext.broadcast(model)
    names, kinds = ("order", "u", "v", "w", "p", "hot"), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())

    def rows(held: list[tuple[int, int, bytes]], _: int) -> Iterator[pa.RecordBatch]:
        if not any(kind == 5 for kind, _, _ in held):
            return
        b, out = Bucket(held, shared.value), []
        seen = b.n3 > 0
        out.append((3, b.u[seen], b.v[seen], b.w[seen], b.p3[seen], None))
        first = starts(b.v, b.u)
        some = np.bincount(b.of3[seen], minlength=len(first)) > 0
        out.append((3, b.u[first][some], b.v[first][some], None, b.alpha3[some], None))
        seen = (b.n2 > 0) & ((b.hot < 0) | b.owned)
        out.append((2, None, b.v2[seen], b.w2[seen], b.p2[seen], b.hot[seen]))
        first = starts(b.v2)
        some = np.bincount(b.of2[b.n2 > 0], minlength=len(first)) > 0
        # behind a hot word: what is left over, before it is shared out among words not seen
        out.append((2, None, b.v2[first][some], None, b.alpha2[some], b.hot2[some]))
        known = b.c1 > 0
        w, at = np.unique(b.w[known], return_index=True)
        out.append((1, None, None, w, shared.value.uni(b.c1[known][at]), None))
        for order, *cols in out:
            n = len(cols[3])
            full_ = [np.full(n, order, np.int32), *cols]
            yield pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, k) for c, k in zip(full_, kinds)], names=names)

    both = table.filter("bucket >= 0").drop("at", "n").unionByName(trigram_blobs(plain, model.lay))
    with small_batches(spark):
        found = written(by_bucket(both, buckets, rows, "order int, u long, v long, w long, p double, hot long", "kind", "part"), "ngrams")
    # pieces of a hot word all have its weight, and buckets their words
    once = found.filter("order = 3 or (order = 2 and (hot < 0 or w is not null))").unionByName(found.filter("order = 1 or (order = 2 and hot >= 0 and w is null)").dropDuplicates(["order", "v", "w"]))
    p1 = found.filter("order = 1").select("w", F.col("p").alias("p1")).dropDuplicates(["w"])
    left = found.filter("order = 2 and hot >= 0 and w is not null").join(p1, "w").groupBy("v").agg((1 - F.sum("p1")).alias("left"))
    shared_out = once.join(F.broadcast(left), "v", "left")  # a row for each hot word
    p = F.when(F.col("w").isNull() & (F.col("hot") >= 0), F.col("p") / F.col("left")).otherwise(F.col("p"))
    unknown = spark.createDataFrame([(1, None, None, None, model.uni.unknown)], "order int, u long, v long, w long, p double")
    shared_out.select("order", "u", "v", "w", p.alias("p")).unionByName(unknown).write.mode("overwrite").partitionBy("order").parquet(folder)
    forget(found)


def score_texts(docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` with ``score``: the log10 probability of each text by the stored tables. Tokens
    that an order doesn't have go on to the next lower one with their context's weight."""
    spark = docs.sparkSession
    model = spark.read.parquet(folder)
    words = lambda n, *key: model.filter((F.col("order") == n) & F.col("w").isNotNull()).select(*key, F.col("p").alias("_p"))
    weights = lambda n, *key: model.filter((F.col("order") == n) & F.col("w").isNull()).select(*key, F.col("p").alias("_a"))
    unknown = float(model.filter("order = 1 and w is null").first().p)
    keyed = docs.withColumn("_k", F.xxhash64(F.coalesce("text", F.lit(""))))
    texts = keyed.select(F.col("_k").alias("k"), F.lit(True).alias("train"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["k"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            yield pa.RecordBatch.from_arrays([pa.array(b.key[b.doc]), *(pa.array(x.view(np.int64)) for x in (b.u, b.v, b.w))], names=["k", "u", "v", "w"])

    tokens = texts.mapInArrow(cut, "k long, u long, v long, w long").groupBy("k", "u", "v", "w").agg(F.count(F.lit(1)).alias("n")).withColumn("log", F.lit(0.0))
    done = []
    for n, context in ((3, ("u", "v")), (2, ("v",))):
        met = tokens.join(words(n, *context, "w"), [*context, "w"], "left")
        done.append(met.filter("_p is not null").select("k", (F.col("n") * (F.col("log") + F.log10("_p"))).alias("s")))
        rest = met.filter("_p is null").drop("_p").join(weights(n, *context), list(context), "left")
        tokens = rest.select("k", "u", "v", "w", "n", (F.col("log") + F.coalesce(F.log10("_a"), F.lit(0.0))).alias("log"))
    last = tokens.join(words(1, "w"), "w", "left")
    done.append(last.select("k", (F.col("n") * (F.col("log") + F.log10(F.coalesce("_p", F.lit(unknown))))).alias("s")))
    sums = done[0].union(done[1]).union(done[2]).groupBy("k").agg(F.sum("s").alias("score"))
    return keyed.join(sums, F.col("_k") == F.col("k"), "left").drop("_k", "k")


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))


QUERIES = {"op1_katz": op1_katz}
