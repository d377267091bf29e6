"""Byte-level BPE: sampling, pre-tokens, merges, encoding, compression."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex as re
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.config import DEFAULT, SPECIAL_TOKENS, PipelineConfig
from textloom.functions.batches import text_slices
from textloom.operators.rows import KEYS, pick, row_keys, running

# Fixed value: the published pattern that cuts text before merging.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = rf"('s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+)"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable,
    else the next free code point from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b], free = chr(free), free + 1
    return [out[b] for b in range(256)]


def sample_by_budget(docs: DataFrame, budgets: DataFrame | int) -> DataFrame:
    """Rows of each source by doc_id while the text before them is under the budget
    (characters); the row that crosses it is included. ``budgets``: source, budget. The null
    source is a source; equal rows count each; only keys and lengths are put in order."""
    keys = docs.select("source", "doc_id", *row_keys(docs), F.coalesce(F.length("text"), F.lit(0)).alias("_chars"))
    rows = running(keys, ["source"], ["doc_id", *KEYS], "_chars")
    if isinstance(budgets, int):
        rows = rows.filter(F.col("_sum") < budgets)
    else:
        most = budgets.select(F.col("source").alias("_s"), "budget")
        rows = rows.join(F.broadcast(most), F.col("source").eqNullSafe(F.col("_s"))).filter(F.col("_sum") < F.col("budget"))  # a row a source
    return pick(docs, rows)


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN))


def word_counts(docs: DataFrame, column: str = "text") -> DataFrame:
    """word, n: pre-tokens of all documents, combined before the shuffle."""
    return docs.select(F.explode(pretokens(F.col(column))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


#: Words of a partition come to the driver in rows of about this many bytes.
WORD_BLOCK = 1 << 20


def word_blocks(counts: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, sizes and counts of the words of ``counts``, a block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 0, WORD_BLOCK):
            words = b.column(0).cast(pa.binary())
            sizes = pc.binary_length(words).to_numpy().astype(np.uint32)
            made = (b"".join(words.to_pylist()), sizes.tobytes(), b.column(1).to_numpy().astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made], names=["flat", "sizes", "counts"])

    blocks = counts.select("word", F.col("n").cast("long").alias("n")).filter("word is not null").mapInArrow(run, "flat binary, sizes binary, counts binary")
    for r in blocks.toLocalIterator():
        yield np.frombuffer(r.flat, np.uint8), np.frombuffer(r.sizes, np.uint32), np.frombuffer(r["counts"], np.int64)


def _grouped(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order in which equal keys meet, where each key begins in it, the keys, and the sum of their weights."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    return order, first, own[first], np.add.reduceat(weight[order], first) if len(first) else np.zeros(0, np.int64)


class _Words:
    """All words as cells of one array, a cell a byte and an empty one before each word.

    ``tok`` holds a token's id in its first cell, NONE in its others and in empty cells;
    ``size`` its number of cells in its first and last one, so that both neighbours of a
    token are found without links. Merging writes in place.
    """

    NONE = 0

    def __init__(self, blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], byte_ids: np.ndarray, vocab_size: int):
        toks, starts, weights, at, longest = [], [], [], 0, 1
        kind = np.uint16 if vocab_size < 1 << 16 else np.uint32
        for flat, sizes, n in blocks:
            ends = np.cumsum(sizes.astype(np.int64) + 1)
            begin = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            tok = np.full(int(ends[-1]) if len(ends) else 0, self.NONE, kind)
            letter = np.ones(len(tok), bool)
            letter[begin] = False
            tok[letter] = byte_ids[flat]
            toks.append(tok)
            starts.append(begin + at)
            weights.append(n)
            at += len(tok)
            longest = max(longest, int(sizes.max(initial=1)))
        self.tok = np.concatenate([*toks, np.full(1, self.NONE, kind)])  # ends with an empty cell
        self.size = np.ones(len(self.tok), np.uint16 if longest < 1 << 16 else np.uint32)
        self.start = np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.uint32 if at < 1 << 32 else np.uint64)
        self.weight = np.concatenate([*weights, np.zeros(0, np.int64)])

    def weights(self, at: np.ndarray) -> np.ndarray:
        return self.weight[np.searchsorted(self.start, at.astype(self.start.dtype), "right") - 1]

    def pairs(self, step: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of tokens that another one follows in their word, and the key of both, by pieces."""
        for lo in range(0, len(self.tok) - 1, step):
            at = lo + np.flatnonzero(self.tok[lo : min(lo + step, len(self.tok) - 1)])
            right = self.tok[at + self.size[at]]
            at, right = at[right != self.NONE], right[right != self.NONE]
            yield at, self.tok[at].astype(np.int64) << 32 | right

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs, their counts, and in how many places each one is."""
        keys, sums, places = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at, key in self.pairs():
            order, first, own, total = _grouped(key, self.weights(at))
            n = np.diff(np.append(first, len(order)))
            order, first, keys, sums = _grouped(np.concatenate((keys, own)), np.concatenate((sums, total)))
            places = np.add.reduceat(np.concatenate((places, n))[order], first) if len(first) else places
        return keys, sums, places

    def merge(self, left: int, right: int, new: int, at: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Makes ``new`` of the pair at those places that still have it, from left to right.
        Returns keys and weights of pairs that went, and places, keys and weights of new ones."""
        tok, size = self.tok, self.size
        at = at[tok[at] == left]
        at = np.sort(at[tok[at + size[at]] == right])
        if left == right and len(at):
            # of a run of equal tokens every other one begins a pair
            i = np.arange(len(at))
            begins = np.concatenate(([True], at[1:] != at[:-1] + size[at[:-1]]))
            at = at[(i - np.maximum.accumulate(np.where(begins, i, 0))) % 2 == 0]
        second = at + size[at]
        after = second + size[second]
        weight, follows = self.weights(at), tok[after]
        before = tok[at - size[at - 1]]
        # what stands between two merged pairs is the left side of the second one
        outer = np.concatenate((at[1:] != after[:-1], [True])) if len(at) else np.zeros(0, bool)
        a, z = before != self.NONE, (follows != self.NONE) & outer
        gone = np.concatenate((before[a].astype(np.int64) << 32 | left, np.int64(right) << 32 | follows[z].astype(np.int64)))
        tok[second] = self.NONE
        tok[at] = new
        whole = (after - at).astype(size.dtype)
        size[at] = whole
        size[after - 1] = whole
        places = np.concatenate((at[a] - size[at[a] - 1], at[z]))
        came = np.concatenate((tok[places[: a.sum()]].astype(np.int64) << 32 | new, np.int64(new) << 32 | follows[z].astype(np.int64)))
        both = np.concatenate((weight[a], weight[z]))
        return (gone, both), (places, came, both)


#: Places of pairs that a round of training remembers, about.
ROUND_PLACES = 1 << 24


def train_merges(counts: DataFrame, vocab_size: int = DEFAULT.vocab_size, min_count: int = 2, most_places: int = ROUND_PLACES) -> list[tuple[str, str]]:
    """Merges in order of rank, until specials, 256 bytes and merges make ``vocab_size``.

    ``counts`` is the word table of a bounded sample; only its words come to the driver, by
    blocks. Of equally frequent pairs the one with the smaller ids goes first.

    A pair is most frequent when the younger of its tokens has just been made; from then on
    it only loses. So a round counts all pairs, remembers the places of the frequent ones, and
    merges while the best pair is at least as frequent as those: no other can be better.
    """
    letters = byte_alphabet()
    ids = {c: i + len(SPECIAL_TOKENS) for i, c in enumerate(sorted(letters))}
    names = {i: c for c, i in ids.items()}
    words = _Words(word_blocks(counts), np.array([ids[c] for c in letters], np.uint16), vocab_size)
    merges: list[tuple[str, str]] = []
    while len(names) + len(SPECIAL_TOKENS) < vocab_size:
        keys, sums, places = words.counts()
        best = int(sums.max(initial=0))
        if best < min_count:
            break
        order = np.argsort(-sums, kind="stable")
        fits = int(np.searchsorted(np.cumsum(places[order]), most_places, "right"))
        least = max(min_count, best // 16, int(sums[order[fits]]) + 1 if fits < len(order) else 0)
        least = min(least, best)
        known = keys[sums >= least]  # sorted, as counts() gives them
        total = dict(zip(known.tolist(), sums[sums >= least].tolist()))
        where: dict[int, list[np.ndarray]] = {k: [] for k in total}
        for at, key in words.pairs():
            own = np.searchsorted(known, key)
            own[own == len(known)] = 0
            hit = np.flatnonzero(known[own] == key)
            order, first, found, _ = _grouped(key[hit], hit)
            for k, part in zip(found.tolist(), np.split(at[hit][order].astype(words.start.dtype), first[1:])):
                where[k].append(part.copy())
        # the most frequent first; an entry whose count has changed since is passed over
        queue = [(-n, k) for k, n in total.items()]
        heapify(queue)
        while len(names) + len(SPECIAL_TOKENS) < vocab_size and queue:
            n, key = heappop(queue)
            if total.get(key) != -n:
                continue
            left, right, new = key >> 32, key & 0xFFFFFFFF, len(names) + len(SPECIAL_TOKENS)
            names[new] = names[left] + names[right]
            merges.append((names[left], names[right]))
            del total[key]
            gone, (places, came, weight) = words.merge(left, right, new, np.concatenate(where.pop(key)).astype(np.int64))
            _, _, found, sums = _grouped(*gone)
            for k, less in zip(found.tolist(), sums.tolist()):
                if k in total:
                    total[k] -= less
                    if total[k] >= least:
                        heappush(queue, (-total[k], k))
                    else:
                        del total[k], where[k]
            order, first, found, sums = _grouped(came, weight)
            ends = np.append(first[1:], len(order))
            for i in np.flatnonzero(sums >= least).tolist():
                k = int(found[i])
                total[k], where[k] = int(sums[i]), [places[order[first[i] : ends[i]]].astype(words.start.dtype)]
                heappush(queue, (-total[k], k))
    return merges


def vocabulary(merges: list[tuple[str, str]]) -> list[str]:
    """Tokens by id: specials, bytes, merges."""
    return [*SPECIAL_TOKENS, *sorted(byte_alphabet()), *(a + b for a, b in merges)]


#: The rank of a pair that doesn't merge.
NO_RANK = np.int32(np.iinfo(np.int32).max)
#: Words up to so many bytes are encoded together; longer ones are rare and go one by one.
WIDTHS = (2, 4, 6, 8, 12, 16, 24, 32, 64)


class Bpe:
    """Encodes by rank with a memory of words; decodes by concatenating bytes."""

    def __init__(self, merges: list[tuple[str, str]], memory: int = 200_000):
        self.letters = byte_alphabet()
        self.bytes = {c: b for b, c in enumerate(self.letters)}
        self.tokens = vocabulary(merges)
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        self.ranks = {m: r for r, m in enumerate(merges)}
        self.byte_ids = np.array([self.ids[c] for c in self.letters], np.int32)
        self.known: dict[str, list[int]] = {}
        self.memory = memory
        self.stored: pa.Array | None = None
        pairs = sorted(((self.ids[a] << 32 | self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items()), key=lambda x: x[0])
        self.pair_keys, self.pair_ranks = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int32)
        self.made = np.zeros(len(merges), np.int32)  # by rank
        self.made[self.pair_ranks] = [p[2] for p in pairs]

    def word(self, word: str) -> list[int]:
        if word not in self.known:
            parts = [self.letters[b] for b in word.encode()]
            while len(parts) > 1:
                rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 60:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(self.known) >= self.memory:
                self.known.clear()
            self.known[word] = [self.ids[p] for p in parts]
        return self.known[word]

    def decode(self, ids: list[int]) -> bytes:
        """Specials are skipped."""
        return bytes(self.bytes[c] for i in ids if i >= len(SPECIAL_TOKENS) for c in self.tokens[i])

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NO_RANK where they don't merge."""
        if not len(self.pair_keys):
            return np.full(left.shape, NO_RANK)
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def same_width(self, tok: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are rows of ``tok`` (bytes' ids), and how many each has: a step merges
        every word's pair of lowest rank, the first of several, and takes a column away."""
        width = tok.shape[1]
        out, n = np.zeros_like(tok), sizes.copy()
        rank = np.full((len(tok), width - 1), NO_RANK)
        inside = np.arange(1, width) < sizes[:, None]
        rank[inside] = self.rank_of(tok[:, :-1][inside], tok[:, 1:][inside])
        row = np.arange(len(tok))
        while len(row):
            each = np.arange(len(row))
            at = rank.argmin(1) if rank.shape[1] else each * 0
            best = rank[each, at] if rank.shape[1] else np.full(len(row), NO_RANK)
            live = best != NO_RANK
            out[row[~live], : tok.shape[1]], n[row[~live]] = tok[~live], sizes[~live]
            row, tok, rank, sizes, at = row[live], tok[live], rank[live], sizes[live] - 1, at[live]
            if not len(row):
                break
            each = each[: len(row)]
            tok[each, at] = self.made[best[live]]
            source = np.arange(tok.shape[1] - 1)
            source = source + (source > at[:, None])
            tok = np.take_along_axis(tok, source, 1)
            rank = np.take_along_axis(rank, source[:, :-1], 1)
            left, right = each[at > 0], each[at + 1 < sizes]
            rank[left, at[left] - 1] = self.rank_of(tok[left, at[left] - 1], tok[left, at[left]])
            rank[right, at[right]] = self.rank_of(tok[right, at[right]], tok[right, at[right] + 1])
            last = each[(at + 1 >= sizes) & (at < rank.shape[1])]
            rank[last, at[last]] = NO_RANK
        return out, n

    def all_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all in order, as word() gives them; words
        are encoded together, by width."""
        words = words.cast(pa.large_binary())
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data, sizes = np.frombuffer(words.buffers()[2] or b"", np.uint8), np.diff(ends)
        n, made = np.zeros(len(words), np.int64), []
        kind = np.searchsorted(WIDTHS, sizes)
        for k, width in enumerate(WIDTHS):
            own = np.flatnonzero((kind == k) & (sizes > 0))
            for part in (own[i : i + 50_000] for i in range(0, len(own), 50_000)):
                inside = np.arange(width) < sizes[part][:, None]
                tok = np.zeros(inside.shape, np.int32)
                tok[inside] = self.byte_ids[data[(ends[part][:, None] + np.arange(width))[inside]]]
                ids, n[part] = self.same_width(tok, sizes[part])
                made.append((part, ids[np.arange(width) < n[part][:, None]]))
        for i in np.flatnonzero(kind == len(WIDTHS)).tolist():
            ids = self.word(words[i].as_py().decode())
            n[i] = len(ids)
            made.append((np.array([i]), np.array(ids, np.int32)))
        first = np.cumsum(n) - n
        out = np.zeros(int(n.sum()), np.int32)
        for part, ids in made:
            many = n[part]
            out[np.repeat(first[part] - (np.cumsum(many) - many), many) + np.arange(len(ids))] = ids
        return n, out

    def encode_lists(self, words: pa.ListArray) -> pa.Array:
        """Ids of each list of words, null as none: a slice's distinct words are encoded, and
        their ids are dealt to where they stand."""
        out = []
        for part, sizes in list_slices(words):
            coded = part.flatten().dictionary_encode()
            n, ids = self.all_words(coded.dictionary)
            at = coded.indices.to_numpy()
            ends = np.concatenate(([0], np.cumsum(n[at])))
            places = np.repeat((np.cumsum(n) - n)[at] - ends[:-1], n[at]) + np.arange(ends[-1])
            offsets = ends[np.concatenate(([0], np.cumsum(sizes)))]
            out.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[places], pa.int32())))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    def decode_lists(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids, null for null; what isn't UTF-8 is replaced as decode() does."""
        if self.stored is None:
            self.stored = pa.array([self.decode([i]) for i in range(len(self.tokens))], pa.binary())
        out = []
        for part, sizes in list_slices(ids):
            data = self.stored.take(part.flatten())
            ends = np.frombuffer(data.buffers()[1], np.int32)[: len(data) + 1] if len(data) else np.zeros(1, np.int32)
            offsets = ends[np.concatenate(([0], np.cumsum(sizes)))]
            text = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets.tobytes()), data.buffers()[2]])
            try:
                text = text.cast(pa.string())  # looks at every value
            except pa.ArrowInvalid:
                text = pa.array([x.decode(errors="replace") for x in text.to_pylist()], pa.string())
            out.append(pc.if_else(part.is_valid(), text, pa.scalar(None, pa.string())) if part.null_count else text)
        return pa.concat_arrays(out) if out else pa.array([], pa.string())


def list_slices(lists: pa.ListArray, most: int = 1 << 20) -> Iterator[tuple[pa.ListArray, np.ndarray]]:
    """``lists`` in slices of about ``most`` values, or of one longer list; sizes of the lists."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, start = np.cumsum(sizes), 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
        yield lists.slice(start, stop - start), sizes[start:stop]
        start = stop


def encode_docs(docs: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """``docs`` with ``tokens``; pre-tokens come from the JVM, merging runs by Arrow batches."""
    shared = docs.sparkSession.sparkContext.broadcast(Bpe(merges))  # of the vocabulary's size

    @F.arrow_udf("array<int>")
    def encode(words: pa.Array) -> pa.Array:
        return shared.value.encode_lists(words)

    return docs.withColumn("tokens", encode(pretokens(F.coalesce("text", F.lit("")))))


def decode_docs(df: DataFrame, merges: list[tuple[str, str]], column: str = "tokens") -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Bpe(merges))

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return shared.value.decode_lists(ids)

    return df.withColumn("decoded", decode(F.col(column)))


def tokenizer_json(merges: list[tuple[str, str]]) -> str:
    """The tokenizer in the published JSON format, which other libraries load."""
    special = [{"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} for i, t in enumerate(SPECIAL_TOKENS)]
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    model = {"type": "BPE", "vocab": {t: i for i, t in enumerate(vocabulary(merges))}, "merges": [list(m) for m in merges]}
    return json.dumps({"version": "1.0", "added_tokens": special, "pre_tokenizer": byte_level, "decoder": byte_level, "model": model}, ensure_ascii=False)


def save_tokenizer(spark: SparkSession, merges: list[tuple[str, str]], path: str) -> None:
    """Writes :func:`tokenizer_json` to ``path``, in any store that Spark can write."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(conf).create(at, True)
    try:
        out.write(bytearray(tokenizer_json(merges).encode()))
    finally:
        out.close()


def load_tokenizer(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The merges that :func:`save_tokenizer` wrote to ``path``."""
    model = json.loads(spark.read.text(path, wholetext=True).first().value)["model"]
    return [(m[0], m[1]) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]


#: Texts that a byte-level tokenizer must bring back unchanged.
HARD_TEXTS = ("", "Tabs\tand\r\nline  ends   ", "\x00\x01\x1f\x7f", "".join(map(chr, range(256))), "🏛\ufe0f⚖ буквы 法律", "∫∂ℝ≤α “quoted” ﬁ")


def validate_tokenizer(merges: list[tuple[str, str]], cfg: PipelineConfig = DEFAULT) -> dict[str, bool]:
    """vocab_size: as configured; specials: ids 0 to 6 in order; round_trip: hard texts come
    back unchanged and without an unknown token."""
    bpe, words = Bpe(merges), re.compile(PRETOKEN)
    ids = [[i for w in words.findall(t) for i in bpe.word(w)] for t in HARD_TEXTS]
    same = all(bpe.decode(i).decode() == t for i, t in zip(ids, HARD_TEXTS))
    return {"vocab_size": len(bpe.tokens) == cfg.vocab_size, "specials": tuple(bpe.tokens[: len(SPECIAL_TOKENS)]) == SPECIAL_TOKENS, "round_trip": same and not any(i < len(SPECIAL_TOKENS) for x in ids for i in x)}


def shard_sample(docs: DataFrame, shards: int = 8, each: int = 120) -> DataFrame:
    """The first ``each`` rows by doc_id of up to ``shards`` shards of a source, evenly spread."""
    kinds = docs.select("source", "shard").distinct()
    place = F.dense_rank().over(Window.partitionBy("source").orderBy("shard")) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy("source"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / shards))
    at = kinds.withColumn("at", place).withColumn("n", n).filter((F.col("at") % step == 0) & (F.col("at") / step < shards)).select(F.col("source").alias("_s"), F.col("shard").alias("_sh"))
    own = docs.join(F.broadcast(at), F.col("source").eqNullSafe(F.col("_s")) & F.col("shard").eqNullSafe(F.col("_sh"))).drop("_s", "_sh")  # at most ``shards`` rows a source
    first = F.row_number().over(Window.partitionBy("source", "shard").orderBy("doc_id"))
    return own.withColumn("_rn", first).filter(F.col("_rn") <= each).drop("_rn")


def compression_of_ids(docs: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """:func:`compression_by_source` in token ids, over a sample of each source's shards.
    Columns needed: source, shard, doc_id, text."""
    coded = encode_docs(shard_sample(docs), merges)
    return compression_by_source(coded.select("source", F.length(F.coalesce("text", F.lit(""))).alias("chars"), F.size("tokens").alias("tokens")))


def compression_by_source(counted: DataFrame) -> DataFrame:
    """source, chars, tokens, chars_per_token; columns needed: source, chars, tokens."""
    by = counted.groupBy("source").agg(F.sum("chars").alias("chars"), F.sum("tokens").alias("tokens"))
    return by.withColumn("chars_per_token", F.round(F.col("chars") / F.col("tokens"), 6))


def compression_weighted(by_source: DataFrame) -> DataFrame:
    """weighted (all characters over the sum of each source's characters by its ratio),
    the pooled ratio, and the implied number of tokens."""
    implied = F.sum(F.col("chars") / F.col("chars_per_token"))
    return by_source.agg(F.round(F.sum("chars") / implied, 4).alias("weighted"), F.round(F.sum("chars") / F.sum("tokens"), 4).alias("pooled"), F.round(implied).cast("long").alias("implied_tokens"))
