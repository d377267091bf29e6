"""Shared text helpers: bounded slices of Arrow batches and vectorised word hashes.

Words are maximal runs of bytes other than space and 0x09-0x0D, as
``bytes.split()`` gives them; only A-Z are ever lower-cased (``bytes.lower()``).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: An odd 64-bit multiplier, its inverse modulo 2**64, and two odd mixing constants.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 1 << 20:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(27))
    h = h * MIX_B
    return h ^ (h >> np.uint64(31))


#: Bytes that are no ASCII letter or digit and not part of a longer code point.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def spans(raw: bytes, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as an array, and where words start and end; ``apart`` marks the bytes
    between words."""
    a = np.frombuffer(raw, np.uint8)
    word = np.empty(len(a) + 2, np.int8)
    word[0] = word[-1] = 0
    np.logical_not(apart[a], out=word[1:-1].view(bool))
    d = np.diff(word)
    return a, np.flatnonzero(d == 1), np.flatnonzero(d == -1)


#: What is left of eight bytes read where a word of 0 to 8 bytes starts.
_OWN = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order; equal words have equal hashes.

    Words of up to 8 bytes are numbers, so those of one length never share a hash; longer
    ones are hashed by XXH64.
    """
    _, start, end = spans(raw)
    n = end - start
    eight = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))
    short = np.minimum(n, 8)
    h = mix(mix((eight[start] & _OWN[short])) + n.astype(np.uint64))
    long = np.flatnonzero(n > 8)
    digest = xxhash.xxh64_intdigest
    h[long] = np.fromiter((digest(raw[a:b]) for a, b in zip(start[long].tolist(), end[long].tolist())), np.uint64, len(long))
    return h


def parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time, so that Python objects are made for those only;
    memory of a finished batch goes back to the system."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
        del batch
        pa.default_memory_pool().release_unused()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def give_back() -> None:
    """Memory of what was dropped goes back to the system, from Arrow's pool and the C heap."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Cuts batches (with a ``text`` column) so that a slice holds about ``most_bytes``
    of text, or one longer document."""
    for batch in batches:
        text = batch.column(batch.schema.names.index("text"))
        if not batch.num_rows:
            continue
        sizes = np.array([0 if x is None else x for x in pc.binary_length(text).to_pylist()], np.int64)
        upto, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + most_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and each text's number of words."""
    raw = b"\n".join(texts)
    a, start, _ = spans(raw)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    return word_hashes(raw), counts
