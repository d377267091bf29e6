"""Hashes of words and n-grams in numpy, for Arrow batches."""

from __future__ import annotations

import zlib

import numpy as np

#: Fixed value: the multiplier of the published polynomial hash.
MULTIPLIER = 1000003


def word_hashes(words: list[str]) -> np.ndarray:
    crc = zlib.crc32
    return np.array([crc(w.encode(errors="ignore")) for w in words], np.uint64)


def ngram_hashes(words: list[str], k: int, bits: int = 64) -> np.ndarray:
    """Polynomial hashes modulo 2**bits of all runs of k words, sorted, each once."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    # MULTIPLIER is odd and has an inverse: a run's hash is a difference of running sums of
    # hashes by falling powers, raised again; k words cost what one does
    n = len(words)
    falling, rising = _powers(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word_hashes(words) * falling, dtype=np.uint64)))
    grams = (sums[k:] - sums[: n - k + 1]) * rising[k - 1 :]
    return np.unique(grams & np.uint64((1 << bits) - 1))


_known = np.ones((2, 1), np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers 0 to n - 1 of MULTIPLIER's inverse and of MULTIPLIER, modulo 2**64. Kept for the
    next text unless that was a very long one."""
    global _known
    out = _known
    if out.shape[1] < n:
        size = 1 << (n - 1).bit_length()
        base = np.array([[pow(MULTIPLIER, -1, 1 << 64)], [MULTIPLIER]], np.uint64)
        out = np.concatenate((np.ones((2, 1), np.uint64), np.broadcast_to(base, (2, size - 1))), axis=1)
        out = np.cumprod(out, axis=1, dtype=np.uint64)
        if size <= 1 << 17:
            _known = out
    return out[:, :n]
