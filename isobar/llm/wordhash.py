"""Vectorised word and n-gram hashing of Arrow string columns (numpy, inside tasks).

Words are maximal runs of bytes other than space and ``\\x09-\\x0D``. UTF-8 never uses
those bytes inside a character, so the split is the same on code points. Hashes are 64
bits; the seeds are fixed, so every executor gives the same value for the same word.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240607))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SEED, _LENGTH = (np.uint64(x) for x in _RNG.integers(0, 2**63, size=2, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_STEPS = _RNG.integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Words of more bytes are hashed one by one; the others eight bytes at a time, all at once.
_LONG = 128


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of a column of texts: word ``i`` is bytes ``start[i]:end[i]`` of ``data``;
    text ``t`` has the words ``first[t]:first[t + 1]`` and bytes ``bounds[t]:bounds[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` folds A-Z only. Blocks of eight bytes are mixed
        into the hash one after the other, each through the finaliser, so that no algebra of
        the texts carries over to the hashes."""
        data = _LOWER[self.data] if lower else self.data
        size = self.end - self.start
        out = mix(size.astype(np.uint64) * _LENGTH ^ _SEED)
        eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
        words, at = np.flatnonzero(size <= _LONG), 0
        while len(words):
            block = np.ascontiguousarray(eight[self.start[words] + at]).view("<u8").ravel()
            left = np.minimum(size[words] - at, 8).astype(np.uint64)
            block &= np.uint64(2**64 - 1) >> (np.uint64(8) * (np.uint64(8) - left))
            out[words] = mix(out[words] ^ block * _STEPS[at // 8])
            at += 8
            words = words[size[words] > at]
        for i in np.flatnonzero(size > _LONG):
            digest = hashlib.blake2b(data[self.start[i] : self.end[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def split(texts: pa.Array) -> Words:
    """Words of a string column; null counts as empty."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[: bounds[-1]] if raw is not None and len(bounds) else np.empty(0, np.uint8)
    low = int(bounds[0]) if len(bounds) else 0
    data, bounds = data[low:], bounds - low
    word = ~_SPACE[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    cut = bounds[:-1][np.diff(bounds) > 0]  # a text's first byte starts a word, the byte before it ends one
    begins[cut] = word[cut]
    cut = cut[cut > 0]
    ends[cut - 1] = word[cut - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds), bounds)


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n`` words from each position on, and whether all of them are words
    of the same text (``hashes`` and ``first`` as in ``Words``). Another ``salt`` gives
    hashes that are independent of the first ones."""
    size = len(hashes)
    grams = np.zeros(size, dtype=np.uint64)
    whole = np.zeros(size, dtype=bool)
    if size >= n:
        if salt:
            hashes = mix(hashes ^ np.uint64(salt) * _SEED)
        grams[: size - n + 1] = sum((hashes[k : size - n + 1 + k] * _STEPS[k] for k in range(n)), np.uint64(0))
        left = np.repeat(first[1:], np.diff(first)) - np.arange(size)
        whole = left >= n
    return mix(grams), whole


def small_batches(batches, column: str, most_bytes: int = 4 << 20):
    """Slices of record batches with about ``most_bytes`` of ``column`` each (one row at
    least), so that numpy work on them stays within a bounded memory."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most_bytes, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
