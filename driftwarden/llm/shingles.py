"""Word and shingle hashes of a text as numpy arrays."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a shingle.
SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Bytes of text hashed at a time, so that very long texts need no arrays of their own length.
_BLOCK = 1 << 20


def scramble(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), _BASE)]))


def word_hashes(words: list[str]) -> np.ndarray:
    """One 64-bit polynomial hash per word."""
    return joined_hashes(" ".join(words).encode("utf-8", "surrogatepass")) if words else np.zeros(0, np.uint64)


def joined_hashes(data: bytes) -> np.ndarray:
    """The same hashes for words that are already joined by single spaces."""
    out, at = [], 0
    while at < len(data):
        end = len(data) if len(data) - at <= _BLOCK else data.find(b" ", at + _BLOCK)
        end = len(data) if end < 0 else end
        out.append(_block_hashes(np.frombuffer(data[at:end], np.uint8)))
        at = end + 1
    return np.concatenate(out) if len(out) > 1 else out[0]


def _block_hashes(data: np.ndarray) -> np.ndarray:
    spaces = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], spaces + 1])
    lengths = np.diff(np.concatenate([starts, [len(data) + 1]]))
    offsets = np.arange(len(data) + 1) - np.repeat(starts, lengths)
    values = np.concatenate([data, [np.uint8(32)]]).astype(np.uint64) * _powers(int(lengths.max()))[offsets]
    return scramble(np.add.reduceat(values, starts))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; a shorter text is one shingle, an empty one has none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k, p in enumerate(_powers(size + 1)[1:]):
        total += words[k : k + n] * p
    return scramble(total + np.uint64(size))
