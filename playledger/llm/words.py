"""Words of many texts at once, as 64-bit hashes, on the UTF-8 bytes."""

from __future__ import annotations

import hashlib

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer on unsigned 64-bit values (multiply and shift, a bijection)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, long: int = 256) -> np.ndarray:
    """A 64-bit hash per span of bytes: eight bytes at a time, all spans together."""
    hashes = mix(lengths.astype(np.uint64) * _STEP)
    if not len(starts):
        return hashes
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    at = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    rest, todo = lengths, slice(None)
    for k in range(0, min(int(lengths.max()), long), 8):
        if k:
            todo = np.flatnonzero(lengths > k)
            rest = lengths[todo] - k
        word = at[starts[todo] + k] & _LOW_BYTES[np.minimum(rest, 8)]
        hashes[todo] = mix((hashes[todo] ^ word) * _STEP + np.uint64(1))
    for i in np.flatnonzero(lengths > long).tolist():
        tail = data[starts[i] + long : starts[i] + lengths[i]].tobytes()
        hashes[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(tail, digest_size=8).digest(), "little"))
    return hashes


def spans(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and text index of the words: runs of bytes other than ASCII space."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    solid = ~SPACE[data]
    fresh = np.zeros(n + 1, bool)
    fresh[edges[:-1]] = True
    fresh[n] = True
    before = np.concatenate(([True], ~solid[:-1])) | fresh[:-1]
    after = np.concatenate((~solid[1:], [True])) | fresh[1:]
    starts = np.flatnonzero(solid & before)
    lengths = np.flatnonzero(solid & after) + 1 - starts
    return starts, lengths, np.searchsorted(edges, starts, "right") - 1


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every word, A-Z in lower case."""
    starts, lengths, owner = spans(data, edges)
    return span_hashes(LOWER[data], starts, lengths), owner
