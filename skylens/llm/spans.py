"""Vectorised spans over UTF-8 bytes: words, safe cuts, and 64-bit span hashes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
_CHUNK = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_BASE, 4 * _CHUNK), _powers(_BASE_INV, 4 * _CHUNK)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (in place where possible)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lowered(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with one line feed after each, and where each begins."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return buf, np.concatenate([[0], np.cumsum(sizes)[:-1]])


def words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that aren't white space."""
    inside = np.concatenate([[False], ~_SPACE[buf], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span (ascending, not overlapping), in chunks so that memory stays small."""
    global _POW, _INV
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        low = starts[k]
        last = max(int(np.searchsorted(ends, low + _CHUNK, "right")), k + 1)
        high = int(ends[last - 1])
        if high - low > len(_POW):
            _POW, _INV = _powers(_BASE, high - low), _powers(_BASE_INV, high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[buf[low:high]] * _POW[:high - low], out=sums[1:])
        at, to = starts[k:last] - low, ends[k:last] - low
        out[k:last] = (sums[to] - sums[at]) * _INV[at] + (to - at).astype(np.uint64)
        k = last
    return mix(out)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row slices of at most ``most`` text bytes (one row at least), with their texts as bytes."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0)).astype(np.int64)
        total, k = np.cumsum(sizes), 0
        while k < len(sizes):
            before = total[k - 1] if k else 0
            last = max(int(np.searchsorted(total, before + most, "right")), k + 1)
            yield batch.slice(k, last - k), [t or b"" for t in texts.slice(k, last - k).to_pylist()]
            k = last


class Known:
    """Ids of units encoded before, by unit hash, in sorted arrays; begun anew at ``most`` units."""

    def __init__(self, most: int = 1 << 20):
        self.most = most
        self.clear()

    def clear(self):
        self.keys, self.offsets, self.lengths = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) > self.most:
            self.clear()
        if not len(self.keys):
            return np.arange(len(keys))
        return np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys)

    def add(self, keys: np.ndarray, lengths: np.ndarray, flat: np.ndarray):
        offsets = len(self.flat) + np.cumsum(lengths) - lengths
        keys, offsets, lengths = (np.concatenate(x) for x in ((self.keys, keys), (self.offsets, offsets), (self.lengths, lengths)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.offsets, self.lengths = keys[order], offsets[order], lengths[order]
        self.flat = np.concatenate([self.flat, flat])

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.keys, keys)
        return self.offsets[k], self.lengths[k]


def ragged(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[o:o + n]`` for each offset and length, joined."""
    ends = np.cumsum(lengths)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets - (ends - lengths), lengths)]
