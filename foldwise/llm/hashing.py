"""Vectorised word and shingle hashes over Arrow text columns (numpy, one small chunk at a time).

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D`` after lower-casing A-Z.  Its 64-bit hash
is a polynomial over a random byte table, read off one running sum per chunk, so the cost is a few
array operations per byte whatever the word lengths are.  Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21

_rng = np.random.RandomState(20240607)
_BYTE = _rng.randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LANE = _rng.randint(0, 2**63, 16, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of a 64-bit base, extended on demand to the largest chunk seen."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.values):
            grown = np.full(max(n, 2 * len(self.values)), self.base, np.uint64)
            grown[0] = 1
            self.values = np.cumprod(grown, dtype=np.uint64)
        return self.values[:n]


_UP, _DOWN = Powers(_BASE), Powers(_BASE_INV)


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` of about ``limit`` bytes of text: (slice, bytes, offsets of its texts)."""
    column = batch.column(batch.schema.get_field_index(text)).fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield batch.slice(at, to - at), raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every word of a chunk, in reading order."""
    if len(raw) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[raw]
    before = np.empty(len(raw), bool)
    before[0], before[1:] = True, space[:-1]
    inner = offsets[:-1][(offsets[:-1] < len(raw))]
    before[inner] = True
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = True, space[1:]
    after[inner[inner > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * _UP.upto(len(raw)), out=total[1:])
    h = mix((total[ends] - total[starts]) * _DOWN.upto(len(raw))[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(offsets, starts, "right") - 1


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every run of ``k`` words; a shorter document is one run of its own."""
    if len(h) == 0:
        return h, doc
    m = len(h) - k + 1
    if m > 0:
        total = np.zeros(m, np.uint64)
        for j in range(k):
            total += h[j : j + m] * _LANE[j]
        whole = doc[k - 1 :] == doc[:m]
        runs, owner = mix(total[whole]), doc[:m][whole]
    else:
        runs, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(doc, minlength=n_docs)
    small = np.flatnonzero((count > 0) & (count < k))
    if len(small):
        first = np.concatenate([[0], np.cumsum(count)[:-1]])[small]
        total = count[small].astype(np.uint64) * _LANE[15]
        for j in range(k - 1):
            has = count[small] > j
            total[has] += h[first[has] + j] * _LANE[j]
        runs, owner = np.concatenate([runs, mix(total)]), np.concatenate([owner, small])
    return runs, owner


def distinct_sets(runs: np.ndarray, owner: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, document by document, and the offsets of the documents in them."""
    order = np.lexsort((runs, owner))
    runs, owner = runs[order], owner[order]
    keep = np.ones(len(runs), bool)
    keep[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    runs, owner = runs[keep], owner[keep]
    return runs, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))]).astype(np.int64)
