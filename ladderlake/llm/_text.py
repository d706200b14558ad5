"""Words of Arrow string columns as NumPy arrays: positions and 64-bit fingerprints, without a Python object for each word.

Words are maximal runs of bytes other than space and \\x09-\\x0D. A word's fingerprint is a polynomial over a random odd base
of random 64-bit codes of its bytes, mixed; two different words agree with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240517)
_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE_LOWER = _CODE.copy()
_CODE_LOWER[65:91] = _CODE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, b, np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=np.uint64))
        del _powers[:-2]
    return _powers[0], _powers[1]


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


class Words:
    """start, end: byte positions; doc: row number; h: fingerprints (of the lower-cased word if lower); first: row -> its first word."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool = True) -> None:
        self.buf, self.offs = buf, offs
        inside = ~SPACE[buf]
        before = np.empty(len(buf), bool)
        if len(buf):
            before[0] = False
            before[1:] = inside[:-1]
            before[offs[:-1][offs[:-1] < len(buf)]] = False
        self.start = np.flatnonzero(inside & ~before)
        last = np.empty(len(buf), bool)
        if len(buf):
            last[-1] = True
            last[:-1] = ~inside[1:]
            ends = offs[1:]
            last[ends[ends > 0] - 1] = True
        self.end = np.flatnonzero(inside & last) + 1
        self.first = np.searchsorted(self.start, offs)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offs) - 1), self.n)
        self.h = span_hashes(buf, self.start, self.end, lower)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """Fingerprints of byte spans."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _power_table(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_CODE_LOWER if lower else _CODE)[buf] * power[: len(buf)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def sequence_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of h[i:i+n] for every i; len(h)-n+1 of them."""
    m = max(0, len(h) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out *= np.uint64(_BASE)
        out += h[k : k + m]
    return mix(out)


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about `most` bytes each; a longer text stands alone."""
    n = len(column)
    if not n:
        return
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def within(doc: np.ndarray, n: int) -> np.ndarray:
    """Whether words i and i+n-1 are of one document, for each i that has i+n-1."""
    m = max(0, len(doc) - n + 1)
    return doc[:m] == doc[n - 1 : n - 1 + m]


def distinct_pairs(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (doc, h), sorted by doc and then h."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[keep], h[keep]


def per_doc(f, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """f.reduceat over each document's words; 0 for those without."""
    n = np.diff(first)
    out = np.zeros(len(n), values.dtype)
    full = np.flatnonzero(n)
    if len(full):
        out[full] = f.reduceat(values, first[:-1][full])
    return out
