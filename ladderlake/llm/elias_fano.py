"""Elias-Fano sequences as NumPy arrays: n monotone values below u in about 2 + log2(u / n) bits each, read from mapped memory.

Low bits are packed; high parts are a bit vector of unary gaps with a count of ones for each 64 bits, from which select is a
binary search and a broadword step. All operations take arrays of queries.
"""

from __future__ import annotations

import functools
import json

import numpy as np

U64 = np.uint64
_ONES, _TOPS = U64(0x0101010101010101), U64(0x8080808080808080)
#: Place of the r-th one of each byte, at 8 * byte + r.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.uint8).ravel()


def in_word(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) of each word: sums of ones up to each byte find the byte, a table the place in it."""
    s = x - ((x >> U64(1)) & U64(0x5555555555555555))
    s = (s & U64(0x3333333333333333)) + ((s >> U64(2)) & U64(0x3333333333333333))
    s = ((s + (s >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _ONES
    r = r.astype(U64)
    place = np.bitwise_count(((r * _ONES | _TOPS) - s) & _TOPS).astype(U64) << U64(3)
    before = ((s << U64(8)) >> place) & U64(0xFF)
    return place.astype(np.int64) + _IN_BYTE[((((x >> place) & U64(0xFF)) << U64(3)) + (r - before)).astype(np.int64)]


def trailing(x: np.ndarray) -> np.ndarray:
    """Number of zeros below the lowest one; 64 for 0."""
    return np.bitwise_count((x & (~x + U64(1))) - U64(1)).astype(np.int64)


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays with a header, each aligned to 8 bytes."""
    head, at, parts = {}, 0, []
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        raw = a.tobytes()
        head[name] = [a.dtype.str, len(a), at]
        parts.append(raw + bytes(-len(raw) % 8))
        at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def unpack(buffer) -> dict[str, np.ndarray]:
    """Views of a packed buffer, which may be a map of a file."""
    size = int.from_bytes(buffer[:8], "little")
    head = json.loads(bytes(buffer[8 : 8 + size]))
    return {name: np.frombuffer(buffer, dtype, n, 8 + size + at) for name, (dtype, n, at) in head.items()}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str) -> None:
        self.low, self.high, self.ones, self.shape = (arrays[f"{name}.{x}"] for x in ("low", "high", "ones", "shape"))
        self.n, self.l, self.u = int(self.shape[0]), int(self.shape[1]), int(self.shape[2])
        self.window = np.ndarray(len(self.low) * 8 - 7, U64, self.low.view(np.uint8), 0, 1)  # the eight bytes from each byte on

    @functools.cached_property
    def zeros(self) -> np.ndarray:
        """Zeros before each 64 bits: only sequences that are searched need them."""
        return np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def encode(values: np.ndarray, u: int, name: str) -> dict[str, np.ndarray]:
        """Arrays of a sequence that is sorted and below u (at most 2**64)."""
        values = values.astype(U64)
        n = len(values)
        bits = max(0, (max(int(u), 1) // max(n, 1)).bit_length() - 1)
        bits = min(bits, 63)
        high = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        words = np.zeros((n + (max(int(u) - 1, 0) >> bits) + 1) // 64 + 1, U64)
        np.bitwise_or.at(words, high >> 6, U64(1) << (high & 63).astype(U64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
        low = np.zeros(n * bits // 64 + 2, U64)
        if bits and n:
            v = values & U64((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            w, off = at >> 6, (at & 63).astype(U64)
            np.bitwise_or.at(low, w, v << off)
            over = np.flatnonzero(off.astype(np.int64) + bits > 64)
            np.bitwise_or.at(low, w[over] + 1, v[over] >> (U64(64) - off[over]))
        return {f"{name}.low": low, f"{name}.high": words, f"{name}.ones": ones, f"{name}.shape": np.array([n, bits, max(int(u) - 1, 0)], U64)}

    def _select(self, counts: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(counts, k, "right") - 1
        x = self.high[word]
        return word * 64 + in_word(~x if flip else x, k - counts[word])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), U64)
        at = i * self.l
        if self.l <= 57:  # eight bytes from any place hold it
            return (self.window[at >> 3] >> (at & 7).astype(U64)) & U64((1 << self.l) - 1)
        w, off = at >> 6, (at & 63).astype(U64)
        x = self.low[w] >> off
        return (x | np.where(off > 0, self.low[w + 1] << ((U64(64) - off) & U64(63)), U64(0))) & U64((1 << self.l) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values number i."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, U64)
        return ((self._select(self.ones, i, False) - i).astype(U64) << U64(self.l)) | self._low(i)

    def pair(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values number i and i + 1: the second one is mostly found in the word of the first."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, U64), np.zeros(0, U64)
        at = self._select(self.ones, i, False)
        rest = (self.high[at >> 6] >> (at & 63).astype(U64)) >> U64(1)
        after = at + 1 + trailing(rest)
        far = np.flatnonzero(rest == 0)
        after[far] = self._select(self.ones, i[far] + 1, False)
        return ((at - i).astype(U64) << U64(self.l)) | self._low(i), ((after - i - 1).astype(U64) << U64(self.l)) | self._low(i + 1)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Number of the value equal to x, or -1: the successor of x is sought among the values with x's high part, a run of ones behind the zero of the part before."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        live = np.flatnonzero(x <= U64(self.u))
        x = x[live]
        h = (x >> U64(self.l)).astype(np.int64)
        start = np.where(h > 0, self._select(self.zeros, np.maximum(h - 1, 0), True) + 1, 0)
        run = ~(self.high[np.minimum(start >> 6, len(self.high) - 1)] >> (start & 63).astype(U64))
        some = np.flatnonzero((run & U64(1)) == 0)
        live, x, h, start, run = live[some], x[some], h[some], start[some], run[some]
        length = trailing(run)
        over = np.flatnonzero((start & 63) + length >= 64)  # the run may go on in the next word
        begin, end = start - h, start + length - h
        end[over] = self._select(self.zeros, h[over], True) - h[over]
        want = x & U64((1 << self.l) - 1)
        full = np.flatnonzero(begin < end)
        live, begin, end, want = live[full], begin[full], end[full], want[full]
        todo = np.flatnonzero(end - begin > 1)  # of a run of one, that is the only candidate
        lower, upper, sought = begin[todo], end[todo], want[todo]
        while len(todo):
            mid = (lower + upper) >> 1
            above = self._low(mid) > sought
            lower, upper = np.where(above, lower, mid), np.where(above, mid, upper)
            on = upper - lower > 1
            if not on.all():
                begin[todo] = lower
                on = np.flatnonzero(on)
                todo, lower, upper, sought = todo[on], lower[on], upper[on], sought[on]
        ok = np.flatnonzero(self._low(begin) == want)
        out[live[ok]] = begin[ok]
        return out
