"""Bloom filters over 64-bit fingerprints, built by tasks and merged chunk by chunk."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PROBES = 3
CHUNK = 16 << 10
CHUNKS_SCHEMA = "chunk int, once binary, twice binary"


def bits_for(items: float, least: int = 16, most: int = 28) -> int:
    """A power of two of at least 8 bits an item, within the bounds; a fuller filter only lets more rows through."""
    return 1 << min(most, max(least, int(np.ceil(np.log2(max(1.0, 8 * items))))))


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def put(filter_: np.ndarray, h: np.ndarray) -> None:
    p = positions(h, 8 * len(filter_)).ravel()
    np.bitwise_or.at(filter_, p >> 3, (1 << (p & 7)).astype(np.uint8))


def has(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    p = positions(h, 8 * len(filter_))
    return ((filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(axis=1)


class Pair:
    """Two filters: of fingerprints seen once or more, and twice or more."""

    def __init__(self, bits: int) -> None:
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, h: np.ndarray) -> None:
        h, n = np.unique(h, return_counts=True)
        put(self.twice, h[(n > 1) | has(self.once, h)])
        put(self.once, h)

    def chunks(self) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(self.once), CHUNK):
            once, twice = self.once[k : k + CHUNK], self.twice[k : k + CHUNK]
            if once.any():
                yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK], pa.int32()), *(pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in (once, twice))], ["chunk", "once", "twice"])


def merge(chunks: DataFrame, bits: int, what: str = "twice") -> np.ndarray:
    """The filter of all tasks' chunks: seen twice is seen twice by one task, or once by each of two. It comes to the driver: bits / 8 bytes."""

    def merged(key, rows):
        once = twice = None
        for batch in rows if not isinstance(rows, pa.Table) else [rows]:
            for a, b in zip(batch.column("once"), batch.column("twice")):
                a, b = (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in (a, b))
                once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
        out = zlib.compress((once if what == "once" else twice).tobytes(), 1)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "bytes": pa.array([out], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    for r in chunks.groupBy("chunk").applyInArrow(merged, "chunk int, bytes binary").collect():
        got = np.frombuffer(zlib.decompress(r["bytes"]), np.uint8)
        out[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(got)] = got
    return out
