"""Vectorised hashing of the bytes, words and shingles of batches of texts, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from vitrina.llm.common import KEY, map_batches

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BYTE2 = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2 ** 64)
_PLACE = _rng.integers(0, 2 ** 64, 8, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are hashed together: bounds the arrays of a task (a longer document is hashed alone).
CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006
    have = _kept.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, CHUNK + 1), base, np.uint64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if n <= 4 * CHUNK:
            _kept[base] = have
    return have[:n]


class SliceHash:
    """64-bit hashes of slices of one byte array, in constant time each."""

    def __init__(self, b: np.ndarray, table: np.ndarray = _BYTE):
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(table[b] * _powers(_BASE, len(b)), out=self.sums[1:])
        self.back = _powers(_BACK, len(b) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(h + (end - start).astype(np.uint64))


def second_hash(b: np.ndarray) -> SliceHash:
    """Independent of SliceHash(b): the two make 128 bits."""
    return SliceHash(b, _BYTE2)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: list[bytes], width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles: A-Z lower-cased words between white space,
    ``width`` at a time; the whole sequence for fewer words; empty without words."""
    for lo, hi in chunks(texts):
        part = texts[lo:hi]
        b = np.frombuffer(b"\n".join(part).lower() + b"\n", np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in part])
        space = _SPACE[b]
        edge = np.diff(space.astype(np.int8), prepend=1, append=1)
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        w = SliceHash(b)(start, end)
        at = np.searchsorted(start, first)  # of each text's first word
        n = len(w) - width + 1
        if n > 0:
            s = np.zeros(n, np.uint64)
            for j in range(width):
                s += w[j:j + n] * _PLACE[j]
            s = mix(s)
        for k in range(len(part)):
            a, e = at[k], at[k + 1]
            if e - a >= width:
                yield np.unique(s[a:e - width + 1])
            elif e > a:
                yield mix((w[a:e] * _PLACE[:e - a]).sum(keepdims=True) + _PLACE[7:] * (e - a).astype(np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def encoded(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    z = zstandard.ZstdCompressor(level=1)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array([z.compress(t) for t in encoded(batch.column(1))],
                                                                 pa.binary())], names=[KEY, "packed"])


def packed(docs: DataFrame) -> DataFrame:
    """(_doc, packed) of (_doc, text): compressed UTF-8, for shuffles of whole texts. Null as empty."""
    return map_batches(docs.select(KEY, "text"), _pack, f"{KEY} long, packed binary")


def unpacked(column: pa.Array) -> list[bytes]:
    z = zstandard.ZstdDecompressor()
    return [z.decompress(t) if t else b"" for t in column.to_pylist()]
