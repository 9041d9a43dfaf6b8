"""Texts of an Arrow batch as flat byte arrays, and hashes of their words and character n-grams, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at together.
TOGETHER = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Random values for bytes; fixed by the seed.
_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chunks(column: pa.Array):
    """(first row, bytes, offsets) for stretches of rows with about TOGETHER bytes; offsets begin at 0. Null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + TOGETHER, "right")) - 1)
        yield row, flat[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


class Words:
    """The words of a chunk: start and end (bytes), doc (row within the chunk), place (number within the document), first (per row), hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n, rows = len(data), len(offsets) - 1
        text = ~SPACES[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        starts, ends = text.copy(), text.copy()
        if n:
            starts[1:] &= ~text[:-1] | edge[1:n]
            ends[:-1] &= ~text[1:] | edge[1:n]
        self.data, self.start, self.end = data, np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=rows) if len(self.doc) else np.zeros(rows, np.int64)
        self.first = self.count.cumsum() - self.count
        self.place = np.arange(len(self.doc)) - self.first[self.doc]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial over its bytes' random values, modulo 2^64, finalised with the length."""
        n = len(self.data)
        with np.errstate(over="ignore"):
            power = np.full(n + 1, _ODD, np.uint64)
            back = np.full(n + 1, np.uint64(pow(int(_ODD), -1, 2**64)), np.uint64)
            power[0] = back[0] = 1
            np.multiply.accumulate(power, out=power)
            np.multiply.accumulate(back, out=back)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUES[self.data] * power[:n], out=sums[1:])
            return mixed((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64) * _ODD)


def runs_of(hashes: np.ndarray, k: int, factor: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """A 64-bit hash of each k consecutive elements (also across documents: the caller masks those)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * np.uint64(factor) + hashes[j : j + n]
        return mixed(out)
