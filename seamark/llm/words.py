"""Words, lines and their 64-bit hashes over blocks of texts, as numpy arrays.

A block is a run of rows of one Arrow batch with at most ``BLOCK_BYTES`` of text,
or a single longer text. Words are runs without ``[\\x20\\x09-\\x0D]``; as all
separators are ASCII, they are found on the UTF-8 bytes.

The hash of a span is a polynomial in a random odd base over random byte values,
modulo 2**64, passed through a bijective mixer. Spans of different content
share a hash with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BASE = 0x9E6C_63D0_676A_9A99
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUATION = (np.arange(256) & 0xC0) == 0x80
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for blocks of the usual size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, BLOCK_BYTES + 1), base, U)
        full[0] = 1
        have = np.cumprod(full, dtype=U)
        if n <= BLOCK_BYTES + 1:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as one array of 64-bit offsets with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of each block of the column."""
    texts = plain(column)
    n = len(texts)
    if n == 0:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, to, raw[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each row's stretch."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, dtype=np.int64, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


class Hasher:
    """Prefix sums of a block from which any span's hash follows in two lookups."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE_VALUE[data] * powers(BASE, len(data)), dtype=U, out=self.sums[1:])
        self.back = powers(INVERSE, len(data) + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(U))


class Words:
    """Word spans of a block; ``at[i]:at[i + 1]`` are the words of row i."""

    def __init__(self, data: np.ndarray, off: np.ndarray, separator: np.ndarray = SEPARATOR):
        self.data, self.off = data, off
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~separator[data]
        self.inside = inside[1:-1]
        filled = off[:-1] < off[1:]
        first = self.inside & ~inside[:-2]
        first[off[:-1][filled]] = self.inside[off[:-1][filled]]
        last = self.inside & ~inside[2:]
        last[off[1:][filled] - 1] = self.inside[off[1:][filled] - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.at = np.searchsorted(self.start, off)
        self.count = np.diff(self.at)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)


def line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every line, in order; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, breaks, "right") - 1])
    start = np.concatenate([off[:-1], breaks + 1])
    order = np.lexsort([start, row])
    start, row = start[order], row[order]
    last = np.append(row[1:] != row[:-1], True)[: len(row)]
    return start, np.where(last, off[1:][row], np.append(start[1:] - 1, 0)[: len(row)]), row


GRAM = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) * U(2) + U(1)


def grams(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a row, and the offsets of each row's runs."""
    count = np.maximum(np.diff(at) - n + 1, 0)
    to = np.zeros(len(at), np.int64)
    np.cumsum(count, out=to[1:])
    if to[-1] == 0:
        return np.zeros(0, U), to
    whole = len(hashes) - n + 1
    total = hashes[:whole] * GRAM[0]
    for k in range(1, n):
        total += hashes[k : k + whole] * GRAM[k]
    start = np.arange(to[-1]) + np.repeat(at[:-1] - to[:-1], count)
    return mix(total[start]), to


def string_table(columns: dict[str, np.ndarray | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip((columns[f.name] for f in schema), schema)], schema=schema
    )
