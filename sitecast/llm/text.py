"""Helpers on whole columns of text: word hashes, shingles, and Arrow access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
CHUNK_BYTES = 1 << 21
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random multipliers, the same on every machine."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed)
        return mix(steps) | np.uint64(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the number of words before each row.

    Words are runs of bytes other than 0x20 and 0x09-0x0D; with ``fold`` A-Z count
    as a-z.  A word's hash is the sum of its bytes times position multipliers,
    mixed with its length.
    """
    upper = (data >= 65) & (data <= 90)
    lower = np.where(upper, data + np.uint8(32), data) if fold else data
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    at = np.flatnonzero(inside)
    heads = np.flatnonzero(first[at])
    lengths = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    with np.errstate(over="ignore"):
        parts = (lower[at].astype(np.uint64) + np.uint64(1)) * stream(int(lengths.max()), 11)[place]
        return mix(np.add.reduceat(parts, heads) + lengths.astype(np.uint64) * _GOLD), before


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row.

    Shingles are ``size`` words; a row with fewer words is one shingle, a row
    without words (or null) is empty.
    """
    data, offsets = utf8(column)
    weights = stream(size, 23)
    for first, last in chunks(offsets):
        lo, hi = offsets[first], offsets[last]
        words, before = word_hashes(data[lo:hi], offsets[first : last + 1] - lo)
        n = len(words) - size + 1
        with np.errstate(over="ignore"):
            if n > 0:
                grams = words[:n] * weights[0]
                for k in range(1, size):
                    grams += words[k : n + k] * weights[k]
                grams = mix(grams)
            for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
                if b - a >= size:
                    yield np.unique(grams[a : b - size + 1])
                elif b > a:
                    yield mix((words[a:b] * weights[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
                else:
                    yield np.zeros(0, np.uint64)


def digest(tokens: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a sorted set of hashes."""
    with np.errstate(over="ignore"):
        total = mix(tokens * stream(len(tokens), 37)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(tokens))
        return int(mix(total).view(np.int64)[0])


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    ends = np.cumsum([0] + [len(v) for v in values])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
