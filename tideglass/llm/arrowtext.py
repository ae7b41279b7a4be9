"""Whole Arrow text batches as numbers: words, their 64-bit hashes, and n-grams, on UTF-8 bytes.

All word classes used here are given by ASCII characters, so a byte table decides what belongs to a
word, and whole batches go through numpy without one Python object per word. Two different words
share a 64-bit hash with a chance of about 1e-17; callers treat equal hashes as equal words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once in a task, about; a single longer text is a step of its own, whose
#: words are found and hashed in pieces.
STEP_BYTES = PIECE_BYTES = (1 << 20) - (1 << 17)

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
_GRAM = _U(0xA24BAED4963EE407)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Table of the bytes that belong to words: all but the given inclusive ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in excluded:
        table[low : high + 1] = False
    return table


#: Fixed values: ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (the latter after
#: lower-casing, so upper-case letters count as letters).
SPACED = byte_class([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_LOWER_VALUE = _BYTE_VALUE[_LOWER]


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _U(_BASE), dtype=np.uint64)
    down = np.full(n, _U(pow(_BASE, -1, 1 << 64)), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    # Those for a step are kept; those for a longer text would stay in a worker's memory for good.
    size = max(1 << 16, 1 << int(n).bit_length())
    return _powers(size) if size <= 1 << 20 else _powers.__wrapped__(n)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and where each text starts in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.zeros(0, np.uint8) if buffer is None else np.frombuffer(buffer, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Functions whose values a worker keeps from one task to the next.
_KEPT: list = []


def kept(function: Callable) -> Callable:
    """``function`` with its last values kept from one task to the next, until the worker gets a task of
    an operator that does not ask for them (``steps``)."""
    cached = lru_cache(maxsize=4)(function)
    _KEPT.append(cached)
    return cached


def steps(
    batches, text: str = "text", limit: int = STEP_BYTES, keeps: Callable | None = None
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each. When a task's batches end, memory
    that was freed goes back to the system, as a worker that waits would keep it. Of what earlier tasks
    have ``kept`` only the values of ``keeps`` stay."""
    idle = [f for f in _KEPT if f is not keeps and f.cache_info().currsize]
    for function in idle:
        function.cache_clear()
    if idle:
        give_back()
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        if len(lengths) == 0:
            continue
        group = np.cumsum(lengths) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(lengths)]):
            yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of words, piece by piece of the bytes; pieces end where words do, so that a very
    long text takes no more memory at once than a step does."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + PIECE_BYTES, n)
        while end < n:  # on to the next byte outside words
            gap = np.flatnonzero(~kind[data[end : end + 4096]])
            end = end + int(gap[0]) if len(gap) else min(end + 4096, n)
            if len(gap):
                break
        inside = kind[data[at:end]]
        before = np.zeros(end - at, dtype=bool)
        before[1:] = inside[:-1]
        edges = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        before[edges] = False  # words begin anew where texts do
        after = np.zeros(end - at, dtype=bool)
        after[:-1] = inside[1:] & before[1:]
        yield at + np.flatnonzero(inside & ~before), at + np.flatnonzero(inside & ~after) + 1
        at = end


class Words:
    """The words of a batch: ``hash`` and ``doc`` (row) per word, ``first`` word of each row."""

    def __init__(self, column: pa.Array, kind: np.ndarray = SPACED, lower: bool = True):
        data, offsets = text_bytes(column)
        self.rows = len(offsets) - 1
        starts, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for start, end in word_spans(data, offsets, kind):
            if len(start):
                a, b = int(start[0]), int(end[-1])
                hashes.append(span_hash(data[a:b], start - a, end - a, lower))
                starts.append(start)
                ends.append(end)
        self.start, self.end = np.concatenate(starts), np.concatenate(ends)
        self.hash = np.concatenate(hashes)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.rows), self.count)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within a row, and the index of their first words."""
        total = len(self.hash)
        if total < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[: total - n + 1] == self.doc[n - 1 :])
        return gram_hash([self.hash[at + k] for k in range(n)]), at


def gram_hash(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each tuple of hashes, by order and number of its parts."""
    out = np.full(len(parts[0]), _U(len(parts)), dtype=np.uint64)
    for part in parts:
        out = out * _GRAM + part
    return mix(out)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte span: a polynomial in a fixed base, taken from running sums."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER_VALUE if lower else _BYTE_VALUE)[data] * up[: len(data)], out=sums[1:])
    value = (sums[end] - sums[start]) * down[start]
    return mix(value + (end - start).astype(np.uint64) * _MULTIPLIER)


def span_hash_in_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """``span_hash`` of spans in order that are short or do not overlap, a piece of the bytes at a time."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    edges = np.flatnonzero(np.diff(start // PIECE_BYTES)) + 1
    parts = []
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(start)]):
        low, high = int(start[a]), int(end[b - 1])
        parts.append(span_hash(data[low:high], start[a:b] - low, end[a:b] - low, lower))
    return np.concatenate(parts)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each row ``i``; 0 for rows without values."""
    rows = len(first) - 1
    owner = np.repeat(np.arange(rows), np.diff(first))
    return np.bincount(owner, weights=values, minlength=rows)[:rows]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all runs ``starts[i], starts[i] + 1, ...`` one after another."""
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - begin, lengths)
