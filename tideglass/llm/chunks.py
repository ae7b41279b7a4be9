"""Tokenizer work on chunks that a text can be cut into without changing its tokens.

A text is cut before a blank that follows a visible character, and for byte-level BPE, whose words
hold letters only, also before a sign that follows a letter. Neither vocabulary used here has a
token that reaches over such a place, so the tokens of a text are those of its chunks in order. That
bounds what a tokenizer sees of a long text, and lets equal chunks of a batch be encoded once.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

from tideglass.llm.arrowtext import ragged, span_hash, text_bytes


def _bytes(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[m if isinstance(m, int) else ord(m) for m in members]] = True
    return table


#: Before which bytes a text is cut after a visible character, and before which after
#: an ASCII letter, by kind of vocabulary. (No ``|``: it is part of a special token's string.)
PIECES = (_bytes([0x20]), None)
BYTE_LEVEL = (_bytes([0x20, 0x0A]), _bytes("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"))
_LETTER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def cut_points(data: np.ndarray, offsets: np.ndarray, cuts) -> np.ndarray:
    """Starts of chunks: starts of non-empty texts, blanks after a character that is surely visible
    (printable ASCII, or a two-byte letter from U+00C0 on), and perhaps signs after letters.
    Elsewhere nothing is cut, which makes chunks longer but never wrong."""
    n = len(data)
    start = np.zeros(n + 1, dtype=bool)
    if n > 1:
        blanks, signs = cuts
        before = data[:-1]
        seen = (before > 0x20) & (before < 0x7F)
        seen[1:] |= (before[1:] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
        start[1:n] = blanks[data[1:]] & seen
        if signs is not None:
            start[1:n] |= signs[data[1:]] & _LETTER[before]
    start[offsets] = True
    start[n] = False
    return np.flatnonzero(start)


#: Chunks encoded at once: what a library returns of a chunk takes many times the chunk's memory.
ENCODED_AT_ONCE = 4096


class ChunkCache:
    """What ``encode`` gives for each chunk, remembered by its hash within one Python worker.

    ``encode`` takes a list of texts and returns one value each. Memory is bounded by bytes: new and
    used chunks are in one of two generations of about ``most`` bytes, and when the younger is full the
    older is given up, so frequent chunks stay.
    """

    def __init__(self, encode: Callable[[list[str]], list], most: int = 40 << 20):
        self.encode, self.most, self.young, self.old = encode, most, {}, {}
        self.size = 0

    def values(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list, np.ndarray]:
        """Values of the distinct spans, and for each span the place of its value."""
        hashes = span_hash(data, start, end)
        distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        found = list(map(self.young.get, keys))
        absent = []
        for i, value in enumerate(found):
            if value is None:
                found[i] = value = self.old.get(keys[i])
                if value is None:
                    absent.append(i)
                else:
                    self._keep(keys[i], value)
        if absent:
            raw = data.tobytes()
            at = sample[absent]
            spans = list(zip(absent, start[at].tolist(), end[at].tolist()))
            for low in range(0, len(spans), ENCODED_AT_ONCE):
                some = spans[low : low + ENCODED_AT_ONCE]
                texts = [raw[a:b].decode("utf-8") for _, a, b in some]
                for (i, _, _), value in zip(some, self.encode(texts)):
                    found[i] = value
                    self._keep(keys[i], value)
        return found, place

    def _keep(self, key: int, value) -> None:
        # An entry of the table and its key take about 140 bytes beside the value.
        self.size += 140 + sys.getsizeof(value)
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = value


class IdCache:
    """Ids that ``encode`` gives for each chunk, remembered by its hash within one Python worker, in arrays: an entry
    takes 24 bytes and 4 for each id, and no Python object stays.

    ``encode`` takes a list of texts and returns a list of ids for each. New and used chunks are in one of two
    generations of about ``most`` bytes, and when the younger is full the older is given up, so frequent chunks stay.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 24 << 20):
        self.encode, self.most, self.young, self.old = encode, most, _Ids(), _Ids()

    def values(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct spans one after another, their numbers, and for each span its place among them."""
        hashes = span_hash(data, start, end)
        distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        absent = ~self.young.has(distinct)
        again = np.flatnonzero(absent)[self.old.has(distinct[absent])]
        if len(again):
            self.young.add(distinct[again], *self.old.take(distinct[again]))
            absent[again] = False
        at = np.flatnonzero(absent)
        if len(at):
            self.young.add(distinct[at], *self._encoded(data, start[sample[at]], end[sample[at]]))
        ids, sizes = self.young.take(distinct)
        if self.young.nbytes > self.most:
            # What a single long text has filled far beyond is not kept.
            self.old = self.young if self.young.nbytes <= 2 * self.most else _Ids()
            self.young = _Ids()
        return ids, sizes, place

    def _encoded(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        raw = data.tobytes()
        for low in range(0, len(start), ENCODED_AT_ONCE):
            some = slice(low, low + ENCODED_AT_ONCE)
            texts = [raw[a:b].decode("utf-8") for a, b in zip(start[some].tolist(), end[some].tolist())]
            found = self.encode(texts)
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)


class _Ids:
    """Sorted hashes, and where the ids of each begin and how many they are."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.first = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @property
    def nbytes(self) -> int:
        return 24 * len(self.keys) + self.ids.nbytes

    def has(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) == 0:
            return np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys

    def take(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``keys``, which are all here, and their numbers."""
        at = np.searchsorted(self.keys, keys)
        return self.ids[ragged(self.first[at], self.size[at])], self.size[at]

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """``keys`` are sorted and new."""
        first = len(self.ids) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.first = np.insert(self.first, at, first)
        self.size = np.insert(self.size, at, sizes)
        self.ids = np.concatenate([self.ids, ids])


def byte_level_tokenizer(path: str):
    """The tokenizer in a file, which encodes on the core of the task that calls it: each thread of its own
    would hold memory between tasks."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def chunk_spans(column: pa.Array, cuts):
    """Bytes of a text column, chunk starts and ends, and the first chunk of each row."""
    data, offsets = text_bytes(column)
    start = cut_points(data, offsets, cuts)
    end = np.append(start[1:], len(data)) if len(start) else start
    return data, start, end, np.searchsorted(start, offsets)
