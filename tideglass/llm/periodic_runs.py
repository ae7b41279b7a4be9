"""Runs of periodic words, found by catching squares with blocks of power-of-two sizes.

A run is a stretch of consecutive words with smallest period ``q`` that is ``q`` words or more longer
than it is wide: words ``q`` apart are the same throughout, and no neighbouring word keeps it so.

Each completed block of ``L`` words, for ``L`` a power of two, gets a catcher. As words are appended the
catcher compares the last ``L`` words with its block; when they agree, ``q`` words after the block, a
square of period ``q`` may be under way. A catcher is in charge of periods from ``L`` to ``2 L`` (all
smaller ones too at the first level), so it rests once ``3 L`` words have come after its block's start,
and every run of at least three periods holds a block whose catcher sees it. Catches of neighbouring
blocks with one period are one stretch, which is then extended to both sides as far as words ``q`` apart
agree (by binary search over common prefixes and suffixes); stretches of two periods and more are
squares that merge into one run. Catches inside a known run of a shorter period are multiples of
that period and are dropped, by the periodicity lemma.

What appending word by word reports does not depend on how many words come at a time, so here all words
of a step of texts are appended at once and each level's catchers are moved on together: ``n``
comparisons of 64-bit window hashes per level, no matter how periodic the text is. A text longer than a
step is gone through in pieces; a few numbers per word are kept of it.

A null or empty text has no words and no runs. Repeated rows have equal results, extra columns pass
through whatever they are called, and an empty table gives an empty table with the new column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import SPACED, mix, span_hash, text_bytes, word_spans
from tideglass.llm.common import with_text_column

_U = np.uint64
_BASE = 0x9FB21C651E98DF25  # odd, so that it has an inverse modulo 2**64
#: Window hashes that are worked on at once, about.
WINDOW_STEP = 1 << 18
_LOW_BITS = 12


def _table(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Prefixes:
    """Sums over prefixes, from which the hash of any stretch of words is taken."""

    def __init__(self, words: np.ndarray):
        n = self.size = len(words)
        inverse = pow(_BASE, -1, 1 << 64)
        low, high = 1 << _LOW_BITS, (n >> _LOW_BITS) + 2
        self.down_low = _table(inverse, low)
        self.down_high = _table(pow(inverse, low, 1 << 64), high)
        up = _table(_BASE, low)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        factor = 1
        for at in range(0, n, low):
            part = words[at : at + low]
            self.sums[at + 1 : at + 1 + len(part)] = np.cumsum(part * up[: len(part)]) * _U(factor)
            self.sums[at + 1 : at + 1 + len(part)] += self.sums[at]
            factor = factor * pow(_BASE, low, 1 << 64) % (1 << 64)

    def _down(self, at: np.ndarray) -> np.ndarray:
        return self.down_high[at >> _LOW_BITS] * self.down_low[at & ((1 << _LOW_BITS) - 1)]

    def windows(self, start: int, end: int, length: int) -> np.ndarray:
        """Hashes of the windows of ``length`` words that begin from ``start`` to ``end``."""
        a, b = start >> _LOW_BITS, (max(end, start + 1) - 1 >> _LOW_BITS) + 1
        down = (self.down_high[a:b, None] * self.down_low).ravel()
        down = down[start - (a << _LOW_BITS) :][: end - start]
        return (self.sums[start + length : end + length] - self.sums[start:end]) * down

    def same(self, at: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
        one = (self.sums[at + length] - self.sums[at]) * self._down(at)
        return one == (self.sums[other + length] - self.sums[other]) * self._down(other)

    def after(self, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words from ``at`` on are those from ``other`` on; ``at`` is the smaller one."""
        return self._longest(self.size - other, lambda n, k: self.same(at[k], other[k], n))

    def before(self, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words up to ``at`` are those up to ``other``; ``at`` is the smaller one."""
        return self._longest(at, lambda n, k: self.same(at[k] - n, other[k] - n, n))

    @staticmethod
    def _longest(most: np.ndarray, agree) -> np.ndarray:
        """The greatest length up to ``most`` for which ``agree`` holds, doubling and then halving."""
        found = np.zeros(len(most), dtype=np.int64)
        step, going = 1, np.arange(len(most))
        while len(going):  # found + step agrees for those that go on
            room = found[going] + step <= most[going]
            going = going[room]
            going = going[agree(found[going] + step, going)]
            found[going] += step
            step *= 2
        while step > 1:
            step //= 2
            going = np.flatnonzero(found + step <= most)
            going = going[agree(found[going] + step, going)]
            found[going] += step
        return found


def find_runs(
    words: np.ndarray, least_words: int = 24, least_exponent: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of ``least_words`` and ``least_exponent`` periods and more in
    a sequence of 64-bit numbers, ordered by start and period. ``least_exponent`` is 2 or more."""
    least_words = max(least_words, least_exponent)
    # Of short exponents a period leaves less room for a block, so it needs blocks half as long.
    wide = 1 if least_exponent >= 3 else 2
    size = 1 << (((least_words + 2) // (wide + 2)).bit_length() - 1)
    prefixes = Prefixes(words)
    known = (np.zeros(0, np.int64),) * 3  # start, end, period
    first = True
    while least_exponent * (1 if first else wide * size) <= len(words):
        caught = _catch(prefixes, size, range(0 if first else wide, 2 * wide), known)
        known = _merge(known, _squares(prefixes, size, *caught))
        size, first = 2 * size, False
    start, end, period = known
    kept = end - start >= np.maximum(least_words, least_exponent * period)
    start, end, period = start[kept], end[kept], period[kept]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _catch(prefixes: Prefixes, size: int, rows, known) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and periods of all catches of one level that no known run explains; the period is the
    place of the catch after the block, in blocks (one of ``rows``) and words."""
    start, end, _ = known
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    total = prefixes.size - size + 1  # windows there are
    blocks, periods = [], []
    number = -(-total // size)
    step = max(1, WINDOW_STEP // size)
    for low in range(0, number, step):
        block = np.arange(low, min(low + step, number)) * size
        # To where a run reaches that begins before the block: its period is shorter than the block.
        at = np.searchsorted(start, block, side="right")
        explained = np.where(at > 0, reach[at - 1], 0) if len(reach) else np.zeros(len(block), np.int64)
        open_ = explained < np.minimum(block + (rows[-1] + 2) * size, prefixes.size)
        if not open_.any():
            continue
        own = prefixes.windows(int(block[0]), int(block[-1]) + 1, size)[::size]
        for row in rows:
            a = int(block[0]) + row * size
            b = min(a + len(block) * size, total)
            if a >= b:
                continue
            seen = prefixes.windows(a, b, size)
            which, place = np.divmod(np.arange(b - a), size)
            hit = np.flatnonzero((seen == own[which]) & open_[which])
            which, period = which[hit], row * size + place[hit]
            hit = (period > 0) & (block[which] + period + size > explained[which])
            blocks.append(block[which[hit]])
            periods.append(period[hit])
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(blocks), np.concatenate(periods)


def _squares(prefixes: Prefixes, size: int, block: np.ndarray, period: np.ndarray):
    """Start, end and period of the stretches that the catches belong to, of two periods and more."""
    order = np.lexsort((block, period))
    block, period = block[order], period[order]
    new = np.ones(len(block), dtype=bool)
    new[1:] = (np.diff(period) != 0) | (np.diff(block) != size)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(block)) - 1 if len(head) else head
    period, begin, stop = period[head], block[head], block[tail] + size
    start = begin - prefixes.before(begin, begin + period)
    end = stop + prefixes.after(stop, stop + period) + period
    square = end - start >= 2 * period
    return start[square], end[square], period[square]


def _merge(known, found):
    """All runs once, each with its smallest period: a stretch of two periods that has a smaller one as
    well is the run of that one."""
    start, end, period = (np.concatenate(x) for x in zip(known, found))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    return start[new], end[new], period[new]


def runs_of_texts(column: pa.Array, least_words: int = 24, least_exponent: int = 3) -> pa.Array:
    """For each text the number of words, the runs, and the text without repetitions."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    hashes, lengths, firsts = [], [], []
    for start, end in word_spans(data, offsets, SPACED):
        if len(start):
            a, b = int(start[0]), int(end[-1])
            hashes.append(span_hash(data[a:b], start - a, end - a))
            lengths.append((end - start).astype(np.int32))
            firsts.append(np.searchsorted(offsets, start, side="right") - 1)
    empty = [np.zeros(0, np.uint64)]
    row = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    count = np.bincount(row, minlength=rows)[:rows]
    first = np.concatenate([[0], np.cumsum(count)])
    del row, firsts
    # A number of its own after each text keeps runs from reaching into the next one.
    ends = mix(np.arange(1, rows + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
    words = np.insert(np.concatenate(hashes or empty), first[1:], ends)
    start, length, period = find_runs(words, least_words, least_exponent)
    owner = np.searchsorted(first[1:] + np.arange(rows), start)
    start = start - owner  # places among the words of all texts

    dropped = np.zeros(int(first[-1]) + 1, dtype=np.int32)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = np.cumsum(dropped)[:-1] == 0
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    values = pa.StructArray.from_arrays(
        [pa.array(start - first[owner]), pa.array(length), pa.array(period)], fields=list(run_type)
    )
    bounds = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.array(count.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(bounds), values),
            _joined(data, offsets, first, kept),
        ],
        names=["n_words", "runs", "collapsed"],
    )


def _joined(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    number = np.concatenate([[0], np.cumsum(kept)])
    rows = len(first) - 1
    # No blank follows the last kept word of a text.
    last = np.zeros(len(kept), dtype=bool)
    places = np.flatnonzero(kept)
    full = number[first[1:]] > number[first[:-1]]
    last[places[number[first[1:]][full] - 1]] = True
    parts, sizes, at = [], np.zeros(rows, dtype=np.int64), 0
    for start, end in word_spans(data, offsets, SPACED):
        k = len(start)
        if not k:
            continue
        own, final = kept[at : at + k], last[at : at + k]
        a = int(start[0])
        part = np.append(data[a : int(end[-1])], np.uint8(0x20))
        stop = np.where(final, end, end + 1)[own] - a
        begin = start[own] - a
        mark = np.zeros(len(part) + 1, dtype=np.int8)
        mark[begin] += 1
        np.subtract.at(mark, stop, 1)
        part[stop[~final[own]] - 1] = 0x20
        parts.append(part[np.cumsum(mark[:-1], dtype=np.int8) > 0])
        row = np.searchsorted(first, np.arange(at, at + k)[own], side="right") - 1
        sizes += np.bincount(row, weights=stop - begin, minlength=rows).astype(np.int64)
        at += k
    joined = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    text = pa.LargeStringArray.from_buffers(
        rows, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(joined)
    )
    return text.cast(pa.string())


RESULT = (
    "struct<n_words:bigint, runs:array<struct<start:bigint, length:bigint, period:bigint>>, "
    "collapsed:string>"
)


def periodic_runs(
    documents: DataFrame,
    text: str = "text",
    name: str = "periodic",
    least_words: int = 24,
    least_exponent: int = 3,
) -> DataFrame:
    """``documents`` with a struct ``name``: ``n_words``; ``runs`` (``start``, ``length``, ``period`` in
    words, by start, then period); ``collapsed``, the text whose words go that a run contains after its
    first period, joined by blanks."""

    def make(column: pa.Array) -> pa.Array:
        return runs_of_texts(column, least_words, least_exponent)

    return with_text_column(documents, text, make, name, RESULT)


def collapse(documents: DataFrame, text: str = "text", **limits) -> DataFrame:
    """``documents`` with each run cut down to its first period; texts without runs stay as they are."""
    helper = "collapsed"
    while helper in documents.columns:
        helper += "_"
    found = periodic_runs(documents, text, helper, **limits)
    shorter = F.when(F.size(f"`{helper}`.runs") > 0, F.col(f"`{helper}`.collapsed"))
    return found.withColumn(text, F.coalesce(shorter, F.col(f"`{text}`"))).select(
        *[F.col(f"`{c}`") for c in documents.columns]
    )
