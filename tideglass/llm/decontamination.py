"""Benchmark decontamination with suffix arrays over the training texts.

Each task builds suffix arrays over the words of its documents, shard by shard, and binary-searches
every suffix of every test item in them. That gives all verbatim occurrences of test windows and the
longest match of each document with its place. A document lies whole in one shard, so nothing but one
row per document leaves a task and nothing is shuffled.

Words are compared by 64-bit hashes. A suffix whose words leave the vocabulary of the test items
before the shortest window is complete can match no window and is not sorted in.

Test items are sent to the workers in blocks of bounded bytes. With more than one block the documents
are read once per block, and what was found is carried along.

Null or empty texts, and texts without words, have no words and hit nothing. Test items without words
or with a null id are left out; items that repeat an id count once. A null document id is passed
through, and repeated documents are judged one by one.

Extra columns are not looked at, or passed through by ``remove_leaks``; an empty table gives no rows, and
without test items nothing is hit. Words of a very long text are hashed in pieces; what is kept of it is a
few numbers per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import ALPHANUMERIC, Words, ragged, steps
from tideglass.llm.common import materialize

#: Bytes of test items sent to the workers at once.
BLOCK_BYTES = 8 << 20


@dataclass
class TestBlock:
    """Test items as words: sorted vocabulary of hashes, all words as places in it, and per suffix
    its first word, the words up to the item's end, the window length and the item's id."""

    __test__ = False
    vocabulary: np.ndarray
    words: np.ndarray
    start: np.ndarray
    room: np.ndarray
    window: np.ndarray
    item: np.ndarray

    @property
    def shortest(self) -> int:
        return int(self.window.min()) if len(self.window) else 0


def test_block(items: pa.Table, window: int) -> TestBlock:
    """``items``: columns ``item_id`` and ``text``."""
    words = Words(items.column("text"), ALPHANUMERIC)
    vocabulary, place = np.unique(words.hash, return_inverse=True)
    room = words.first[1:][words.doc] - np.arange(len(words.hash))
    size = np.minimum(words.count, window)[words.doc]
    keep = np.flatnonzero(room >= size)
    ids = np.array(items.column("item_id").to_pylist(), dtype=object)
    item = ids[words.doc[keep]] if len(keep) else np.zeros(0, dtype=object)
    return TestBlock(vocabulary, place.astype(np.int64), keep, room[keep], size[keep], item)


@dataclass
class Shard:
    """Words of training texts as places in a test vocabulary: -1 for other words and after each
    text. ``order`` is the suffix array, ``row`` the text of each place."""

    words: np.ndarray
    row: np.ndarray
    order: np.ndarray


def build_shard(words: Words, block: TestBlock) -> Shard:
    slot = np.arange(len(words.hash)) + words.doc
    total = len(words.hash) + words.rows
    place = np.full(total, -1, dtype=np.int64)
    if len(block.vocabulary):
        at = np.searchsorted(block.vocabulary, words.hash)
        at[at == len(block.vocabulary)] = 0
        place[slot] = np.where(block.vocabulary[at] == words.hash, at, -1)
    row = np.repeat(np.arange(words.rows), words.count + 1)
    # Runs of vocabulary words; those shorter than the shortest window cannot hold one.
    known = np.flatnonzero(place >= 0)
    order = known
    if len(known):
        begin = np.ones(len(known), dtype=bool)
        begin[1:] = known[1:] != known[:-1] + 1
        run = np.cumsum(begin) - 1
        order = known[np.bincount(run)[run] >= block.shortest]
    deepest = int(block.room.max()) if len(block.room) else 1
    return Shard(place, row, suffix_array(place, order, deepest))


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` in the order of the suffixes of ``words`` that start there, by their first ``depth``
    words at least: by one word, then by twice as many in each round.

    ``at`` holds whole runs of non-negative words, so what follows a place within its run has a rank
    as well; -1 after a run ranks first. What lies beyond it only orders suffixes that are alike up
    to there."""
    rank = np.zeros(len(words) + 1, dtype=np.int64)
    rank[:-1] = words + 1
    order = at[np.argsort(rank[at], kind="stable")]
    have = 1
    while have < depth and len(order):
        follow = np.minimum(order + have, len(words))
        key = rank[order] * np.int64(int(rank.max()) + 1) + rank[follow]
        sort = np.argsort(key, kind="stable")
        order, key = order[sort], key[sort]
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank = np.zeros(len(words) + 1, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if new.all():
            break
        have *= 2
    return order


def narrow(shard: Shard, low, high, depth: int, wanted) -> tuple[np.ndarray, np.ndarray]:
    """The parts of the intervals ``[low, high)`` of the suffix array whose suffixes have the words
    ``wanted`` at ``depth``, by binary search in all intervals at once."""

    def bound(strict: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while True:
            open_ = a < b
            if not open_.any():
                return a
            middle = (a + b) >> 1
            at = shard.order[np.where(open_, middle, 0)] + depth
            word = shard.words[np.minimum(at, len(shard.words) - 1)]
            right = open_ & ((word <= wanted) if strict else (word < wanted))
            a = np.where(right, middle + 1, a)
            b = np.where(open_ & ~right, middle, b)

    return bound(False), bound(True)


@dataclass
class Matches:
    """``covered``: which places lie in a window's occurrence; ``longest`` match from each place;
    ``row`` and ``item`` of each document and test item that share a window."""

    covered: np.ndarray
    longest: np.ndarray
    row: np.ndarray
    item: np.ndarray


def find(shard: Shard, block: TestBlock) -> Matches:
    total = len(shard.words)
    edge = np.zeros(total + 1, dtype=np.int64)
    longest = np.zeros(total, dtype=np.int64)
    rows, items = [], []
    suffix = np.arange(len(block.start)) if len(shard.order) else np.zeros(0, dtype=np.int64)
    low = np.zeros(len(suffix), dtype=np.int64)
    high = np.full(len(suffix), len(shard.order), dtype=np.int64)
    depth = 0
    while len(suffix):
        low, high = narrow(shard, low, high, depth, block.words[block.start[suffix] + depth])
        depth += 1
        some = low < high
        suffix, low, high = suffix[some], low[some], high[some]
        # Suffixes that begin alike share an interval: each interval's places are listed once.
        done = block.window[suffix] <= depth
        spans, which = np.unique(np.stack([low[done], high[done]]), axis=1, return_inverse=True)
        if spans.size:
            sizes = spans[1] - spans[0]
            places = shard.order[ragged(spans[0], sizes)]
            longest[places] = depth
            full = np.flatnonzero(block.window[suffix][done] == depth)
            if len(full):
                which = which.reshape(-1)
                fresh = np.zeros(len(sizes), dtype=bool)
                fresh[which[full]] = True
                owner = np.repeat(np.arange(len(sizes)), sizes)
                hit = places[fresh[owner]]
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + depth, -1)
                # Each span's rows once, then each of the span's items with them.
                pair = np.unique(owner * np.int64(total + 1) + shard.row[places])
                span, row = pair // (total + 1), pair % (total + 1)
                first = np.searchsorted(span, np.arange(len(sizes) + 1))
                count = np.diff(first)[which[full]]
                rows.append(row[ragged(first[:-1][which[full]], count)])
                items.append(np.repeat(block.item[suffix[done][full]], count))
        more = block.room[suffix] > depth
        suffix, low, high = suffix[more], low[more], high[more]
    return Matches(
        np.cumsum(edge[:-1]) > 0,
        longest,
        np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64),
        np.concatenate(items) if items else np.zeros(0, dtype=object),
    )


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    items = benchmark.select(
        F.col(item_id).alias("item_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).where(F.col("item_id").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for k in range(number):
        yield items.where(part == k).toArrow()


SPAN = "array<struct<start: long, end: long>>"


def _searched(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int,
    text: str,
    item_id: str,
    item_text: str,
    block_bytes: int,
) -> DataFrame:
    """Columns ``_0``, ``_1``, ... of ``documents`` with what was found in each row's text."""
    spark = documents.sparkSession
    state = documents.select(
        *[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(documents.columns)],
        F.col(f"`{text}`").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(SPAN).alias("hits"),
        F.array().cast(f"array<{dict(benchmark.dtypes)[item_id]}>").alias("items"),
        F.lit(0).cast("long").alias("longest"),
        F.lit(-1).cast("long").alias("longest_at"),
    )
    schema = ", ".join(f"{name} {kind}" for name, kind in state.dtypes)
    for k, table in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if k:
            state = materialize(spark, state, "leaks")
        sent = spark.sparkContext.broadcast(test_block(table, window))
        state = state.mapInArrow(_search(sent, k == 0), schema)
    return state


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``n_words``, ``hits`` (word ranges that windows
    of test items cover), ``items`` (ids of those test items, sorted as strings), ``longest`` and
    ``longest_at`` (words of the longest verbatim match, and its first word). A match is counted
    from ``window`` words on, or from all words of a shorter item."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    state = _searched(rows, benchmark, window, "text", item_id, item_text, block_bytes)
    return state.select(
        F.col("_0").alias("doc_id"),
        "n_words",
        "hits",
        F.array_sort(F.col("items").cast("array<string>")).alias("items"),
        "longest",
        "longest_at",
    )


def _search(sent, first: bool):
    def run(batches):
        block = sent.value
        for batch in steps(batches):
            words = Words(batch.column("text"), ALPHANUMERIC)
            shard = build_shard(words, block)
            yield _report(batch, words, shard, find(shard, block), first)

    return run


def _report(batch, words: Words, shard: Shard, found: Matches, first: bool) -> pa.RecordBatch:
    rows = words.rows
    base = words.first[:-1] + np.arange(rows)  # slot of each row's first word
    inside = np.flatnonzero(found.covered)
    hits: list[list] = [[] for _ in range(rows)]
    if len(inside):
        begin = np.ones(len(inside), dtype=bool)
        begin[1:] = inside[1:] != inside[:-1] + 1
        starts = inside[begin]
        ends = inside[np.append(np.flatnonzero(begin)[1:] - 1, len(inside) - 1)] + 1
        for row, a, b in zip(shard.row[starts].tolist(), starts.tolist(), ends.tolist()):
            hits[row].append({"start": a - int(base[row]), "end": b - int(base[row])})
    items: list[set] = [set() for _ in range(rows)]
    for row, item in zip(found.row.tolist(), found.item.tolist()):
        items[row].add(item)
    longest = np.zeros(rows, dtype=np.int64)
    np.maximum.at(longest, shard.row, found.longest)
    longest_at = np.full(rows, -1, dtype=np.int64)
    best = np.flatnonzero((found.longest > 0) & (found.longest == longest[shard.row]))[::-1]
    longest_at[shard.row[best]] = best - base[shard.row[best]]
    if not first:
        hits = [_union(a + b) for a, b in zip(hits, batch.column("hits").to_pylist())]
        items = [a | set(b) for a, b in zip(items, batch.column("items").to_pylist())]
        before = batch.column("longest").to_numpy()
        longest_at = np.where(before >= longest, batch.column("longest_at").to_numpy(), longest_at)
        longest = np.maximum(longest, before)
    new = {
        "n_words": pa.array(words.count.astype(np.int64)),
        "hits": pa.array(hits, type=batch.schema.field("hits").type),
        "items": pa.array([list(x) for x in items], type=batch.schema.field("items").type),
        "longest": pa.array(longest),
        "longest_at": pa.array(longest_at),
    }
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in names], names=names)


def _union(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    return out


def remove_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that share no window with a test item, with their columns."""
    state = _searched(documents, benchmark, window, text, item_id, item_text, block_bytes)
    names = [F.col(f"_{i}").alias(name) for i, name in enumerate(documents.columns)]
    return state.where(F.size("hits") == 0).select(*names)
