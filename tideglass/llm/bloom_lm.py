"""A bigram language model in a log-frequency Bloom filter.

Counts of words and word pairs are quantised by logarithm, and an n-gram of level q is put into a
Bloom filter q times, tagged 1 to q. A worker finds its level by probing tag after tag until one is
absent. Levels become counts again, and a Dirichlet prior smooths pairs with single words:
``P(w | h) = (c(h w) + mu * P(w)) / (c(h) + mu)``, ``P(w) = (c(w) + 1) / (N + V + 1)``.

Counts cover all training texts. Map tasks sum equal n-grams before anything is shuffled, as packed
arrays that are dealt out by ranges of the n-gram's hash; each range makes its own segment of the
filter. The filter grows with the number of distinct n-grams, so it is sent to the workers in waves
of at most ``wave_bytes``; with more than one wave the texts are read once per wave, and levels found
are carried along. (A single segment is a few megabytes by construction.)

The exact count of each word, for the base score, comes from two places: words so frequent that at
most ``HEAD_WORDS`` are, from a broadcast table; all others by a join on the word, which has no hot
keys left.

Words are told apart by 64-bit hashes. A null or empty text is just its end token. Rows are scored
one by one, also if ids repeat or are null; other columns are not looked at, and an empty table gives
no rows. Without any training text, counts are 0. Words of a very long text are hashed in pieces; some
100 bytes per word are held while it is scored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import SPACED, Words, give_back, gram_hash, mix, ragged, row_sums, steps
from tideglass.llm.common import materialize

#: Bits of the filter per entry (each sets five bits of one 64-bit word), and the base of the logarithm.
BITS, BASE = 8, 1.5
#: Strength of the prior, in tokens.
MU = 500.0
#: Words in the broadcast table of exact counts at most; filter bytes sent at once at most.
HEAD_WORDS, WAVE_BYTES = 1 << 20, 96 << 20
#: N-grams (with repeats) that a range of hashes gets, about; distinct ones summed at once in a task.
RANGE_GRAMS, SUM_AT = 2 << 20, 1 << 20

END = np.uint64(0x5851F42D4C957F2D)


class Tokens:
    """Words and an end token of each text: ``hash``, ``first`` token of each row, ``count``."""

    def __init__(self, column: pa.Array):
        words = Words(column, SPACED)
        self.hash = np.full(len(words.hash) + words.rows, END, dtype=np.uint64)
        self.hash[np.arange(len(words.hash)) + words.doc] = words.hash
        self.first = words.first + np.arange(words.rows + 1)
        self.count = words.count + 1

    def single(self) -> np.ndarray:
        return gram_hash([self.hash])

    def pairs(self) -> np.ndarray:
        """Each token with the one before it; the first of a text follows an end token."""
        before = np.empty_like(self.hash)
        before[1:] = self.hash[:-1]
        before[self.first[:-1]] = END
        return gram_hash([before, self.hash])


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts; ``parts`` is emptied, so that it is not held meanwhile."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    parts.clear()
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new], np.add.reduceat(counts, np.flatnonzero(new)) if len(keys) else counts


def _sums(batches, keys_of):
    """Distinct keys and their counts over a task's texts, a few million at a time. The memory goes back to the
    system in the end, as workers wait beside those of the next stage."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in steps(batches):
        for keys in keys_of(Tokens(batch.column("text"))):
            distinct, counts = np.unique(keys, return_counts=True)
            parts.append((distinct, counts.astype(np.int64)))
            size += len(distinct)
        if size > 2 * SUM_AT:
            parts = [_summed(parts)]
            size = len(parts[0][0])
            if size > SUM_AT:
                yield parts.pop()
                size = 0
    if parts:
        yield _summed(parts)
    give_back()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` of all tokens in ``texts``."""

    def run(batches):
        for keys, counts in _sums(batches, lambda t: [t.hash]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int64)), pa.array(counts)], names=["word", "n"]
            )

    partial = texts.mapInArrow(run, "word long, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def level_count(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of its range; 0 for level 0."""
    low, high = BASE ** (levels - 1.0), BASE**levels * 1.0
    return np.where(levels > 0, np.maximum((np.ceil(low) + np.ceil(high) - 1) / 2, 1), 0)


def _pairs_of_bits() -> np.ndarray:
    """64-bit words with two bits set, for each number of twelve bits."""
    x = np.arange(4096, dtype=np.uint64)
    one = np.uint64(1)
    return (one << (x & np.uint64(63))) | (one << (x >> np.uint64(6)))


_TWO = _pairs_of_bits()


def _place(grams: np.ndarray, tag: int, words: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of the filter that a tagged n-gram lies in, and the bits that it sets there: one read
    of memory for each, instead of one for each bit."""
    x = mix(grams + np.uint64((tag * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    twelve = np.uint64(4095)
    bits = _TWO[x & twelve] | _TWO[(x >> np.uint64(12)) & twelve]
    bits |= np.uint64(1) << ((x >> np.uint64(24)) & np.uint64(63))
    # The upper half scaled to the number of words: no division.
    x >>= np.uint64(32)
    x *= words if isinstance(words, np.ndarray) else np.uint64(words)
    x >>= np.uint64(32)
    return x, bits


def build_segment(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """Filter bytes holding each n-gram once for each tag up to its level."""
    levels = level(counts)
    filled = np.zeros(max(1, -(-int(levels.sum()) * BITS // 64)), dtype=np.uint64)
    for tag in range(1, int(levels.max(initial=0)) + 1):
        grams, levels = grams[levels >= tag], levels[levels >= tag]
        place, bits = _place(grams, tag, len(filled))
        np.bitwise_or.at(filled, place, bits)
    return filled.astype("<u8").tobytes()


def probe(
    segments: np.ndarray, grams: np.ndarray, base: np.ndarray | None = None, words: np.ndarray | None = None
) -> np.ndarray:
    """Levels of n-grams, each by the segment of ``words`` 64-bit words that begins at word ``base`` of the bytes,
    0 if it has no words; without these, by the bytes as one segment. All segments are probed at once, tag by tag."""
    filled = segments.view("<u8")
    if base is None or words is None:
        base, words = np.zeros(len(grams), np.uint64), np.full(len(grams), len(filled), np.uint64)
    out = np.zeros(len(grams), dtype=np.uint8)
    alive, tag = np.flatnonzero(words), 1
    if len(alive) < len(grams):
        grams, base, words = grams[alive], base[alive], words[alive]
    while len(alive) and tag < 255:
        place, bits = _place(grams, tag, words)
        place += base
        here = filled[place] & bits == bits
        alive, grams, base, words = alive[here], grams[here], base[here], words[here]
        out[alive] = tag
        tag += 1
    return out


def filter_segments(texts: DataFrame, tokens: int) -> DataFrame:
    """``part`` (range of hashes) and ``bits`` of the filter over the words and pairs of ``texts``,
    which have ``tokens`` tokens."""
    power = _power(tokens)

    def split(batches):
        for keys, counts in _sums(batches, lambda t: [t.single(), t.pairs()]):
            part = _part(keys, power)
            begin = np.flatnonzero(np.diff(part, prepend=-1))
            end = np.append(begin[1:], len(keys))
            edges = np.append(begin, len(keys)).astype(np.int32) * 8
            grams = [None, pa.py_buffer(edges), pa.py_buffer(keys)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[begin]),
                    pa.Array.from_buffers(pa.binary(), len(begin), grams),
                    pa.array([_packed(counts[a:b]) for a, b in zip(begin, end)]),
                ],
                names=["part", "grams", "counts"],
            )

    def merge(key, table):
        parts = [
            (np.frombuffer(g, np.uint64), _unpacked(c))
            for g, c in zip(table["grams"].to_pylist(), table["counts"].to_pylist())
        ]
        bits = build_segment(*_summed(parts))
        give_back()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": [bits]})

    packed = texts.mapInArrow(split, "part long, grams binary, counts binary")
    return packed.groupBy("part").applyInArrow(merge, "part long, bits binary")


def _packed(counts: np.ndarray) -> bytes:
    """Counts in one byte each; those of 255 and more follow in eight."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype("<i8").tobytes() + len(counts).to_bytes(8, "little")


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[-8:], "little")
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[n:-8], "<i8")
    return counts


def _power(tokens: int) -> int:
    """The number of leading bits of a hash that tell its range."""
    return max(0, math.ceil(math.log2(max(1, 2 * tokens / RANGE_GRAMS))))


def _part(grams: np.ndarray, power: int) -> np.ndarray:
    if power == 0:
        return np.zeros(len(grams), dtype=np.int64)
    return (grams >> np.uint64(64 - power)).astype(np.int64)


def _waves(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    waves: list[list[int]] = [[]]
    held = 0
    for part, size in sorted(sizes):
        if waves[-1] and held + size > most:
            waves.append([])
            held = 0
        waves[-1].append(part)
        held += size
    return waves


@dataclass
class Segments:
    """The bytes of a wave's segments one after another: that of range ``i`` has ``words[i]`` 64-bit words from
    word ``base[i]`` on, none if the range is in another wave."""

    bits: np.ndarray
    base: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, parts: list[int], sizes: list[int], bits: bytes, power: int) -> Segments:
        base, words = np.zeros(1 << power, dtype=np.uint64), np.zeros(1 << power, dtype=np.uint64)
        words[parts] = np.asarray(sizes, dtype=np.uint64) >> np.uint64(3)
        base[parts] = np.cumsum(words[parts]) - words[parts]
        return cls(np.frombuffer(bits, np.uint8), base, words)


def _levels(distinct: np.ndarray, power: int, segments: Segments) -> np.ndarray:
    """Levels of n-grams; 0 for those of ranges that are not in ``segments``."""
    part = _part(distinct, power)
    return probe(segments.bits, distinct, segments.base[part], segments.words[part])


def _both_levels(tokens: Tokens, power: int, segments) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Levels of the single words and of the pairs of all tokens; the distinct words, and each token's
    place among them."""
    words, at = np.unique(tokens.hash, return_inverse=True)
    grams = gram_hash([words])
    order = np.argsort(grams)
    single = np.empty(len(words), dtype=np.uint8)
    single[order] = _levels(grams[order], power, segments)
    pairs, place = np.unique(tokens.pairs(), return_inverse=True)
    return single[at], _levels(pairs, power, segments)[place], words, at


def _log_probability(tokens: Tokens, single, pair, total: int, words: int, mu: float) -> np.ndarray:
    counts = level_count(single.astype(np.int64))
    before = np.empty_like(counts)
    before[1:] = counts[:-1]
    end = tokens.first[1:] - 1
    if len(end):
        before[tokens.first[:-1]] = counts[end]  # every text begins after an end token
    both = np.minimum(level_count(pair.astype(np.int64)), before)
    alone = (counts + 1) / (total + words + 1)
    return row_sums(np.log10((both + mu * alone) / (before + mu)), tokens.first)


def score(
    documents: DataFrame,
    train: Column,
    mu: float = MU,
    wave_bytes: int = WAVE_BYTES,
    head_words: int = HEAD_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``n_tokens`` (words and the end), ``n_known``
    (tokens seen in training), ``train_tokens``, ``base_score`` (add-one unigram log10 probability
    by exact counts) and ``score`` (the model's). ``train`` says by ``doc_id`` which rows are learned
    from."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = rows.where(train).select("text")

    counts = materialize(spark, word_counts(texts), "word-counts")
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, words = totals["n"] or 0, totals["v"]
    segments = materialize(spark, filter_segments(texts, total), "filter")
    power = _power(total)
    sizes = segments.select("part", F.octet_length("bits").alias("size")).collect()
    waves = _waves([(r["part"], r["size"]) for r in sizes], wave_bytes)
    least, head = _head(counts, head_words)

    def send(wave: list[int]):
        table = segments.where(F.col("part").isin(wave)).toArrow()
        bits = table["bits"].to_pylist()
        parts, lengths = table["part"].to_pylist(), [len(b) for b in bits]
        del table
        return spark.sparkContext.broadcast((parts, lengths, b"".join(bits)))

    state = rows.withColumn("levels", F.lit(None).cast("binary"))
    for wave in waves[:-1]:
        sent = send(wave)
        state = materialize(
            spark,
            state.mapInArrow(_find(sent, power), f"doc_id {kind}, text string, levels binary"),
            "levels",
        )
        sent.destroy()  # what it was for is written
    state = state.withColumn("row", F.monotonically_increasing_id())
    sent, frequent = send(waves[-1]), spark.sparkContext.broadcast(head)
    last = _finish(sent, frequent, power, total, words, mu)
    scored = materialize(
        spark,
        state.mapInArrow(
            last,
            f"doc_id {kind}, row long, n_tokens long, known long, logs double, score double, rest array<long>",
        ),
        "scored",
    )
    sent.destroy()
    frequent.destroy()
    # Words that are not in the table of frequent ones.
    rest = scored.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(
        F.count(F.lit(1)).alias("times")
    )
    rare = counts.where(F.col("n") < least)
    found = (
        rest.join(rare, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_logs"),
            F.sum("times").alias("rest_known"),
        )
    )
    none = F.lit(0)
    return scored.drop("rest").join(found, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rest_known", none)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (
            F.col("logs")
            + F.coalesce("rest_logs", F.lit(0.0))
            - F.col("n_tokens") * F.lit(math.log10(total + words + 1))
        ).alias("base_score"),
        "score",
    )


def _head(counts: DataFrame, most: int) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """The least count such that at most ``most`` words have it or more (a power of two), and those
    words with their counts, sorted."""
    size = F.floor(F.log2("n")).cast("int").alias("size")
    number = {r["size"]: r["k"] for r in counts.groupBy(size).agg(F.count(F.lit(1)).alias("k")).collect()}
    least, held = 1 << 62, 0
    for size_ in sorted(number, reverse=True):
        held += number[size_]
        if held > most:
            break
        least = 1 << size_
    table = counts.where(F.col("n") >= least).toArrow()
    keys = table["word"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return least, (keys[order], table["n"].to_numpy()[order])


def _carried(batch: pa.RecordBatch, tokens: Tokens, single, pair):
    """Levels found in earlier waves joined with those just found: a byte per token for each order."""
    before = batch.column("levels")
    if before.null_count == len(before):
        return single, pair
    both = np.frombuffer(b"".join(before.to_pylist()), np.uint8)
    start = 2 * tokens.first[:-1]
    return (
        np.maximum(single, both[ragged(start, tokens.count)]),
        np.maximum(pair, both[ragged(start + tokens.count, tokens.count)]),
    )


def _find(sent, power: int):
    def run(batches):
        segments = Segments.of(*sent.value, power)
        for batch in steps(batches):
            tokens = Tokens(batch.column("text"))
            single, pair, _, _ = _both_levels(tokens, power, segments)
            single, pair = _carried(batch, tokens, single, pair)
            spans = [slice(a, b) for a, b in zip(tokens.first[:-1], tokens.first[1:])]
            levels = pa.array([single[s].tobytes() + pair[s].tobytes() for s in spans], pa.binary())
            columns = [batch.column("doc_id"), batch.column("text"), levels]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "levels"])

    return run


def _finish(sent, head, power: int, total: int, words: int, mu: float):
    def run(batches):
        segments = Segments.of(*sent.value, power)
        keys, counts = head.value
        for batch in steps(batches):
            tokens = Tokens(batch.column("text"))
            single, pair, distinct, place = _both_levels(tokens, power, segments)
            single, pair = _carried(batch, tokens, single, pair)
            value = _log_probability(tokens, single, pair, total, words, mu)

            at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
            here = keys[at] == distinct if len(keys) else np.zeros(len(distinct), dtype=bool)
            logs = np.where(here, np.log10((counts[at] if len(keys) else 0) + 1.0), 0.0)[place]
            there = here[place]
            absent = np.concatenate([[0], np.cumsum(~there)])[tokens.first]
            rest = pa.ListArray.from_arrays(
                pa.array(absent.astype(np.int32)), pa.array(tokens.hash[~there].astype(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array(tokens.count.astype(np.int64)),
                    pa.array(row_sums(there, tokens.first).astype(np.int64)),
                    pa.array(row_sums(logs, tokens.first)),
                    pa.array(value),
                    rest,
                ],
                names=["doc_id", "row", "n_tokens", "known", "logs", "score", "rest"],
            )

    return run
