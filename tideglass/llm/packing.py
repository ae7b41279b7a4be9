"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

Bins are filled greedily with the longest piece that fits. If a gap is left that no piece fits, the
bin's smallest piece is taken out again and replaced by the two unpacked pieces that fill the widened
gap best, if they leave less of it; of pairs that fill it alike the one whose smaller piece is larger.

Which pieces go together depends only on their lengths, so the plan is made from the number of pieces
of each length: at most ``capacity`` numbers, whatever the size of the corpus. Equal bins are planned
at once as one pattern with a multiplicity. Spark then numbers the pieces of each length (in buckets,
so that a length shared by a third of all pieces is no single task) and places number ``i`` of a
length into the ``i``-th slot that the plan holds for it.

A null or empty text is one piece holding only the end token. Repeated ids and repeated rows are
packed one by one. Columns other than the id and the text are not looked at.

An empty table gives no rows. A very long text is encoded in chunks; its ids are held whole by one task,
4 bytes each.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import kept, ragged, row_sums, steps
from tideglass.llm.chunks import BYTE_LEVEL, IdCache, byte_level_tokenizer, chunk_spans
from tideglass.llm.common import materialize

#: Pieces of one length that meet in one task, about; and the fewest buckets a length is dealt to.
BUCKET_ROWS, LEAST_BUCKETS = 50_000, 256


@kept
def byte_ids(path: str) -> IdCache:
    """Ids of chunks."""
    tokenizer = byte_level_tokenizer(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return IdCache(encode)


def encode_rows(column: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a text column one after another, an end id after each text, and the lengths."""
    data, start, end, first = chunk_spans(column, BYTE_LEVEL)
    ids, sizes, place = byte_ids(path).values(data, start, end)
    counts = sizes[place] if len(place) else np.zeros(0, np.int64)
    lengths = row_sums(counts, first).astype(np.int64) + 1
    out = np.full(int(lengths.sum()), end_id, dtype="<u4")
    if len(place):
        keep = np.ones(len(out), dtype=bool)
        keep[np.cumsum(lengths) - 1] = False
        out[keep] = ids[ragged((np.cumsum(sizes) - sizes)[place], counts)]
    return out, lengths


def pieces(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document as token pieces of at most ``capacity``: ``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32``. Of a longer document the first piece holds what is left over when
    all others are full."""

    def run(batches):
        for batch in steps(batches, keeps=byte_ids):
            ids, lengths = encode_rows(batch.column("text"), tokenizer, end_id)
            number = -(-lengths // capacity)
            owner = np.repeat(np.arange(len(lengths)), number)
            piece = ragged(np.zeros(len(lengths), np.int64), number)
            head = (lengths - 1) % capacity + 1
            start = np.where(piece == 0, 0, head[owner] + (piece - 1) * capacity)
            size = np.where(piece == 0, head[owner], capacity)
            base = (np.cumsum(lengths) - lengths)[owner] + start
            raw = memoryview(ids.tobytes())
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(base, base + size)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(size),
                    pa.array(np.array(sums, dtype=np.int64)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Plan:
    """Slots by length: slots ``number``, ``number + 1``, ... of ``length`` lie in the bins ``bin``,
    ``bin + 1``, ..., each ``offset`` tokens from the start."""

    length: np.ndarray
    number: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


def _fill(left: np.ndarray, capacity: int) -> list[int]:
    """Lengths of the next bin; ``left`` is updated to what remains unpacked."""
    chosen: list[int] = []
    gap = capacity
    while gap > 0:
        fits = np.flatnonzero(left[: gap + 1])
        if len(fits) == 0:
            break
        chosen.append(int(fits[-1]))
        left[chosen[-1]] -= 1
        gap -= chosen[-1]
    if gap and chosen:
        smallest = min(chosen)
        two = _best_two(left, gap + smallest)
        if two and sum(two) > smallest:
            chosen.remove(smallest)
            left[smallest] += 1
            chosen.extend(two)
            for length in two:
                left[length] -= 1
    return chosen


def _best_two(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum within ``room``, of equal sums those with the
    larger smaller one."""
    lengths = np.flatnonzero(left[: room + 1])
    if len(lengths) == 0:
        return None
    partner = np.searchsorted(lengths, room - lengths, side="right") - 1
    best, pair = (-1, -1), None
    for i, j in enumerate(partner):
        if j == i and left[lengths[i]] < 2:
            j -= 1
        if j < 0:
            continue
        small, large = sorted((int(lengths[i]), int(lengths[j])))
        if (small + large, small) > best:
            best, pair = (small + large, small), (small, large)
    return pair


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Best-two-fit over ``counts`` pieces of each length. The next bin repeats as long as what it
    takes is there, since the choices made depend only on which lengths are left."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, number in counts.items():
        left[length] = number
    used = np.zeros(capacity + 1, dtype=np.int64)
    slots: list[tuple[int, int, int, int]] = []
    bins = 0
    while left.any():
        before = left.copy()
        chosen = _fill(left, capacity)
        need = np.bincount(chosen, minlength=capacity + 1)
        times = int((before[need > 0] // need[need > 0]).min())
        # A pair was chosen with both in stock besides the rest, so it also repeats this often.
        left = before - need * times
        offset = 0
        for length in chosen:
            slots.append((length, int(used[length]), bins, offset))
            used[length] += times
            offset += length
        bins += times
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], bins)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    stored = materialize(pieces.sparkSession, pieces, "pieces")
    buckets = max(LEAST_BUCKETS, -(-stored.count() // BUCKET_ROWS))
    keyed = stored.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    )
    counts = materialize(
        pieces.sparkSession,
        keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")),
        "piece-counts",
    )
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    slots = plan({row["length"]: row["n"] for row in by_length}, capacity)

    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = counts.select(
        "length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = (
        keyed.withColumn("number", F.row_number().over(within) - 1)
        .join(base, ["length", "bucket"])
        .select(*stored.columns, (F.col("base") + F.col("number")).alias("number"))
    )

    span = 1 << 44
    keys = slots.length * span + slots.number
    names = stored.columns

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            slot = np.searchsorted(keys, length * span + number, side="right") - 1
            columns = [batch.column(name) for name in names]
            columns.append(pa.array(slots.bin[slot] + number - slots.number[slot]))
            columns.append(pa.array(slots.offset[slot]))
            yield pa.RecordBatch.from_arrays(
                columns, names=[*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in stored.dtypes)
    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")
