"""Near duplicates by one-permutation hashing.

A document is the set of its distinct word shingles. One hash of each shingle both chooses a bin and
competes for its minimum; empty bins take over the value of a donor bin drawn by a fixed sequence of
hashes (optimal densification), so that a short document has a full signature too. Groups of bins
make the keys of banded buckets.

A bucket never yields all its pairs. Its best connected member becomes the centre of a star: only
the pairs (centre, member) are candidates, and these are confirmed on the full sets. Copies of one
set are one node throughout, however many there are. A bucket is settled when its members are in one
component. Where it is not, it gets further centres in rounds that double their number, and only
pairs across components not compared before are checked, until every member has been a centre. So no
pair that shares a bucket is missed, while a group of copies costs one star. Shingles
that only one node (later: one component) has are counted out, since they are in no intersection still
to be found: a set whose other shingles are too few for a link with any member of a bucket is done
there, and a pair is checked only if they are enough for it. Each set also has a bitmap of its shingles:
a bit that one set has and the other lacks is a shingle that is not in both, so a pair is checked only if
the bits allow a link.

With 6 bins a band and 50 bands, two sets with a similarity of 0.75 share no bucket with a chance of
6e-5, at 0.8 with one of 2e-7.

Without words or text the set is empty: such a document links with nothing. Repeated ids are one
document: all rows of an id have the links of any of them. A row with a null id is not linked to
by others, but shows the component its text belongs to; if nothing with an id equals it, null.

Ids of any type that sorts will do. Extra columns are not looked at, or passed through by ``keep_one``
whatever they are called; an empty table gives no rows. Words of a very long text are found and hashed
in pieces; its shingle set is held whole by one task, 8 bytes a shingle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tideglass.llm.arrowtext import SPACED, Words, gram_hash, mix, steps
from tideglass.llm.common import materialize
from tideglass.llm.components import components

BANDS, BAND_BINS = 50, 6
#: Donors tried for an empty bin before the nearest filled one after it is taken.
ATTEMPTS = 64
#: Words of 64 bits in the bitmap of a set, which bounds its intersection with another.
BIT_WORDS = 16


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after another, and where rows begin. A
    row with fewer words than ``size`` has its whole sequence as its only shingle."""
    hashes, at = words.grams(size)
    first = np.searchsorted(at, words.first)
    sets = []
    for row in range(words.rows):
        if first[row] < first[row + 1]:
            sets.append(np.unique(hashes[first[row] : first[row + 1]]))
        elif words.count[row]:
            own = words.hash[words.first[row] : words.first[row + 1]]
            sets.append(gram_hash([own[k : k + 1] for k in range(len(own))]))
        else:
            sets.append(np.zeros(0, np.uint64))
    begin = np.zeros(words.rows + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=begin[1:])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), begin


def donors(bins: int) -> np.ndarray:
    """The bins that each bin asks in turn when it is empty."""
    ask = np.arange(ATTEMPTS, dtype=np.uint64)[:, None] * np.uint64(bins) + np.arange(
        bins, dtype=np.uint64
    )
    return (mix(ask + np.uint64(0x632BE59BD9B4E019)) % np.uint64(bins)).astype(np.int64)


def signatures(sets: np.ndarray, begin: np.ndarray, bins: int) -> np.ndarray:
    """Rows x bins of densified one-permutation minima; ``sets`` is sorted within each row. Rows
    with an empty set are all zero."""
    rows = len(begin) - 1
    out = np.zeros((rows, bins), dtype=np.uint64)
    if len(sets) == 0:
        return out
    row = np.repeat(np.arange(rows), np.diff(begin))
    # The high half of the hash chooses the bin in order, so the first of a bin is its minimum.
    bin_ = ((sets >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = row * bins + bin_
    new = np.ones(len(cell), dtype=bool)
    new[1:] = cell[1:] != cell[:-1]
    filled = np.zeros(rows * bins, dtype=bool)
    filled[cell[new]] = True
    out.reshape(-1)[cell[new]] = sets[new]
    filled = filled.reshape(rows, bins)
    some = np.diff(begin) > 0
    open_row, open_bin = np.nonzero(~filled & some[:, None])
    original = out.copy()
    for ask in donors(bins):
        if len(open_row) == 0:
            return out
        donor = ask[open_bin]
        found = filled[open_row, donor]
        out[open_row[found], open_bin[found]] = original[open_row[found], donor[found]]
        open_row, open_bin = open_row[~found], open_bin[~found]
    for row, bin_ in zip(open_row, open_bin):
        there = np.flatnonzero(filled[row])
        out[row, bin_] = original[row, there[np.searchsorted(there, bin_) % len(there)]]
    return out


def band_keys(signature: np.ndarray, bands: int, band_bins: int) -> np.ndarray:
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        bins = signature[:, band * band_bins : (band + 1) * band_bins]
        tag = np.full(len(signature), band, dtype=np.uint64)
        keys[:, band] = gram_hash([tag, *(bins[:, k] for k in range(band_bins))])
    return keys


def _sketch(size: int, bands: int, band_bins: int):
    def run(batches):
        for batch in steps(batches):
            sets, begin = shingle_sets(Words(batch.column("text"), SPACED), size)
            count = np.diff(begin)
            keys = band_keys(signatures(sets, begin, bands * band_bins), bands, band_bins)
            digest = [
                hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(begin[:-1], begin[1:])
            ]
            flat = pa.array(keys.astype(np.int64).reshape(-1))
            offsets = pa.array(np.arange(len(count) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(count),
                    pa.array(digest, type=pa.binary()),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def bitmaps(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Rows x ``BIT_WORDS`` of 64 bits, of which each shingle sets one."""
    out = np.zeros((len(begin) - 1, BIT_WORDS), dtype=np.uint64)
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    bit = mix(sets) % np.uint64(64 * BIT_WORDS)
    place = (row, (bit >> np.uint64(6)).astype(np.int64))
    np.bitwise_or.at(out, place, np.uint64(1) << (bit & np.uint64(63)))
    return out


_BITS = [f"bits_{k}" for k in range(BIT_WORDS)]


def _sets(size: int):
    def run(batches):
        for batch in steps(batches):
            sets, begin = shingle_sets(Words(batch.column("text"), SPACED), size)
            bits = bitmaps(sets, begin).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.ListArray.from_arrays(
                        pa.array(begin.astype(np.int32)), pa.array(sets.astype(np.int64))
                    ),
                    *[pa.array(np.ascontiguousarray(bits[:, k])) for k in range(BIT_WORDS)],
                ],
                names=["node", "shingles", *_BITS],
            )

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) with 100 * intersection >= ``percent`` * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - both
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(F.lit(100) * both >= F.lit(percent) * union)
        .select("a", "b")
        .distinct()
    )


def near_duplicates(
    documents: DataFrame,
    percent: int = 75,
    shingle_words: int = 5,
    bands: int = BANDS,
    band_bins: int = BAND_BINS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest
    id reachable over links, its own included) and ``kept`` (it is that document).

    Documents link if 100 * |intersection| >= ``percent`` * |union| of their shingle sets. A row that
    has neither an id nor a component is kept.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketches = materialize(
        spark,
        rows.mapInArrow(
            _sketch(shingle_words, bands, band_bins),
            f"doc_id {kind}, n_shingles long, digest binary, bands array<long>",
        ),
        "sketches",
    )
    classes = materialize(
        spark,
        sketches.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
        .where("node IS NOT NULL"),
        "classes",
    )
    labels = _link(rows, _bucket_members(classes), percent, shingle_words)

    owner = classes.select("digest", "node")
    found = (
        sketches.select("doc_id", "n_shingles", "digest")
        .join(owner, "digest", "left")
        .withColumn("node", F.coalesce("node", "doc_id"))
        .join(labels, "node", "left")
    )
    component = F.coalesce("component", "node")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _bucket_members(classes: DataFrame) -> DataFrame:
    """``key``, ``node``, ``n``, ``size`` and ``degree`` of the nodes in buckets of two or more; the
    degree of a node is the sum of the sizes of its buckets."""
    spark = classes.sparkSession
    entries = classes.select("node", "n", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(
        spark, entries.join(materialize(spark, sizes, "bucket-sizes"), "key"), "members"
    )
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    return materialize(
        spark, members.join(materialize(spark, degree, "degrees"), "node"), "members"
    )


def _enough(common: Column, both: Column, percent: int) -> Column:
    """Whether ``common`` shingles are enough for a link of sets with ``both`` shingles together."""
    return F.lit(100 + percent) * common >= F.lit(percent) * both


def _shared(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and how many of its shingles occur in another component too; ``nodes`` has columns
    ``node`` and ``component``."""
    spark = sets.sparkSession
    entries = sets.join(nodes, "node").select("node", "component", F.explode("shingles").alias("s"))
    ends = entries.groupBy("s").agg(
        F.min("component").alias("first"), F.max("component").alias("last")
    )
    across = materialize(spark, ends.where("first <> last").select("s"), "shared-shingles")
    return entries.join(across, "s").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))


def _able(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``members`` that share enough to link with the smallest set of their bucket at least, with
    ``shared`` and the ``size`` that is left of the bucket."""
    spark = members.sparkSession
    nodes = members.select("node", "component").distinct()
    shared = materialize(spark, _shared(sets, nodes), "shared")
    members = materialize(spark, members.drop("shared", "size").join(shared, "node"), "members")
    least = members.groupBy("key").agg(F.min("n").alias("least"))
    able = members.join(materialize(spark, least, "least"), "key").where(
        _enough(F.col("shared"), F.col("n") + F.col("least"), percent)
    )
    able = materialize(spark, able.drop("least"), "members")
    sizes = able.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return materialize(spark, able.join(materialize(spark, sizes, "bucket-sizes"), "key"), "members")


def _with_bits(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``members`` with the bitmaps of their nodes; null for a node with several sets."""
    ends = [f(b).alias(f"{b}_{name}") for b in _BITS for f, name in ((F.min, "first"), (F.max, "last"))]
    bits = sets.groupBy("node").agg(*ends)
    bits = bits.select(
        "node", *[F.when(F.col(f"{b}_first") == F.col(f"{b}_last"), F.col(f"{b}_first")).alias(b) for b in _BITS]
    )
    return members.join(materialize(members.sparkSession, bits, "bitmaps"), "node")


def _lacking(one: str, other: str) -> Column:
    """At least how many shingles of one set the other lacks, by their bitmaps; 0 without."""
    lacking = [F.bit_count(F.col(one + b).bitwiseAND(F.bitwise_not(F.col(other + b)))) for b in _BITS]
    return sum((F.coalesce(n, F.lit(0)) for n in lacking), F.lit(0))


def _pairs(members: DataFrame, low: int, high: int, percent: int) -> DataFrame:
    """Pairs of bucket members with the bucket's centres number ``low`` to ``high - 1`` by degree,
    if they are in different components and the sizes of their sets, of what these share with others
    (``shared``), and their bitmaps allow a link."""
    best = F.struct((-F.col("degree")).alias("minus"), "node", "n", "component", "shared", *_BITS)
    if high == 1:
        centres = members.groupBy("key").agg(F.min(best).alias("centre"))
    else:
        order = Window.partitionBy("key").orderBy(F.desc("degree"), "node", "n")
        ranked = members.withColumn("rank", F.row_number().over(order))
        centres = ranked.where((F.col("rank") <= high) & (F.col("rank") > low)).select(
            "key", best.alias("centre")
        )
    centres = materialize(members.sparkSession, centres, "centres")
    node = F.col("centre.node")
    # An intersection is at most what the smaller of both sets shares with any other, and no more than
    # either set without what the other lacks.
    shared = F.least(
        "shared",
        "centre.shared",
        F.col("n") - _lacking("", "centre."),
        F.col("centre.n") - _lacking("centre.", ""),
    )
    joined = members.join(centres, "key").where(
        (F.col("component") != F.col("centre.component"))
        & _enough(shared, F.col("n") + F.col("centre.n"), percent)
    )
    return joined.select(F.greatest("node", node).alias("a"), F.least("node", node).alias("b")).distinct()


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``members`` with the components that ``labels`` now gives their nodes."""
    members = members.drop("component").join(labels, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    return materialize(members.sparkSession, members, "seen")


def _unsettled(members: DataFrame, centres: int) -> DataFrame:
    """The members of buckets that hold several components and pairs without any of the first
    ``centres`` members."""
    spark = members.sparkSession
    open_ = members.where(F.col("size") > centres + 1)
    ends = open_.groupBy("key").agg(
        F.min("component").alias("first"), F.max("component").alias("last")
    )
    keys = materialize(spark, ends.where("first <> last").select("key"), "unsettled")
    return materialize(spark, open_.join(keys, "key"), "seen")


def _link(rows: DataFrame, members: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """``node`` and ``component`` of linked nodes, over rounds of more centres per bucket."""
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    nodes = members.select("node").distinct()
    texts = rows.withColumnRenamed("doc_id", "node").join(nodes, "node", "left_semi")
    sets = materialize(
        spark,
        texts.mapInArrow(
            _sets(shingle_words),
            f"node {kind}, shingles array<long>, " + ", ".join(f"{b} long" for b in _BITS),
        ),
        "sets",
    )
    alone = members.withColumns({"component": F.col("node"), "shared": F.col("n")})
    members = materialize(spark, _with_bits(_able(alone, sets, percent), sets), "members")
    tested = materialize(spark, _pairs(members, 0, 1, percent), "pairs")
    links = materialize(spark, confirmed(tested, sets, percent), "links")
    labels = materialize(spark, components(links), "labels")
    members = members.where("size > 2")  # of two, one has been the centre
    members = _able(_unsettled(_labelled(members, labels), 1), sets, percent)
    # A settled bucket stays so, as components only grow: a round looks at what the one before left.
    members, low, high = _unsettled(members, 0), 0, 2
    while not members.isEmpty():
        fresh = _pairs(members, low, high, percent).join(tested, ["a", "b"], "left_anti")
        fresh = materialize(spark, fresh, "pairs")
        found = materialize(spark, confirmed(fresh, sets, percent), "links")
        tested = tested.unionByName(fresh)
        low, high = high, 3 * high
        members = members.where(F.col("size") > low + 1)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = materialize(spark, components(links), "labels")
            members = _labelled(members, labels)
        members = _unsettled(members, low)
    return labels


def keep_one(
    documents: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text", **shape
) -> DataFrame:
    """One row of each group of near duplicates, with its columns: the one with the smallest id. Of
    rows that share an id one stays. Rows with a null id come after all others."""
    spark = documents.sparkSession
    columns = documents.columns
    # Helper columns bear names that no column of the documents has.
    rows, key, rank = documents, doc_id, _unused("rank", columns)
    if not documents.where(F.col(f"`{doc_id}`").isNull()).isEmpty():
        key = _unused("key", columns)
        own, number = F.col(f"`{doc_id}`"), F.monotonically_increasing_id()
        if isinstance(documents.schema[doc_id].dataType, IntegralType):
            last = documents.agg(F.max(own.cast("long"))).first()[0] or 0
            own = F.coalesce(own.cast("long"), number + F.lit(last + 1))
        else:
            own = F.coalesce(F.concat(F.lit("0"), own.cast("string")), F.concat(F.lit("1"), number))
        rows = materialize(spark, documents.withColumn(key, own), "identified")
    found = near_duplicates(rows, percent, doc_id=key, text=text, **shape)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    rows = rows.join(materialize(spark, gone, "duplicates"), key, "left_anti")
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    repeated = materialize(spark, repeated, "repeated")
    if not repeated.isEmpty():
        several = rows.join(repeated, key, "left_semi")
        order = Window.partitionBy(key).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
        first = several.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
        rows = rows.join(repeated, key, "left_anti").unionByName(first.drop(rank))
    return rows.select(*[F.col(f"`{name}`") for name in columns])


def _unused(name: str, columns: list[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name
