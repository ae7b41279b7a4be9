"""Nearest neighbours by largest inner product, through multi-index hashing of learned binary codes.

Vectors get one more component that brings all of them to the largest norm, which turns the largest
inner product into the smallest angle. Their principal components are rotated so that signs lose
little (iterative quantisation), several rotations giving the bits of a code. Codes are cut into
substrings of eight bits, each with its own index. A code within a Hamming radius ``r`` of the query's
differs by at most ``r / substrings`` bits in one substring at least, so probing all values that close
in every index retrieves each such code; those truly within the radius are reranked by exact inner
products in double precision.

The index is dealt out in blocks of rows, and the queries, a stated set, go to every block in chunks:
only ids and scores of the nearest of each block are shuffled. The rotation and the first radius are
learned from at most ``sample`` rows, chosen by a hash; every row is indexed. Queries that find fewer
than ``k`` rows are searched again with a wider radius, in the end with one that takes in every code.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part, nor do rows with a null id. Rows that share an id are searched one by one, but a query's own
id is no candidate. Extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.common import materialize

#: Rows the rotation and radius are learned from at most; bits of a code; rows of a block of the
#: index and queries of a chunk, about.
SAMPLE_ROWS, CODE_BITS = 20_000, 128
BLOCK_ROWS, CHUNK_QUERIES = 16_384, 1_024
#: The share of true neighbours that the first radius shall take in, by the sample.
COVER = 0.985

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
#: How many bits two substrings differ by.
_APART = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


@dataclass
class Codebook:
    """``projection`` of extended vectors onto code bits, the largest norm, and the first radius."""

    projection: np.ndarray
    norm: float
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of indexed vectors, a byte per substring."""
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        return _signs(np.column_stack([scaled, rest]) @ self.projection)

    def query_codes(self, vectors: np.ndarray) -> np.ndarray:
        return _signs(np.column_stack([vectors, np.zeros(len(vectors))]) @ self.projection)


def _signs(projected: np.ndarray) -> np.ndarray:
    return np.packbits(projected > 0, axis=1)


def _rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """The orthogonal matrix under which signs come nearest to the values of ``x``."""
    random = np.random.default_rng(seed)
    rotation = np.linalg.qr(random.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        signs = np.where(x @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ signs)
        rotation = u @ v
    return rotation


def learn(vectors: np.ndarray, norm: float, rows: int, k: int, bits: int = CODE_BITS) -> Codebook:
    """A codebook from sampled ``vectors`` of a table with ``rows`` rows, whose largest norm is
    ``norm``."""
    book = Codebook(np.zeros((vectors.shape[1] + 1, bits)), norm, bits)
    scaled = vectors / norm
    rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
    extended = np.column_stack([scaled, rest])
    _, _, axes = np.linalg.svd(extended.T @ extended)
    axes = axes[: min(extended.shape[1], bits)].T
    reduced = extended @ axes
    parts = [axes @ _rotation(reduced, seed) for seed in range(-(-bits // axes.shape[1]))]
    book.projection = np.hstack(parts)[:, :bits]
    # As many neighbours in the sample as lie as near as the k nearest of the table.
    near = max(1, round(k * len(vectors) / max(rows, 1)))
    if len(vectors) > near + 1:
        queries = vectors[:: max(1, len(vectors) // 256)]
        codes, query_codes = book.codes(vectors), book.query_codes(queries)
        apart = []
        for query, code in zip(queries, query_codes):
            score = vectors @ query
            score[(vectors == query).all(axis=1)] = -np.inf
            best = np.argpartition(-score, near)[:near]
            apart.append(_ONES[codes[best] ^ code].sum(axis=1))
        book.radius = int(np.ceil(np.quantile(np.concatenate(apart), COVER)))
    return book


class Block:
    """Rows of the index: ids, vectors, and their codes by substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.by_substring = np.ascontiguousarray(codes.T)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes lie within ``radius`` of ``code``: first those that some substring's
        index gives for the values near enough there, then those of them that really do."""
        reach = radius // len(code)
        probed = np.zeros(len(self.ids), dtype=bool)
        for substring, value in zip(self.by_substring, code):
            probed |= (_APART[value] <= reach)[substring]
        rows = np.flatnonzero(probed)
        return rows[_ONES[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]

    def nearest(self, query_id: int, query: np.ndarray, code: np.ndarray, radius: int, k: int):
        """Ids and inner products of the ``k`` best of the rows within the radius."""
        rows = self.within(code, radius)
        rows = rows[self.ids[rows] != query_id]
        # Summed row by row in one order, so that equal vectors have equal scores.
        score = (self.vectors[rows].astype(np.float64) * query).sum(axis=1)
        if len(rows) > k:
            least = np.partition(score, len(rows) - k)[len(rows) - k]
            best = score >= least
            rows, score = rows[best], score[best]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[order]], score[order]


def _valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id``, ``v`` (components as bytes) and ``norm`` of the vectors that take part."""
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    wide = "<f4" if kind == "float" else "<f8"
    value = F.col(embedding).cast("array<double>")
    plain = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("e")).where(
        F.col("vec_id").isNotNull()
        & (F.size("e") > 0)
        & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("e", lambda x: x != 0)
    )
    length = plain.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = length.orderBy(F.desc("n"), "d").first()
    plain = plain.where(F.size("e") == (most["d"] if most else 0))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("e").flatten().to_numpy()
                x = flat.reshape(batch.num_rows, -1)
                raw = [row.astype(wide).tobytes() for row in x]
                columns = [batch.column("vec_id"), pa.array(raw), pa.array(np.linalg.norm(x, axis=1))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "norm"])

    return plain.mapInArrow(run, "vec_id long, v binary, norm double"), wide


def _unpack(raw: list[bytes], wide: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), wide).reshape(len(raw), -1)


def _blocks(rows: DataFrame, number: int, wide: str, book: Codebook | None) -> DataFrame:
    """``rows`` in ``number`` blocks of about equal size: ``block`` (from 0), ``ids``, ``vectors`` and
    ``codes`` as bytes, those of queries if there is no codebook for the index."""

    def run(batches):
        ids, raw = [], []
        for batch in batches:
            ids.append(batch.column("vec_id").to_numpy())
            raw.extend(batch.column("v").to_pylist())
        if raw:
            codes = book.codes(_unpack(raw, wide).astype(np.float64)).tobytes() if book else b""
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int64()),
                    pa.array([np.concatenate(ids).tobytes()]),
                    pa.array([b"".join(raw)], pa.binary()),
                    pa.array([codes]),
                ],
                names=["block", "ids", "vectors", "codes"],
            )

    dealt = rows.select("vec_id", "v").repartition(number)
    return dealt.mapInArrow(run, "block long, ids binary, vectors binary, codes binary")


def _pairs(index: DataFrame, sent: DataFrame) -> DataFrame:
    """Each block with each chunk of queries, both read from their files where they are paired: a copy
    of the queries for every block would be broadcast by the size of one copy, through the driver."""
    return index.crossJoin(sent.hint("shuffle_replicate_nl"))


def _search(book: Codebook, radius: int, k: int, dimension: int, wide: str):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(name)[row].as_py()  # noqa: B023,E731
                ids = np.frombuffer(get("ids"), np.int64)
                vectors = np.frombuffer(get("vectors"), wide).reshape(len(ids), dimension)
                codes = np.frombuffer(get("codes"), np.uint8).reshape(len(ids), -1)
                block = Block(ids, vectors, codes)
                query_ids = np.frombuffer(get("query_ids"), np.int64)
                queries = np.frombuffer(get("queries"), wide).reshape(-1, dimension).astype(np.float64)
                found = [
                    block.nearest(i, q, c, radius, k)
                    for i, q, c in zip(query_ids, queries, book.query_codes(queries))
                ]
                owner = np.repeat(query_ids, [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    bits: int = CODE_BITS,
    sample: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``queries`` (a condition on ``vec_id``) holds
    for: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller id. ``bits`` is
    a multiple of eight."""
    spark = vectors.sparkSession
    valid, wide = _valid(vectors, vec_id, embedding)
    valid = materialize(spark, valid, "vectors")
    totals = valid.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).first()
    if not totals["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    learned = valid.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).toArrow()
    matrix = _unpack(learned["v"].to_pylist(), wide).astype(np.float64)
    book = learn(matrix, totals["norm"], totals["n"], k, bits)
    dimension = matrix.shape[1]

    number = max(1, -(-totals["n"] // block_rows))
    index = materialize(spark, _blocks(valid, number, wide, book), "index")
    asked = valid.where(queries)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    radius, results = book.radius, None
    while True:
        size = asked.count()
        if not size:
            break
        chunks = _blocks(asked, max(1, -(-size // chunk_queries)), wide, None)
        sent = materialize(
            spark,
            chunks.select(F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")),
            "queries",
        )
        found = _pairs(index, sent).mapInArrow(
            _search(book, radius, k, dimension, wide), "query_id long, vec_id long, score double"
        )
        ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = materialize(spark, ranked, "nearest")
        enough = ranked.groupBy("query_id").agg(F.max("rank").alias("n")).where(F.col("n") >= k)
        if radius >= bits:
            enough = ranked.select("query_id").distinct()
        enough = enough.select("query_id")
        done = ranked.join(enough, "query_id", "left_semi")
        results = done if results is None else results.unionByName(done)
        if radius >= bits:
            break
        missed = asked.join(enough, asked["vec_id"] == enough["query_id"], "left_anti")
        asked = materialize(spark, missed, "missed")
        radius = min(bits, radius + max(8, bits // 8))
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return results.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
