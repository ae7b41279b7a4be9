"""Token counts: lengths only, from batch encoding inside Arrow functions.

``token_counts`` adds the number of tokens that a public tokenizer gives for each whole text. Arrow
batches are divided into steps of about equal bytes, and texts are cut at places where no token can
reach across (see ``chunks``), so that one very long text is encoded in bounded parts; lengths of
equal chunks are looked up. Nothing is shuffled and only numbers leave the Python workers.

A null or empty text has no tokens. Rows with null or repeated ids are counted like any other. The
result holds the id and the counts; other columns of the input are not looked at.

An empty table gives no rows.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import kept, row_sums, steps, text_bytes
from tideglass.llm.chunks import BYTE_LEVEL, PIECES, ChunkCache, byte_level_tokenizer, chunk_spans


@kept
def piece_lengths(model: str) -> ChunkCache:
    """Lengths by a sentencepiece model that puts a blank before each text. A chunk comes without
    its leading blank, which the model then adds; a chunk that was only this blank is one token."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)

    def encode(texts: list[str]) -> list[int]:
        return [len(ids) for ids in processor.encode(texts, num_threads=1)]

    return ChunkCache(encode)


def _count_pieces(column: pa.Array, model: str) -> np.ndarray:
    data, start, end, first = chunk_spans(column, PIECES)
    lead = np.ones(len(start), dtype=np.int64)
    lead[first[:-1][np.diff(first) > 0]] = 0  # the first chunk of a text is encoded as it stands
    bare = start + lead
    only = bare == end
    values, place = piece_lengths(model).values(data, bare[~only], end[~only])
    counts = np.ones(len(start), dtype=np.int64)
    counts[~only] = np.array(values, dtype=np.int64)[place] if len(place) else 0
    return row_sums(counts, first).astype(np.int64)


@kept
def _byte_lengths(path: str) -> ChunkCache:
    tokenizer = byte_level_tokenizer(path)

    def encode(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return ChunkCache(encode)


def _count_bytes(column: pa.Array, path: str) -> np.ndarray:
    data, start, end, first = chunk_spans(column, BYTE_LEVEL)
    values, place = _byte_lengths(path).values(data, start, end)
    counts = np.array(values, dtype=np.int64)[place] if len(place) else np.zeros(0)
    return row_sums(counts, first).astype(np.int64)


def token_counts(
    documents: DataFrame,
    tokenizer: str,
    limit: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens).

    ``tokenizer`` is the path, on every worker, of a sentencepiece ``.model`` whose pieces start
    at blanks and that does not normalise text, or of a byte-level BPE ``.json``.
    """
    pieces = tokenizer.endswith(".model")
    count, keeps = (_count_pieces, piece_lengths) if pieces else (_count_bytes, _byte_lengths)

    def run(batches):
        for batch in steps(batches, keeps=keeps):
            column = batch.column("text")
            _, offsets = text_bytes(column)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(count(column, tokenizer))],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))

