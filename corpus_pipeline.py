"""A corpus of documents made ready for training, stage by stage.

Each stage works on all that its predecessor kept, written as Parquet in the shared folder and read
again: documents of low quality go, one document of each group of near duplicates stays, documents
that hold passages of the benchmark go, secrets are masked, and what is left is packed into sequences.

All stages but the last return the columns of their documents, extra ones too, whatever those are called. A
null text counts as empty: it has a score like any other, is near no other document, holds no passage
and no secret, and is packed as its end token. Documents with a null id are judged by their texts, stay
if no document with an id is their duplicate, and come after all others where one of a group has to
stay. Of rows that share an id one stays, the first by a hash of its columns. An empty table
goes through as one. Long texts are worked on whole, as the operators state.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.llm import decontamination, line_quality, near_duplicates, packing, secrets
from tideglass.llm.common import materialize, read_table, remainder, workers_import_this


#: Most rows in an Arrow batch of texts. Spark and the Python worker each hold one whole for every task, and
#: with Spark's own 10,000 rows it is tens of megabytes. Operators give the same rows for batches of any size.
BATCH_ROWS = 2_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _stage(function):
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        workers_import_this(spark)
        # A stage is run by its caller later, so the session's setting stays; a smaller one is kept.
        if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
            spark.conf.set(_BATCH_CONF, BATCH_ROWS)
        return function(spark, docs, sf_dir)

    return run_stage


@_stage
def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of quality label 1 is 0.3 or more."""
    train = F.coalesce(remainder(F.col("doc_id"), 5) != 0, F.lit(False))
    labels = read_table(spark, sf_dir, "labels")
    return line_quality.keep_good(docs, labels, train, threshold=0.3)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group with a similarity of 0.75 or more."""
    return near_duplicates.keep_one(docs, percent=75)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    return decontamination.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"), 10)


@_stage
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; ``n_chars`` follows the text."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    length = F.coalesce(F.char_length("text"), F.col("n_chars")).cast(kind)
    return masked.withColumn("n_chars", length)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences of 1,024 tokens."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(docs, tokenizer, 1024, 2), 1024)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

#: A conditional random field cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
