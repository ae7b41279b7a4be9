"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import steps
from tideglass.session import materialize, scratch_path

__all__ = [
    "materialize",
    "read_table",
    "remainder",
    "scratch_path",
    "with_text_column",
    "workers_import_this",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def workers_import_this(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it. On a
    cluster the package is installed, or sent with ``--py-files``, and this path is just absent."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in [*paths, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def with_text_column(
    documents: DataFrame, text: str, make: Callable[[pa.Array], pa.Array], name: str, kind: str
) -> DataFrame:
    """``documents`` with column ``name`` made from steps of the text column; one of that name is
    replaced. Other columns pass through whatever they are called."""
    names = [c for c in documents.columns if c != name]
    kept = [f"c{i}" for i in range(len(names))]
    rows = documents.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)],
        F.col(f"`{text}`").cast("string").alias("text"),
    )

    def run(batches):
        for batch in steps(batches):
            made = make(batch.column("text"))
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*kept, "made"])

    schema = ", ".join([f"{k} {t}" for k, t in rows.dtypes if k != "text"] + [f"made {kind}"])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, names)], F.col("made").alias(name))
