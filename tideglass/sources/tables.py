"""File sources and the Parquet sink. Paths may be local or ``s3a://``."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tideglass.functions.casting import lenient_cast
from tideglass.session import shuffles_freed
from tideglass.sources.messages import JSON_OPTIONS

# Raised while a reader is being built over a folder that is missing or holds no data files.
NO_DATA = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON Lines scan. A malformed line becomes a row of nulls.

    With a schema there is one pass over the data, and a missing or empty folder is an empty frame.
    Without one Spark scans twice, and all values are read as text.
    """
    try:
        if schema is not None:
            return spark.read.schema(schema).options(**JSON_OPTIONS).json(path)
        return spark.read.option("primitivesAsString", True).options(**JSON_OPTIONS).json(path)
    except AnalysisException as error:
        if error.getCondition() not in NO_DATA:
            raise
        return spark.createDataFrame([], schema or StructType())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: Parquet folder scan."""
    return spark.read.parquet(path)


def read_table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """S3 for stage runners: a missing or empty folder is no input rather than an error."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in NO_DATA:
            raise
        return None


def read_raw_csv(
    spark: SparkSession, path: str, *, multiline: bool = False, keep_empty: bool = True
) -> DataFrame:
    """CSV with a header row, every value text, quotes doubled inside quoted fields.

    Empty fields stay empty text unless ``keep_empty`` is off. Files with line breaks inside quoted
    fields need ``multiline``; such files cannot be split, so cut them small before a large load.
    """
    frame = spark.read.csv(path, header=True, escape='"', multiLine=multiline)
    return frame.na.fill("") if keep_empty else frame


def read_typed_csv(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """CSV with types inferred. Costs a second pass; for exploration of modest files."""
    return spark.read.csv(path, header=True, escape='"', multiLine=multiline, inferSchema=True)


def rows_to_frame(
    spark: SparkSession, rows: Iterable[Mapping[str, object]], schema: StructType
) -> DataFrame:
    """Request-sized in-memory rows under a declared schema.

    Values pass through text so that ``5`` is accepted for a float field; absent fields are null.
    """
    text_schema = StructType()
    for field in schema:
        text_schema.add(field.name, "string")
    text_rows = [
        tuple(None if row.get(f.name) is None else str(row[f.name]) for f in schema) for row in rows
    ]
    frame = spark.createDataFrame(text_rows, text_schema)
    return frame.select(
        [lenient_cast(F.col(f.name), text_schema[f.name].dataType, f.dataType).alias(f.name)
         for f in schema]
    )


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    sample: int | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """K2/K3: overwrite a Parquet folder, or append to it by ``mode``, then return what it holds (or
    ``sample`` rows of it).

    ``cluster_by`` range-partitions and sorts, so that readers skip row groups by min/max. End the
    list with a well-spread column such as ``record_hash``: then a value held by a large share of
    the rows is spread over many files. Files are compressed by zstd, as fingerprints in hexadecimal stay
    twice as large by codecs without entropy coding. A plan that reads the folder it would overwrite is refused,
    since Spark would delete the files first.
    """
    _refuse_own(df, path)
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).partitionBy(*partition_by).parquet(path, compression="zstd")
    written = read_table(df.sparkSession, path)
    return written if sample is None else written.limit(sample)


#: Slices of a write, bytes of a slice (as Parquet) from which it is made on its own, and its folders.
SLICES, SLICE_BYTES, SLICE_COLUMN = 8, 32 * 1024**2, "__slice"


def write_in_slices(
    rows: DataFrame,
    path: str,
    key: str,
    make: Callable[[DataFrame], DataFrame],
    slices: int = SLICES,
    slice_bytes: int = SLICE_BYTES,
) -> None:
    """K2: overwrite a Parquet folder by ``make(rows)``, for a ``make`` that needs rows of one ``key``
    together and no others.

    Rows are written once, beside the folder and parted by a hash of the key. Slices are then made one
    after the other, small ones together, and each goes when it is done: so of a shuffle many times
    larger than the table only a slice is on disk at a time, and rows are not read from their source again.
    """
    _refuse_own(rows, path)
    spark, beside = rows.sparkSession, f"{path.rstrip('/')}-slices-{uuid.uuid4().hex}"
    number = F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
    folder, files = _folder(spark, beside)
    try:
        with shuffles_freed(spark):
            parted = rows.withColumn(SLICE_COLUMN, number).write.partitionBy(SLICE_COLUMN)
            parted.parquet(beside, compression="zstd")
            steps = steps_for(spark, beside, slices, slice_bytes)
            for step in range(steps):
                own = range(step, slices, steps)
                schema = StructType([*rows.schema.fields, StructField(SLICE_COLUMN, IntegerType())])
                staged = spark.read.schema(schema).parquet(beside)
                some = staged.where(F.col(SLICE_COLUMN).isin(*own)).drop(SLICE_COLUMN)
                mode = "append" if step else "overwrite"
                make(some).write.mode(mode).parquet(path, compression="zstd")
                for i in own:
                    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{beside}/{SLICE_COLUMN}={i}"), True)
    finally:
        files.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def steps_for(spark: SparkSession, path: str, most: int, step_bytes: int = SLICE_BYTES) -> int:
    """In how many steps of about ``step_bytes`` to go through the files of a folder: at most ``most``."""
    folder, files = _folder(spark, path)
    return max(1, min(most, -(-files.getContentSummary(folder).getLength() // step_bytes)))


def _refuse_own(df: DataFrame, path: str) -> None:
    if _reads(df, path):
        raise ValueError(f"the plan reads {path}, which it would overwrite")


def _reads(df: DataFrame, path: str) -> bool:
    """Whether a file scan of the plan has ``path``, a folder in it or one above it as a root."""
    target = urlparse(path)
    folder = (target.path if target.scheme else os.path.abspath(path)).rstrip("/") + "/"
    for root in _scan_roots(df):
        place = urlparse(root)
        same_store = not target.scheme or target.netloc == place.netloc
        own = unquote(place.path).rstrip("/") + "/"
        if same_store and (own.startswith(folder) or folder.startswith(own)):
            return True
    return False


def _scan_roots(df: DataFrame) -> list[str]:
    """Roots of the file scans in a plan: as many as were named to readers, not one per file."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def write_version(df: DataFrame, path: str, **layout) -> str:
    """K2 for tables that are being read: write a new versioned folder under ``path`` and return its
    path. Readers of an older version are not disturbed; removing old versions is the caller's."""
    version = f"{path.rstrip('/')}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_table(df, version, **layout)
    return version
