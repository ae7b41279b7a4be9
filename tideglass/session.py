"""Session construction, object-store settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession

# Environment names and defaults of the object store.
STORE_ENDPOINT = ("MINIO_ENDPOINT_URL_DOCKER", "http://minio:9000")
STORE_ACCESS_KEY = ("MINIO_ACCESS_KEY", "minioadmin")
STORE_SECRET_KEY = ("MINIO_SECRET_KEY", "minioadmin")
BROKER = ("KAFKA_BOOTSTRAP_SERVERS_HOST", "localhost:9092")

# What the plans in this package count on. Adaptive execution picks broadcast joins from measured
# sizes, merges small shuffle partitions and splits join partitions swollen by one hot key.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def _setting(env: Mapping[str, str], entry: tuple[str, str]) -> str:
    name, default = entry
    return env.get(name, default)


def storage_conf(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """S3A connection options from the environment, with the layout's defaults for what is not
    set. Paths alone choose local or object storage. ``build_session`` applies them only if one of the
    variables is set, so that a cluster's own store settings stay."""
    env = os.environ if env is None else env
    return {
        "spark.hadoop.fs.s3a.endpoint": _setting(env, STORE_ENDPOINT),
        "spark.hadoop.fs.s3a.access.key": _setting(env, STORE_ACCESS_KEY),
        "spark.hadoop.fs.s3a.secret.key": _setting(env, STORE_SECRET_KEY),
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def broker_address(env: Mapping[str, str] | None = None) -> str:
    return _setting(os.environ if env is None else env, BROKER)


def build_session(
    app_name: str,
    master: str | None = None,
    env: Mapping[str, str] | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """One session for every stage; object-store options are applied here and nowhere else."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = os.environ if env is None else env
    asked = any(name in given for name, _ in (STORE_ENDPOINT, STORE_ACCESS_KEY, STORE_SECRET_KEY))
    settings = {**ENGINE_CONF, **(storage_conf(given) if asked else {}), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_conf(
    shuffle_bytes: int,
    cores: int,
    partition_bytes: int = 256 * 1024**2,
    most: int = 50_000,
) -> dict[str, str]:
    """Shuffle settings for a stage that moves ``shuffle_bytes``: two waves of tasks at least, and
    partitions of about ``partition_bytes``. Past ``most`` partitions the bookkeeping per map task
    costs more than spilling does, so partitions then grow instead. Adaptive execution merges what
    turns out small."""
    wanted = -(-shuffle_bytes // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, min(wanted, most))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tideglass-")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder()


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its scratch copies."""
    return f"{shared_folder(spark)}/tideglass/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the shared folder; never one that an earlier run has written."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch copies of this application. Frames that read them end with it, so call it
    when their results are written."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write within go when it has ended, not when the driver happens to collect
    its garbage: else those of all writes of a run may lie on the workers' disks together."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(spark: SparkSession, df, name: str):
    """Write once and read back: cuts lineage in a way that outlives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
