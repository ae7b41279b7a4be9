"""Topic options and the topic source. The Kafka connector jar comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(
    servers: str,
    topic: str,
    *,
    min_rows: int | None = None,
    max_delay: str | None = None,
    max_rows: int | None = None,
) -> dict[str, str]:
    """Subscribe one topic from the earliest offset unless a checkpoint says otherwise.

    A batch starts at ``min_rows`` new messages or after ``max_delay``, and holds ``max_rows`` at
    most. The delay counts from the last batch, not from the last message.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if min_rows is not None:
        options["minOffsetsPerTrigger"] = str(min_rows)
    if max_delay is not None:
        options["maxTriggerDelay"] = max_delay
    if max_rows is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic_stream(
    spark: SparkSession,
    servers: str | None = None,
    topic: str | None = None,
    *,
    folder: str | None = None,
    max_files: int | None = None,
    **batching,
) -> DataFrame:
    """Stream of messages with one text column, ``value``.

    Reads a topic, or with ``folder`` the lines of text files that appear there.
    """
    if folder is not None:
        reader = spark.readStream.format("text")
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.load(folder)
    options = kafka_source_options(servers, topic, **batching)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))
