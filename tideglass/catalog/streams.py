"""Round trips through messages, files and streams, and the layered run as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideglass.catalog.health import (
    ABSTRACT_SILVER_SQL,
    COUNTS_SQL,
    SILVER_SQL,
    SUMMARY_SQL,
    YEARLY_SQL,
    raw_health,
    raw_health_waves,
    yearly,
)
from tideglass.catalog.registry import query
from tideglass.catalog.views import ABSTRACTS_SQL, HEALTH_SQL, abstracts, rounded, table
from tideglass.operators.cleaning import cast_to_schema
from tideglass.plans import lakehouse
from tideglass.plans.silver import hashed_abstracts, to_silver_abstracts
from tideglass.schemas import ABSTRACT_SCHEMA
from tideglass.session import scratch_path
from tideglass.sources import (
    decode_messages,
    read_bronze,
    read_raw_csv,
    read_topic_stream,
    read_typed_csv,
    rows_to_frame,
    to_messages,
    write_messages,
    write_table,
    write_version,
)
from tideglass.streaming import (
    drain_topics,
    land_bronze,
    read_landed,
    read_rejects,
    silver_by_batch,
    silver_by_state,
)

_PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


@query("to_messages_roundtrip", _PART_SQL)
def to_messages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return decode_messages(to_messages(part), part.schema).drop("reject")


@query("csv_roundtrip", _PART_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv")
    part.write.csv(path, header=True, escape='"')
    return cast_to_schema(read_raw_csv(spark, path), part.schema)


@query(
    "table_roundtrip",
    f"""WITH {HEALTH_SQL}, {YEARLY_SQL}
    SELECT Year, Disease_Category, round(Global_Avg_DALYs, 6) AS Global_Avg_DALYs,
      Num_Countries_Reported FROM yearly""",
)
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "yearly")
    mart = yearly(spark, sf_dir).select(
        "Year", "Disease_Category", "Global_Avg_DALYs", "Num_Countries_Reported"
    )
    written = write_table(mart, path, cluster_by=["Year", "Disease_Category"])
    return rounded(written)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abstracts as messages, each tenth one broken: no JSON, or text after its end."""
    rows = abstracts(spark, sf_dir, ("doc_id",))
    good = F.to_json(F.struct("text", "label"))
    number = F.col("doc_id").cast("string")
    broken = F.when(F.col("doc_id") % 20 == 0, F.concat(F.lit("not json "), number)).otherwise(
        F.concat(F.lit('{"text":null} trailing '), number)
    )
    return rows.select(F.when(F.col("doc_id") % 10 == 0, broken).otherwise(good).alias("value"))


def _message_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "messages")
    write_messages(_messages(spark, sf_dir), path)
    return path


def _landing(spark: SparkSession, sf_dir: str) -> str:
    path, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-offsets")
    stream = read_topic_stream(spark, folder=_message_folder(spark, sf_dir))
    land_bronze(stream, path, checkpoint).awaitTermination()
    return path


_SENT_SQL = ABSTRACTS_SQL.replace("FROM documents", "FROM documents WHERE doc_id % 10 <> 0")


@query(
    "bronze_scan",
    f"""WITH {_SENT_SQL}, {ABSTRACT_SILVER_SQL}
    SELECT label, count(*) AS n_rows FROM silver_abstracts GROUP BY label""",
)
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = read_bronze(spark, _message_folder(spark, sf_dir), ABSTRACT_SCHEMA)
    return to_silver_abstracts(bronze).groupBy("label").agg(F.count("*").alias("n_rows"))


@query("stream_bronze_roundtrip", f"WITH {_SENT_SQL} SELECT text, label FROM abstracts")
def stream_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landed(spark, _landing(spark, sf_dir), ABSTRACT_SCHEMA)


@query(
    "stream_rejects",
    """SELECT CASE WHEN doc_id % 20 = 0 THEN 'not json ' ELSE '{"text":null} trailing ' END || doc_id
      AS value FROM documents WHERE doc_id % 10 = 0""",
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rejects(spark, _landing(spark, sf_dir))


_STREAM_SILVER_SQL = f"""WITH {_SENT_SQL}, {ABSTRACT_SILVER_SQL}
    SELECT text, label, record_hash FROM silver_abstracts"""


def _bronze_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(ABSTRACT_SCHEMA).json(folder)


@query("stream_silver_dedup", _STREAM_SILVER_SQL)
def stream_silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages land twice; Silver has each row once."""
    folder = _message_folder(spark, sf_dir)
    write_messages(_messages(spark, sf_dir), folder, "append")
    path, checkpoint = scratch_path(spark, "silver"), scratch_path(spark, "silver-offsets")
    silver_by_state(
        _bronze_stream(spark, folder), hashed_abstracts, path, checkpoint
    ).awaitTermination()
    return spark.read.parquet(path)


@query("stream_silver_by_batch", _STREAM_SILVER_SQL)
def stream_silver_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages land twice, in two runs; the second run adds nothing."""
    folder = _message_folder(spark, sf_dir)
    path, checkpoint = scratch_path(spark, "silver"), scratch_path(spark, "silver-offsets")
    for run in range(2):
        if run:
            write_messages(_messages(spark, sf_dir), folder, "append")
        stream = _bronze_stream(spark, folder)
        silver_by_batch(stream, hashed_abstracts, path, checkpoint).awaitTermination()
    return spark.read.parquet(path)


@query(
    "medallion_report",
    f"""WITH {HEALTH_SQL}, {SILVER_SQL}, {SUMMARY_SQL.replace("FROM health", "FROM silver")},
    {YEARLY_SQL.replace("FROM health", "FROM silver")}, {_SENT_SQL}, {ABSTRACT_SILVER_SQL},
    {COUNTS_SQL}
    SELECT 'silver/{lakehouse.HEALTH_TABLE}' AS stage, count(*) AS n_rows FROM silver
    UNION ALL SELECT 'silver/{lakehouse.ABSTRACT_TABLE}', count(*) FROM silver_abstracts
    UNION ALL SELECT 'gold/{lakehouse.COUNTRY_SUMMARY}', count(*) FROM summary
    UNION ALL SELECT 'gold/{lakehouse.YEARLY_SUMMARY}', count(*) FROM yearly
    UNION ALL SELECT 'gold/{lakehouse.DETAIL_MART}', count(*) FROM silver
    UNION ALL SELECT 'gold/{lakehouse.ABSTRACT_COUNTS}', count(*) FROM counts
    UNION ALL SELECT 'gold/{lakehouse.IMPACT_VS_RESEARCH}', count(DISTINCT Disease_Category)
      FROM silver""",
)
def medallion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of both topics through Bronze, Silver and Gold; rows written per stage."""
    paths = lakehouse.LakePaths(scratch_path(spark, "lake"))
    for rows in raw_health_waves(spark, sf_dir):
        write_messages(to_messages(rows), paths.bronze(lakehouse.HEALTH_TOPIC), "append")
    write_messages(_messages(spark, sf_dir), paths.bronze(lakehouse.ABSTRACT_TOPIC))
    reports = lakehouse.run_silver(spark, paths) + lakehouse.run_gold(spark, paths)
    return spark.createDataFrame(
        [(report.stage, report.rows) for report in reports], "stage string, n_rows bigint"
    )


@query(
    "silver_keeps_fields",
    f"""WITH {HEALTH_SQL}, {SILVER_SQL}
    SELECT Country, Country || ' ' || Year AS Field_Note, record_hash FROM silver""",
)
def silver_keeps_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field beyond the schema and a header in other letter case, through the Silver stage."""
    paths = lakehouse.LakePaths(scratch_path(spark, "lake"))
    rows = raw_health(spark, sf_dir)
    rows = rows.withColumn("Field Note", F.concat_ws(" ", "Country", "Year"))
    rows = rows.withColumnRenamed("Country", "country")
    write_messages(to_messages(rows), paths.bronze(lakehouse.HEALTH_TOPIC))
    lakehouse.run_silver(spark, paths)
    silver = spark.read.parquet(paths.silver(lakehouse.HEALTH_TABLE))
    return silver.select("Country", "Field_Note", "record_hash")


@query(
    "bronze_scan_inferred",
    f"WITH {_SENT_SQL} SELECT text, label FROM abstracts",
)
def bronze_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read without a schema; lines that are no JSON hold neither field."""
    rows = read_bronze(spark, _message_folder(spark, sf_dir))
    return rows.select("text", "label").filter("text IS NOT NULL")


@query("typed_csv_roundtrip", _PART_SQL.replace("p_partkey", "CAST(p_partkey AS INTEGER) AS p_partkey", 1))
def typed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found from the file."""
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "part").write.csv(path, header=True, escape='"')
    return read_typed_csv(spark, path)


#: A request, as a caller would send it.
_ASKED = [("1-URGENT", 100_000), ("2-HIGH", "150000"), ("5-LOW", 200_000.0), ("unknown", 0)]
_ASKED_SQL = ", ".join(f"('{name}', {int(float(least))})" for name, least in _ASKED)


@query(
    "rows_roundtrip",
    f"""SELECT priority, CAST(least AS DOUBLE) AS least, count(o_orderkey) AS n_orders,
      round(coalesce(sum(o_totalprice), 0), 2) AS total
    FROM (VALUES {_ASKED_SQL}) AS asked(priority, least)
    LEFT JOIN orders ON o_orderpriority = priority AND o_totalprice >= least GROUP BY priority, least""",
)
def rows_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request-sized rows in memory as the small side of a join over the orders."""
    schema = StructType().add("priority", "string").add("least", "double")
    asked = rows_to_frame(spark, [dict(zip(schema.names, row)) for row in _ASKED], schema)
    # Orders are summed by priority and request before they meet the rest of the request.
    matched = (
        table(spark, sf_dir, "orders")
        .join(F.broadcast(asked), F.col("o_orderpriority") == F.col("priority"))
        .where(F.col("o_totalprice") >= F.col("least"))
        .groupBy("priority")
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("sum"))
    )
    return asked.join(matched, "priority", "left").select(
        "priority",
        "least",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_orders"),
        F.round(F.coalesce("sum", F.lit(0.0)), 2).alias("total"),
    )


@query(
    "table_sample",
    """SELECT least(count(*), 5) AS n_rows, count(*) AS n_written, true AS all_known FROM part""",
)
def table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: rows of a table as it was written, and the table whole in a versioned folder."""
    part = table(spark, sf_dir, "part")
    sample = write_table(part, scratch_path(spark, "part"), sample=5)
    written = spark.read.parquet(write_version(part, scratch_path(spark, "parts")))
    unknown = sample.exceptAll(part).count()
    return sample.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(written.count()).cast("long").alias("n_written"),
        F.lit(unknown == 0).alias("all_known"),
    )


@query(
    "topics_drained",
    f"""WITH {_SENT_SQL}
    SELECT 'a' AS topic, (SELECT count(*) FROM documents) AS n_read, count(*) AS n_accepted FROM abstracts
    UNION ALL SELECT 'b', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation)""",
)
def topics_drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics landed at once, with the rows read of each."""
    paths = lakehouse.LakePaths(scratch_path(spark, "lake"))
    nations = scratch_path(spark, "messages")
    write_messages(to_messages(table(spark, sf_dir, "nation")), nations)
    topics = {
        "a": read_topic_stream(spark, folder=_message_folder(spark, sf_dir)),
        "b": read_topic_stream(spark, folder=nations),
    }
    read = drain_topics(topics, paths)
    return spark.createDataFrame(
        [(t, n, read_landed(spark, paths.bronze(t), None).count()) for t, n in read.items()],
        "topic string, n_read bigint, n_accepted bigint",
    )


@query(
    "empty_input_skipped",
    f"""WITH {_SENT_SQL}, {ABSTRACT_SILVER_SQL}
    SELECT 'silver/{lakehouse.HEALTH_TABLE}' AS stage, CAST(NULL AS BIGINT) AS n_rows FROM region
      WHERE r_regionkey = 0
    UNION ALL SELECT 'silver/{lakehouse.ABSTRACT_TABLE}', count(*) FROM silver_abstracts""",
)
def empty_input_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic without data; its stage is skipped and reported."""
    paths = lakehouse.LakePaths(scratch_path(spark, "lake"))
    write_messages(_messages(spark, sf_dir), paths.bronze(lakehouse.ABSTRACT_TOPIC))
    reports = lakehouse.run_silver(spark, paths)
    return spark.createDataFrame([(r.stage, r.rows) for r in reports], "stage string, n_rows bigint")
