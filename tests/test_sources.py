import os
import json
import time

import pytest
from pyspark.errors import AnalysisException

from tideglass import sources
from tideglass.schemas import ABSTRACT_SCHEMA, REQUEST_SCHEMA
from tideglass.session import (
    broker_address,
    build_session,
    clear_scratch,
    materialize,
    scratch_path,
    shared_folder,
    shuffle_conf,
    storage_conf,
)
from tideglass.sources.published import PublishedTable


def test_storage_conf_defaults_and_environment():
    conf = storage_conf({})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    conf = storage_conf({"MINIO_ENDPOINT_URL_DOCKER": "http://x", "MINIO_ACCESS_KEY": "k"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://x"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert broker_address({}) == "localhost:9092"


def test_kafka_options():
    options = sources.kafka_source_options(
        "h:1", "t", min_rows=100, max_delay="30s", max_rows=1000
    )
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": "100",
        "maxTriggerDelay": "30s",
        "maxOffsetsPerTrigger": "1000",
    }
    assert sources.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_missing_and_empty_bronze_are_empty(spark, tmp_path):
    assert sources.read_bronze(spark, str(tmp_path / "none"), ABSTRACT_SCHEMA).isEmpty()
    assert sources.read_bronze(spark, str(tmp_path / "none")).isEmpty()
    (tmp_path / "empty").mkdir()
    assert sources.read_bronze(spark, str(tmp_path / "empty"), ABSTRACT_SCHEMA).isEmpty()
    assert sources.read_table_or_none(spark, str(tmp_path / "none")) is None
    assert sources.read_table_or_none(spark, str(tmp_path / "empty")) is None
    with pytest.raises(AnalysisException):
        sources.read_table(spark, str(tmp_path / "none"))


def test_malformed_lines(spark, tmp_path):
    lines = ['{"text":"t","label":"l"}', "not json", '{"text":"u"}', '{"text":"v","label":"m","z":1}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    rows = sources.read_bronze(spark, str(tmp_path), ABSTRACT_SCHEMA).collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("t", "l"), ("u", None), ("v", "m"), (None, None),
    ]
    inferred = sources.read_bronze(spark, str(tmp_path))
    assert dict(inferred.dtypes)["z"] == "string"


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"say ""hi"", ok"\n2,\n"3","line\nbreak"\n')
    rows = sources.read_raw_csv(spark, str(tmp_path), multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'say "hi", ok'), ("2", ""), ("3", "line\nbreak")]
    nulls = sources.read_raw_csv(spark, str(tmp_path), multiline=True, keep_empty=False)
    assert nulls.filter("y IS NULL").count() == 1
    assert dict(sources.read_typed_csv(spark, str(tmp_path), multiline=True).dtypes)["x"] == "int"


def test_messages_keep_nulls(spark):
    frame = spark.createDataFrame([("a", None)], "x string, `y (%)` string")
    value = sources.to_messages(frame).first()["value"]
    assert json.loads(value) == {"x": "a", "y (%)": None}


def test_decode_marks_rejects(spark):
    items = ['{"text":"t","label":"l"}', "not json", "[1]", "5", '{"text":1}', None]
    frame = spark.createDataFrame([(v,) for v in items], "value string")
    rows = [tuple(r) for r in sources.decode_messages(frame, ABSTRACT_SCHEMA).collect()]
    assert rows == [
        ("t", "l", None),
        (None, None, "not json"),
        (None, None, "[1]"),
        (None, None, "5"),
        ("1", None, None),
        (None, None, None),
    ]


def test_rows_to_frame_casts(spark):
    row = {"Year": 2020, "DALYs": 5, "Average_Treatment_Cost_USD": 12.9, "Country": "C"}
    frame = sources.rows_to_frame(spark, [row], REQUEST_SCHEMA)
    assert [f.dataType for f in frame.schema] == [f.dataType for f in REQUEST_SCHEMA]
    first = frame.first()
    assert (first["Year"], first["DALYs"], first["Average_Treatment_Cost_USD"]) == (2020, 5.0, 12)
    assert first["Gender"] is None


def test_write_table(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id")
    assert sources.write_table(frame, path).count() == 1000
    assert sources.write_table(frame.limit(10), path, partition_by=["k"]).count() == 10
    assert sources.write_table(frame, path, cluster_by=["k", "id"], sample=5).count() == 5
    for own_path in (path, f"file://{path}", f"{path}/"):
        with pytest.raises(ValueError):
            sources.write_table(spark.read.parquet(path).filter("id > 1"), own_path)
    assert spark.read.parquet(path).count() == 1000


def test_clustered_lookup_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(1000).selectExpr("CAST(id % 5 AS STRING) AS k", "id")
    written = sources.write_table(frame, path, cluster_by=["k", "id"])
    plan = written.filter("k = '3'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class FakeSession:
    """A session without the setting, on a given master."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_copies_can_be_cleared(spark):
    kept = materialize(spark, spark.range(3), "x")
    assert kept.count() == 3
    folder = scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file://")
    assert os.listdir(folder)
    clear_scratch(spark)
    assert not os.path.exists(folder)


def test_store_settings_of_the_cluster_stay(spark):
    build_session("again", env={})
    assert spark.conf.get("spark.hadoop.fs.s3a.endpoint", None) is None


def test_scratch_needs_a_shared_folder_on_a_cluster():
    assert shared_folder(FakeSession("local[2]")) == shared_folder(FakeSession("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("yarn"))


def test_shuffle_conf():
    key = "spark.sql.shuffle.partitions"
    assert shuffle_conf(10**6, cores=8)[key] == "16"
    assert shuffle_conf(10**12, cores=8)[key] == "3726"
    assert shuffle_conf(10**14, cores=8000)[key] == "50000"


def test_versions_leave_readers_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    first = sources.write_version(spark.range(3), path)
    reader = spark.read.parquet(first)
    second = sources.write_version(reader.filter("id > 0"), path)
    assert first != second and reader.count() == 3 and spark.read.parquet(second).count() == 2
    assert sorted([first, second]) == [first, second]


def test_tables_hold_fingerprints_in_little_more_than_their_bytes(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("sha2(string(id), 256) AS record_hash")
    sources.write_table(rows.coalesce(1), str(tmp_path / "table"))
    size = sum(f.stat().st_size for f in (tmp_path / "table").glob("part-*"))
    assert size < 45 * 20_000
    assert spark.read.parquet(str(tmp_path / "table")).distinct().count() == 20_000


def test_messages_are_compressed_in_files_of_bounded_size(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "concat('a long name ', id % 7) AS a_field_that_repeats")
    folder = tmp_path / "messages"
    sources.write_messages(sources.to_messages(rows.coalesce(2)), str(folder), most=200)
    files = list(folder.glob("part-*"))
    assert len(files) >= 5 and all(f.name.endswith(".gz") for f in files)
    plain = sum(len(r["value"]) for r in sources.to_messages(rows).collect())
    assert sum(f.stat().st_size for f in files) < plain / 4
    assert sorted(sources.read_bronze(spark, str(folder), rows.schema).collect()) == sorted(rows.collect())
    streamed = sources.read_topic_stream(spark, folder=str(folder))
    query = streamed.writeStream.format("memory").queryName("compressed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("compressed").count() == 1000


def test_medallion_queries_send_compressed_messages(spark, sf_dir, monkeypatch):
    from pathlib import Path

    from tideglass.catalog import streams

    roots = []

    def kept(session, name):
        roots.append(scratch_path(session, name))
        return roots[-1]

    monkeypatch.setattr(streams, "scratch_path", kept)
    streams.silver_keeps_fields(spark, sf_dir)
    files = [f for root in roots for f in Path(root.removeprefix("file:")).rglob("bronze/*/part-*")]
    assert files and all(f.name.endswith(".gz") for f in files)


@pytest.mark.parametrize("slice_bytes", [1, 1 << 40])
def test_write_in_slices(spark, tmp_path, slice_bytes):
    rows = spark.createDataFrame(
        [(None if i % 7 == 0 else str(i % 7), i) for i in range(100)], "key string, n int"
    )
    path, sizes = str(tmp_path / "t"), []

    def make(some):
        sizes.append(some.count())
        return some.groupBy("key").agg({"n": "min"}).toDF("key", "n")

    rows.write.parquet(path)  # is replaced
    sources.write_in_slices(rows, path, "key", make, slices=4, slice_bytes=slice_bytes)
    assert sorted(spark.read.parquet(path).collect(), key=lambda r: r["n"]) == [
        (None if i == 0 else str(i), i) for i in range(7)
    ]
    assert len(sizes) == (4 if slice_bytes == 1 else 1) and sum(sizes) == 100
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    sources.write_in_slices(rows.where("false"), path, "key", make, slice_bytes=slice_bytes)
    assert spark.read.parquet(path).count() == 0
    with pytest.raises(ValueError):
        sources.write_in_slices(spark.read.parquet(path), path, "key", make)


def test_waves_hold_each_health_row_once(spark, sf_dir):
    from tideglass.catalog.health import raw_health, raw_health_waves

    waves = raw_health_waves(spark, sf_dir, waves=3)
    whole, parts = raw_health(spark, sf_dir), [w.count() for w in waves]
    assert min(parts) > 0 and sum(parts) == whole.count()
    assert waves[0].unionAll(waves[1]).unionAll(waves[2]).exceptAll(whole).isEmpty()


def test_shuffle_files_end_with_their_write(spark, tmp_path):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        found = (files.apply(i) for i in range(files.size()))
        return {f.getName() for f in found if f.getName().startswith("shuffle_") and f.length() > 10_000}

    before = shuffled()
    rows = spark.range(100_000, numPartitions=2).selectExpr("id", "sha2(string(id), 256) AS value").repartition(3, "id")
    sources.write_table(rows, str(tmp_path / "table"))
    sources.write_messages(rows, str(tmp_path / "messages"))
    PublishedTable(spark, str(tmp_path / "published")).replace(rows)
    for _ in range(100):  # workers are told, not waited for
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert spark.read.parquet(str(tmp_path / "table")).count() == rows.count() == 100_000
