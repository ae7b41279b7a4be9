"""The pipeline's stages against brute force on their own inputs."""

import corpus_pipeline
import pytest
from tideglass.llm.common import materialize, read_table

from test_decontamination import brute as leaks
from test_near_duplicates import brute as groups
from test_secrets import plain


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(spark, stage(spark, out[-1], sf_dir), "test-stage"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_order_and_columns(outputs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality classifier", "near duplicates", "benchmark decontamination", "secret scans", "best-fit packing",
    ]
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns and df.dtypes == outputs[0].dtypes


def test_quality_goes_by_labels(spark):
    """At sf0.01, where there are enough labels to learn from."""
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, folder, "labels").collect()}
    documents = read_table(spark, folder, "documents")
    before = rows(documents)
    after = rows(corpus_pipeline.STAGES[0][1](spark, documents, folder))
    assert all(after[i] == before[i] for i in after)
    good = [i in after for i, label in labels.items() if label == 1]
    bad = [i in after for i, label in labels.items() if label == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_one_of_each_group(outputs):
    before, after = rows(outputs[1]), rows(outputs[2])
    component = groups([(i, r["text"]) for i, r in before.items()])
    assert set(after) == {i for i, c in component.items() if i == c}
    assert all(after[i] == before[i] for i in after)


def test_leaks_go(spark, sf_dir, outputs):
    items = [(r["item_id"], r["text"]) for r in read_table(spark, sf_dir, "benchmark").collect()]
    grams = set()
    from test_decontamination import words

    for _, text in items:
        own = words(text)
        size = min(10, len(own))
        grams |= {tuple(own[i : i + size]) for i in range(len(own) - size + 1) if size}
    sizes = {len(g) for g in grams}
    before, after = rows(outputs[2]), rows(outputs[3])
    for i, r in before.items():
        own = words(r["text"])
        hit = any(tuple(own[k : k + n]) in grams for n in sizes for k in range(len(own) - n + 1))
        assert (i in after) != hit
    assert leaks("", items, 10)[1] == 0


def test_secrets_are_masked(outputs):
    before, after = rows(outputs[3]), rows(outputs[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert plain(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if not plain(before[i]["text"]):
            assert r == before[i]


def test_all_is_packed(outputs):
    packed = outputs[5].collect()
    assert {r["doc_id"] for r in packed} == set(rows(outputs[4]))
    total = {}
    for r in packed:
        total[r["sequence_id"]] = total.get(r["sequence_id"], 0) + r["length"]
    assert max(total.values()) <= 1024 and len(total) <= sum(total.values()) // 1024 * 1.02 + 2


def test_run_gives_what_the_stages_give(spark, sf_dir, outputs):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(names).collect()) == sorted(outputs[5].select(names).collect())


def test_odd_and_no_documents(spark, odd, none, sf_dir):
    for frame in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, sf_dir)
            assert out.columns == frame.columns
            assert (out.count() == 0) if frame is none else True
        corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).collect()


def test_batches_of_texts_are_bounded(spark, sf_dir):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = read_table(spark, sf_dir, "documents")
    before = spark.conf.get(setting)
    for given, used in (("10000", corpus_pipeline.BATCH_ROWS), ("0", corpus_pipeline.BATCH_ROWS), ("7", 7)):
        spark.conf.set(setting, given)
        stage = corpus_pipeline.mask_secrets(spark, docs, sf_dir)
        assert int(spark.conf.get(setting)) == used
    assert stage.count() == docs.count()
    spark.conf.set(setting, before)
