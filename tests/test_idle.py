"""The continuous landing: batches close when full or idle, and survive a stop."""

import json
import time

import pytest

from tideglass.functions.display import title_case
from tideglass.schemas import ABSTRACT_SCHEMA
from tideglass.sources import read_topic_stream
from tideglass.streaming import IdleLanding, land_bronze, read_landed, read_rejects


class Topic:
    def __init__(self, spark, root):
        self.spark, self.root, self.sent = spark, root, 0
        (root / "inbox").mkdir()
        self.path, self.offsets = str(root / "bronze"), str(root / "offsets")

    def send(self, *texts):
        self.sent += 1
        draft = self.root / f"draft-{self.sent}"
        draft.write_text("".join(t + "\n" for t in texts))
        draft.rename(self.root / "inbox" / f"m{self.sent:03d}")

    def start(self, **options):
        stream = read_topic_stream(self.spark, folder=str(self.root / "inbox"))
        return IdleLanding(stream, self.path, self.offsets, **{"poll": 0.1, **options})

    def landed(self):
        return sorted(r["text"] for r in read_landed(self.spark, self.path, ABSTRACT_SCHEMA).collect())


def message(text):
    return json.dumps({"text": text, "label": "l"})


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_a_batch_closes_when_full_and_when_idle(spark, topic):
    landing = topic.start(rows=3, idle=8)
    try:
        topic.send(message("a"), message("b"))
        topic.send(message("c"), "broken")
        landing.await_batches(1)
        assert landing.closed == [("full", 4)] and topic.landed() == ["a", "b", "c"]
        began = time.monotonic()
        topic.send(message("d"))
        time.sleep(3)
        assert len(landing.closed) == 1  # neither full nor idle yet
        topic.send(message("e"))  # the idle time begins anew with each message
        landing.await_batches(2)
        assert time.monotonic() - began >= 11
        assert landing.closed[1] == ("idle", 2) and topic.landed() == ["a", "b", "c", "d", "e"]
    finally:
        landing.stop()
    assert [r["value"] for r in read_rejects(spark, topic.path).collect()] == ["broken"]


def test_what_waits_is_landed_once_over_stops(topic):
    landing = topic.start(rows=100, idle=1000)
    topic.send(message("a"))
    landing.stop(land=False)
    assert landing.closed == []
    landing = topic.start(rows=100, idle=0.5)
    try:
        landing.await_batches(1)  # left by the run before, and idle since
        assert topic.landed() == ["a"]
        topic.send(message("b"))
    finally:
        landing.stop()
    assert topic.landed() == ["a", "b"]
    landing = topic.start(rows=1, idle=0.5)
    landing.stop()
    assert topic.landed() == ["a", "b"]


def test_a_landing_by_the_clock_runs_until_it_is_stopped(spark, topic):
    stream = read_topic_stream(spark, folder=str(topic.root / "inbox"))
    query = land_bronze(stream, topic.path, topic.offsets, every="200 milliseconds")
    try:
        for text in "ab":
            topic.send(message(text))
            query.processAllAvailable()
        assert query.isActive and topic.landed() == ["a", "b"]
    finally:
        query.stop()
    topic.send(message("c"))
    land_bronze(stream, topic.path, topic.offsets).awaitTermination()
    assert topic.landed() == ["a", "b", "c"]


def test_an_error_is_told(topic, monkeypatch):
    landing = topic.start(rows=1, idle=1000)

    def fail():
        raise OSError("lost")

    monkeypatch.setattr(landing, "_land", fail)
    topic.send(message("a"))
    with pytest.raises(OSError):
        landing.await_batches(1)
    with pytest.raises(OSError):
        landing.stop()


@pytest.mark.parametrize("text", ["cancer", "HEART failure", "all-cause mortality", "it's 5th x2y", "été ß", "", None])
def test_title_case(spark, text):
    from pyspark.sql import functions as F

    made = spark.range(1).select(title_case(F.lit(text).cast("string")).alias("t")).first()["t"]
    assert made == (None if text is None else text.title().replace("Ss", "ß".upper() if "ß" in text else "Ss"))
