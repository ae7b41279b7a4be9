"""The Bloom filter model against plain counting."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tideglass.llm import bloom_lm
from tideglass.llm.common import read_table, remainder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\0end"]


def training():
    return F.coalesce(remainder(F.col("doc_id"), 7) != 2, F.lit(False))


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(words(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        tokens = words(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        out.append((doc_id, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 6)))
    return out


def plain(found):
    return [
        (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in found
    ]


def test_levels():
    counts = np.array([1, 2, 3, 10, 1000, 10**7])
    levels = bloom_lm.level(counts)
    assert (np.diff(levels) > 0).all() and levels[0] == 1
    assert (np.abs(np.log(bloom_lm.level_count(levels) / counts)) < math.log(bloom_lm.BASE)).all()
    assert bloom_lm.level_count(np.array([0])) == 0


def test_the_filter_never_forgets():
    draw = np.random.default_rng(1)
    grams = np.unique(draw.integers(0, 2**63, 20_000).astype(np.uint64))
    counts = draw.integers(1, 500, len(grams))
    segment = np.frombuffer(bloom_lm.build_segment(grams, counts), np.uint8)
    found = bloom_lm.probe(segment, grams)
    assert (found >= bloom_lm.level(counts)).all()
    assert (found == bloom_lm.level(counts)).mean() > 0.9
    absent = draw.integers(0, 2**63, 20_000).astype(np.uint64)
    assert (bloom_lm.probe(segment, absent) > 0).mean() < 0.06


def test_all_segments_are_probed_at_once(monkeypatch):
    """As many passes as there are tags, however many segments; ranges of other waves have level 0."""
    draw, power = np.random.default_rng(2), 6
    grams = np.unique(draw.integers(0, 2**64, 20_000, dtype=np.uint64))
    counts = draw.integers(1, 500, len(grams))
    part = bloom_lm._part(grams, power)
    sent = [i for i in range(1 << power) if i % 3]
    bits = [bloom_lm.build_segment(grams[part == i], counts[part == i]) for i in sent]
    segments = bloom_lm.Segments.of(sent, [len(b) for b in bits], b"".join(bits), power)
    asked = np.unique(np.append(grams, draw.integers(0, 2**64, 5_000, dtype=np.uint64)))
    home = bloom_lm._part(asked, power)
    alone = np.zeros(len(asked), np.uint8)
    for i, segment in zip(sent, bits):
        alone[home == i] = bloom_lm.probe(np.frombuffer(segment, np.uint8), asked[home == i])
    passes, place = [], bloom_lm._place
    monkeypatch.setattr(bloom_lm, "_place", lambda *given: passes.append(1) or place(*given))
    found = bloom_lm._levels(asked, power, segments)
    assert (found == alone).all() and (found[home % 3 == 0] == 0).all() and (found > 0).any()
    assert len(passes) <= int(found.max()) + 1


def test_memory_of_sums_goes_back(monkeypatch):
    """A worker that has summed waits beside those of the next stage."""
    returned = []
    monkeypatch.setattr(bloom_lm, "give_back", lambda: returned.append(1))
    batches = [pa.record_batch([pa.array(["a b a", None, "c"])], names=["text"])]
    parts = list(bloom_lm._sums(iter(batches), lambda t: [t.hash]))
    assert returned and int(parts[0][1].sum()) == 7


def test_counts_are_packed_without_loss():
    counts = np.array([1, 254, 255, 256, 10**12, 3])
    assert bloom_lm._unpacked(bloom_lm._packed(counts)).tolist() == counts.tolist()


def test_base_scores_and_model(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = bloom_lm.score(documents, training()).collect()
    assert sorted(plain(found)) == sorted(expected(rows))
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_equal_a_model_by_plain_counts(spark, sf_dir):
    """The model with levels of true counts. A filter may only add a level to an n-gram, rarely."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    single, pair = Counter(), Counter()
    for doc_id, text in rows:
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            tokens = words(text)
            single.update(tokens)
            pair.update(zip([tokens[-1], *tokens], tokens))

    def count(n):
        return float(bloom_lm.level_count(bloom_lm.level(np.array([n])))[0]) if n else 0.0

    total, distinct = sum(single.values()), len(single)
    by_id = {r["doc_id"]: r["score"] for r in bloom_lm.score(documents, training()).collect()}
    apart = []
    for doc_id, text in rows:
        tokens, value = words(text), 0.0
        for before, word in zip([tokens[-1], *tokens], tokens):
            context = count(single[before])
            both = min(count(pair[before, word]), context)
            alone = (count(single[word]) + 1) / (total + distinct + 1)
            value += math.log10((both + bloom_lm.MU * alone) / (context + bloom_lm.MU))
        apart.append(abs(by_id[doc_id] - value) / len(tokens))
    assert sorted(apart)[len(apart) // 2] < 0.02 and max(apart) < 0.25


@pytest.fixture()
def small_ranges(monkeypatch):
    monkeypatch.setattr(bloom_lm, "RANGE_GRAMS", 256)


def test_waves_and_rare_words_change_nothing(spark, sf_dir, small_ranges):
    documents = read_table(spark, sf_dir, "documents").where("doc_id < 40")
    one = bloom_lm.score(documents, training()).collect()
    many = bloom_lm.score(documents, training(), wave_bytes=20_000, head_words=10).collect()
    assert sorted(plain(one)) == sorted(plain(many))
    for a, b in zip(sorted(one), sorted(many)):
        assert a["score"] == pytest.approx(b["score"], rel=1e-12)


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = bloom_lm.score(odd, training()).collect()
    assert Counter(plain(found)) == Counter(expected(rows))
    assert bloom_lm.score(none, training()).collect() == []
    untrained = bloom_lm.score(odd, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in untrained} == {(0, 0)}


def test_probabilities_sum_to_one_nearly():
    """Over all words after one context, with counts that levels hold exactly."""
    level_of = lambda c: bloom_lm.level(np.array([c]))[0]
    tokens = bloom_lm.Tokens(pa.array(["a"]))
    single = np.array([level_of(1), level_of(1)], dtype=np.uint8)
    pair = np.array([level_of(1), 0], dtype=np.uint8)
    value = bloom_lm._log_probability(tokens, single, pair, 2, 2, 1.0)
    alone = 2 / 5
    assert 10 ** value[0] == pytest.approx((1 + alone) / 2 * (0 + alone) / 2)
