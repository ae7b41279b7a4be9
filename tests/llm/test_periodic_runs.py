"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tideglass.llm import arrowtext, catalog, periodic_runs
from tideglass.llm.arrowtext import mix


def brute(words, least, exponent):
    """All runs by trying every period at every place: (start, period, length)."""
    seen = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in seen.items())


def drawn(seed):
    draw = random.Random(seed)
    n, letters = draw.randint(0, 170), draw.choice([1, 2, 2, 3, 6])
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.randint(0, 3)):
        if n > 6:
            a = draw.randrange(n)
            p, end = draw.randint(1, max(1, (n - a) // 3)), draw.randint(a, n)
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least,exponent", [(24, 3), (1, 3), (2, 2), (30, 2), (9, 4)])
def test_runs_equal_brute_force(least, exponent):
    for seed in range(250):
        words = drawn(seed)
        numbers = mix(np.array(words, dtype=np.uint64) + np.uint64(9))
        start, length, period = periodic_runs.find_runs(numbers, least, exponent)
        found = list(zip(start.tolist(), period.tolist(), length.tolist()))
        assert found == brute(words, least, exponent)


def test_one_word_a_million_times():
    start, length, period = periodic_runs.find_runs(np.full(1_000_000, 5, np.uint64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [1_000_000], [1])


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_pieces_change_nothing(monkeypatch, piece):
    draw = random.Random(3)
    texts = [" ".join(draw.choice("ab é") for _ in range(draw.randint(0, 90))) for _ in range(20)]
    texts += [None, "", " \t\n", "x\x0by " * 50, "été 中文 " * 20]
    want = periodic_runs.runs_of_texts(pa.array(texts)).to_pylist()
    monkeypatch.setattr(arrowtext, "PIECE_BYTES", piece)
    monkeypatch.setattr(periodic_runs, "WINDOW_STEP", piece)
    assert periodic_runs.runs_of_texts(pa.array(texts)).to_pylist() == want
    for text, found in zip(texts, want):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute(words, 24, 3)
        gone = {i for s, q, n in runs for i in range(s + q, s + n)}
        assert found["n_words"] == len(words)
        assert [(r["start"], r["period"], r["length"]) for r in found["runs"]] == runs
        assert found["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_odd_texts_and_no_rows(odd, none):
    found = periodic_runs.periodic_runs(odd).orderBy("doc_id", "text").collect()
    assert len(found) == odd.count() and found[0].asDict().keys() == {*odd.columns, "periodic"}
    by_id = {r["doc_id"]: r["periodic"] for r in found}
    assert by_id[1]["runs"] == [] and by_id[1]["collapsed"] == "" and by_id[3]["n_words"] == 0
    assert [tuple(r) for r in by_id[9]["runs"]] == [(0, 60_000, 1)] and by_id[9]["collapsed"] == "word"
    assert [r["periodic"] for r in found if r["doc_id"] == 6] == [by_id[6]] * 2
    assert periodic_runs.periodic_runs(none).collect() == []
    clash = odd.withColumnRenamed("kept", "periodic").withColumnRenamed("node", "collapsed")
    shorter = periodic_runs.collapse(clash)
    assert shorter.columns == clash.columns
    rows = {r["doc_id"]: r for r in shorter.collect()}
    assert rows[9]["text"] == "word" and rows[1]["text"] is None and rows[9]["periodic"] == "b"
    assert rows[10]["text"] == {r["doc_id"]: r for r in odd.collect()}[10]["text"]


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(11)
    rows = [(i, " ".join(draw.choice("abc") + "x" for _ in range(draw.randint(0, 80)))) for i in range(80)]
    rows += [(1000, None), (1001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in catalog.QUERIES["op13_dyadic_square_runs"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words, 24, 3)
        row = found[doc_id]
        assert row["n_runs"] == len(runs)
        lines = "".join(f"{s},{k},{q}\n" for s, q, k in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        gone = {i for s, q, k in runs for i in range(s + q, s + k)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        if runs:
            s, q, k = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1]))
            best = (row["start"], row["length"], row["period"], row["exponent_milli"])
            assert best == (s, k, q, 1000 * k // q)
        else:
            assert row["start"] is None and row["exponent_milli"] is None


def test_null_ids_are_not_changed(spark):
    text = "a b " * 30
    frame = spark.createDataFrame([(None, text)], "doc_id long, text string")
    assert catalog._with_made_repeats(frame).select(F.first("text")).first()[0] == text
