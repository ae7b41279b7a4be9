"""Suffix arrays against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
from tideglass.llm import catalog
from tideglass.llm.arrowtext import ALPHANUMERIC, Words
from tideglass.llm.common import read_table
from tideglass.llm.decontamination import (
    build_shard,
    find,
    find_leaks,
    remove_leaks,
    suffix_array,
)
from tideglass.llm.decontamination import test_block as block_of

from compare import connect, difference

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window):
    """Words, hit words, ids of items, and the length of the longest match."""
    own = words(text)
    hit, ids, longest = set(), set(), 0
    for item, value in items:
        other = words(value)
        size = min(window, len(other))
        for i in range(len(own)):
            for j in range(len(other) - size + 1 if size else 0):
                n = 0
                while i + n < len(own) and j + n < len(other) and own[i + n] == other[j + n]:
                    n += 1
                if n >= size:
                    hit.update(range(i, i + size))
                    ids.add(str(item))
                    longest = max(longest, n)
    return len(own), len(hit), sorted(ids), longest


def test_suffix_order():
    draw = np.random.default_rng(1)
    numbers = np.append(draw.integers(0, 3, 400), -1)
    order = suffix_array(numbers, np.arange(400), 16)
    keys = [tuple(numbers[i : i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(400))


def test_random_texts_in_several_blocks(spark):
    draw = random.Random(2)
    text = lambda n: " ".join(draw.choices(["a", "B", "c,", "d-e", "é"], k=n))
    items = [(i, text(draw.randint(1, 12))) for i in range(20)] + [(3, "q r"), (None, "a a"), (30, None), (31, "--")]
    rows = [(i, text(draw.randint(0, 60))) for i in range(60)] + [(60, None), (60, "Q! r"), (None, "x q R y")]
    documents = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, hits string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if i is not None]
    expected = sorted(((i or -1, t or ""), brute(t, known, 5)) for i, t in rows)
    for size in (8 << 20, 60):
        found = find_leaks(documents, benchmark, 5, block_bytes=size).collect()
        got = sorted(
            (r["doc_id"] or -1, (r["n_words"], sum(s["end"] - s["start"] for s in r["hits"]), r["items"], r["longest"]))
            for r in found
        )
        assert got == sorted((k[0], v) for k, v in expected)
    kept = remove_leaks(documents, benchmark, 5)
    assert kept.columns == documents.columns
    assert kept.count() == sum(v[1] == 0 for _, v in expected)


def test_places_of_the_longest_match():
    block = block_of(pa.table({"item_id": [1], "text": ["one two three four five six"]}), 3)
    column = pa.array(["zero one two three x", "y two three four five six", "one two"])
    shard = build_shard(Words(column, ALPHANUMERIC), block)
    found = find(shard, block)
    assert found.longest.max() == 5
    assert shard.row[found.longest > 0].tolist() == [0, 1, 1, 1]


def test_no_items_and_no_documents(spark, odd, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    found = find_leaks(odd, benchmark).collect()
    assert len(found) == odd.count() and all(r["hits"] == [] and r["items"] == [] for r in found)
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    assert find_leaks(none, items).collect() == []
    hits = [r for r in find_leaks(odd, items).collect() if r["items"]]
    assert len(hits) == 4 and {(r["longest"], r["longest_at"]) for r in hits} == {(3, 1)}


def test_query_equals_sql(spark, sf_dir):
    name = "op9_suffix_array_decontamination"
    assert difference(catalog.QUERIES[name](spark, sf_dir), connect(sf_dir), catalog.SQL[name]) is None


def test_hashes_keep_rows_apart(spark, sf_dir):
    rows = [r["text"] for r in read_table(spark, sf_dir, "documents").limit(50).collect()]
    found = Words(pa.array(rows), ALPHANUMERIC)
    assert found.count.tolist() == [len(words(t)) for t in rows]
    flat = [w for t in rows for w in words(t)]
    assert len(set(flat)) == len(set(found.hash.tolist()))
