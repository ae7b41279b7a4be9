"""One-permutation hashing against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from tideglass.llm import catalog, near_duplicates
from tideglass.llm.arrowtext import Words

from compare import connect, difference

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Component of each id, for rows of (id, text) without null ids."""
    sets = [(i, shingles(t)) for i, t in rows]
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def test_query_equals_sql(spark, sf_dir):
    name = "op5_minhash_near_duplicates"
    assert difference(catalog.QUERIES[name](spark, sf_dir), connect(sf_dir), catalog.SQL[name]) is None


def made_group(draw):
    """Copies of one text with a few to many edits: some link, many lie just below the bound; a chain
    in which each text links only with the next; exact copies."""
    base = [f"w{draw.randint(0, 400)}" for _ in range(90)]
    texts = [base] * 5
    for _ in range(110):
        copy = list(base)
        for _ in range(draw.randint(1, 6)):
            copy[draw.randrange(len(copy))] = f"v{draw.randint(0, 10**6)}"
        texts.append(copy[draw.choice([0, 0, 4, 10]) :])
    step = [f"c{i}" for i in range(60)]
    for k in range(20):
        texts.append(step)
        step = [*step[3:], f"n{k}a", f"n{k}b", f"n{k}c"]
    texts += [[f"u{draw.randint(0, 10**6)}" for _ in range(draw.randint(1, 40))] for _ in range(20)]
    order = list(range(len(texts)))
    draw.shuffle(order)
    return [(i, " ".join(texts[k])) for i, k in enumerate(order)]


def test_groups_near_the_bound(spark):
    rows = made_group(random.Random(8))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in near_duplicates.near_duplicates(frame).collect()}
    expected = brute(rows)
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert all(r["kept"] == (expected[i] == i) for i, r in found.items())
    assert all(found[i]["n_shingles"] == len(shingles(t)) for i, t in rows)


def test_odd_rows(odd, none):
    found = Counter(map(tuple, near_duplicates.near_duplicates(odd).collect()))
    quick = 11
    assert found[(5, quick, 5, True)] == 1 and found[(6, quick, 5, False)] == 2
    assert found[(None, quick, 5, False)] == 1 and found[(None, 0, None, True)] == 1
    for i in (1, 2, 3):
        assert found[(i, 0, i, True)] == 1
    assert found[(4, 1, 4, True)] == 1 and found[(9, 1, 9, True)] == 1
    assert near_duplicates.near_duplicates(none).collect() == []


def test_one_row_of_each_group_stays(odd, none):
    kept = near_duplicates.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert [i for null, i in ids if not null] == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert sum(null for null, _ in ids) == 1  # the one without text
    repeated = odd.where("doc_id = 6 OR doc_id = 4")
    assert sorted(r["doc_id"] for r in near_duplicates.keep_one(repeated).collect()) == [4, 6]
    assert near_duplicates.keep_one(none).collect() == []


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(3)
    shared = draw.integers(0, 2**63, 300).astype(np.uint64)
    own = draw.integers(0, 2**63, (2, 50)).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, o])) for o in own]
    begin = np.cumsum([0, *map(len, sets)])
    a, b = near_duplicates.signatures(np.concatenate(sets), begin, 300)
    assert abs((a == b).mean() - 300 / 400) < 0.1


def test_short_and_empty_sets_have_full_signatures():
    words = Words(pa.array(["", "one two", "a b c d e f", None]))
    sets, begin = near_duplicates.shingle_sets(words, 5)
    assert np.diff(begin).tolist() == [0, 1, 2, 0]
    found = near_duplicates.signatures(sets, begin, 300)
    assert (found[[0, 3]] == 0).all() and set(found[1]) == set(sets[begin[1] : begin[2]])
    assert set(found[2]) == set(sets[begin[2] : begin[3]])


def test_ids_of_text_and_names_the_operator_uses(spark):
    same = "one two three four five six seven eight nine ten eleven twelve"
    near = same + " thirteen fourteen"
    rows = [("b", same, 1, "k"), ("a", same, 2, "k"), ("c", near, 3, "k"), (None, same, 4, "k"), ("z", "other words", 5, "k")]
    rows += [("z", "other words", 5, "k"), (None, "quite alone", 6, "k")]
    frame = spark.createDataFrame(rows, "doc_id string, text string, rank int, key string")
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in near_duplicates.near_duplicates(frame).collect()}
    assert found["b", 8] == found["a", 8] == found["c", 10] == found[None, 8] == "a"
    kept = near_duplicates.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or "-", r["rank"], r["key"]) for r in kept.collect()) == [
        ("-", 6, "k"), ("a", 2, "k"), ("z", 5, "k"),
    ]
    numbers = spark.createDataFrame([(None, same, 7), (1, same, 8)], "doc_id int, text string, _id int")
    assert [tuple(r) for r in near_duplicates.keep_one(numbers).collect()] == [(1, same, 8)]


def test_bitmaps_rule_out_pairs_without_a_link(spark, monkeypatch):
    """Texts of passages in two versions share every shingle with some other text and are far from being
    near duplicates of any but their exact neighbours; hardly a pair is looked at."""
    rng = random.Random(5)
    passages = [[[f"w{p}v{v}x{i}" for i in range(10)] for v in range(2)] for p in range(20)]
    texts = []
    for _ in range(60):
        flipped = set(rng.sample(range(20), 4))
        texts.append(" ".join(w for p in range(20) for w in passages[p][p in flipped]))
    texts += [" ".join(t.split()[:-1] + ["end"]) for t in texts[:5]]  # near duplicates of the first
    looked_at = []
    plain = near_duplicates.confirmed

    def counted(pairs, sets, percent):
        looked_at.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(near_duplicates, "confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(docs).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    least = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    linked = sum(
        100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a in range(len(texts)) for b in range(a)
    )
    assert [found[i] for i in range(len(texts))] == least
    assert sum(looked_at) <= 2 * linked


def test_bitmaps_bound_what_a_set_lacks():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (0, 1, 300, 4000)]
    sets.append(np.unique(np.concatenate([sets[2][:200], sets[3][:50]])))
    begin = np.cumsum([0] + [len(s) for s in sets])
    bits = near_duplicates.bitmaps(np.concatenate(sets), begin)
    for a, one in zip(bits, sets):
        for b, other in zip(bits, sets):
            lacking = sum(bin(int(x)).count("1") for x in a & ~b)
            assert lacking <= len(np.setdiff1d(one, other))


def test_settled_buckets_are_not_looked_at_again(spark, monkeypatch):
    """Rounds of more centres go on with the buckets that the round before has left open."""
    taken = Counter()
    plain = near_duplicates.materialize

    def counted(session, frame, name):
        out = plain(session, frame, name)
        taken[name] += out.count()
        return out

    monkeypatch.setattr(near_duplicates, "materialize", counted)
    rows = made_group(random.Random(8))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(frame).collect()}
    assert found == brute(rows)
    assert taken["seen"] <= 3300
