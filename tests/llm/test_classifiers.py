"""Quality and toxicity: exact inference, held-out accuracy, odd rows."""

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tideglass.llm import catalog, line_quality, toxicity
from tideglass.llm.common import read_table, remainder


def training(modulus=5):
    return F.coalesce(remainder(F.col("doc_id"), modulus) != 0, F.lit(False))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_forward_backward_equals_enumeration():
    draw = np.random.default_rng(1)
    first = np.array([0, 3, 4, 9])
    emit, follow = draw.standard_normal((9, 2)), draw.standard_normal((2, 2))
    marginal, pairs = line_quality.forward_backward(emit, follow, first)
    expected_pairs = np.zeros((2, 2))
    for a, b in itertools.pairwise(first):
        total, single, both = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for labels in itertools.product([0, 1], repeat=b - a):
            score = sum(emit[a + i, y] for i, y in enumerate(labels))
            score += sum(follow[x, y] for x, y in itertools.pairwise(labels))
            total += np.exp(score)
            for i, y in enumerate(labels):
                single[i, y] += np.exp(score)
            for x, y in itertools.pairwise(labels):
                both[x, y] += np.exp(score)
        assert np.exp(marginal[a:b]) == pytest.approx(single / total)
        expected_pairs += both / total
    assert pairs == pytest.approx(expected_pairs)


def test_lines_and_their_neighbours():
    lines = line_quality.line_features(pa.array(["ONE two\n\nx x x\n", None, "", "a|b"]))
    assert lines.first.tolist() == [0, 4, 5, 6, 7]
    assert lines.bytes.tolist() == [8, 1, 6, 0, 0, 0, 3]
    own = line_quality.OWN
    upper, again = line_quality._KINDS, line_quality._KINDS + 1
    assert lines.features[0, upper] == 0.5 and lines.features[2, again] == pytest.approx(2 / 3)
    assert (lines.features[1, own : 2 * own] == lines.features[0, :own]).all()
    assert (lines.features[1, 2 * own : 3 * own] == lines.features[2, :own]).all()
    assert (lines.features[[4, 5, 6], own : 3 * own] == 0).all()
    assert (lines.features[:, -1] == 1).all()


def accuracy(spark, query, label):
    """On rows kept out of training, at sf0.01, where labels suffice."""
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[label] for r in read_table(spark, folder, "labels").collect()}
    rows = catalog.QUERIES[query](spark, folder).collect()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    out = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return np.mean([a == b for a, b in out]), np.mean([b for a, b in out if a == 1])


def test_quality_of_held_out_documents(spark):
    right, found = accuracy(spark, "op6_crf_line_quality", "quality")
    assert right >= 0.97 and found >= 0.97


def test_toxicity_of_held_out_documents(spark):
    right, _ = accuracy(spark, "op7_nonnegative_pu_toxicity", "toxic")
    assert right >= 0.9


def test_quality_of_odd_rows(spark, odd, none, sf_dir):
    labels = read_table(spark, sf_dir, "labels")
    scored = line_quality.score_quality(odd, labels.limit(0), F.lit(True)).collect()
    assert len(scored) == odd.count() and {r["score"] for r in scored} == {0.5}
    one_kind = spark.createDataFrame([(4, 1), (5, 1), (5, None), (6, 7)], "doc_id long, quality int")
    assert len({r["score"] for r in line_quality.score_quality(odd, one_kind, F.lit(True)).collect()}) == 1
    both = spark.createDataFrame([(4, 1), (5, 1), (8, 0), (8, 0), (9, 0), (2, 1), (None, 0)], "doc_id long, quality int")
    scored = line_quality.score_quality(odd, both, F.lit(True))
    score = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert score[1] == score[2] and score[9] < score[5]
    kept = line_quality.keep_good(odd, both, F.lit(True), threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert line_quality.keep_good(odd, both, F.lit(True), threshold=1.1).count() == 0
    clash = odd.withColumnRenamed("node", "_score").withColumnRenamed("kept", "score_")
    rows = line_quality.keep_good(clash, both, F.lit(True), threshold=0.0).collect()
    assert {(r["_score"], r["score"], r["score_"]) for r in rows} == {("a", 2.0, "b")}
    assert line_quality.score_quality(none, both, F.lit(True)).collect() == []


def test_risk_finds_the_feature_of_the_positives():
    draw = np.random.default_rng(4)
    toxic = draw.random(4000) < 0.2
    x = np.column_stack([toxic & (draw.random(4000) < 0.9), draw.random(4000) < 0.5]).astype(np.float32)
    positive = x[toxic][:300]
    rows = np.vstack([positive, x])
    known = np.r_[np.ones(len(positive), bool), np.zeros(len(x), bool)]
    weights, bias = toxicity.fit(rows, known, 0.2)
    predicted = x @ weights + bias >= 0
    assert (predicted == (x[:, 0] == 1)).all()
    assert toxicity.fit(rows[~known], known[~known], 0.2)[1] < -30


def plain_fit(rows, positive, prior, rounds):
    """The non-negative risk minimised row by row and weight by weight, in plain loops."""
    number = len(rows[0]) + 1
    rows = [[*map(float, r), 1.0] for r in rows]
    confirmed = [r for r, p in zip(rows, positive) if p]
    others = [r for r, p in zip(rows, positive) if not p]
    theta = [0.0] * (number - 1) + [math.log(prior / (1 - prior))]
    moment, square = [0.0] * number, [0.0] * number

    def margin(row):
        return sum(a * b for a, b in zip(row, theta))

    def mean(values):
        return sum(values) / len(values)

    for step in range(1, rounds + 1):
        cost_u = mean([math.log1p(math.exp(margin(r))) for r in others])
        cost_p = mean([math.log1p(math.exp(margin(r))) for r in confirmed])
        slope = []
        for j in range(number):
            plus_p = mean([-r[j] / (1 + math.exp(margin(r))) for r in confirmed])
            minus_p = mean([r[j] / (1 + math.exp(-margin(r))) for r in confirmed])
            minus_u = mean([r[j] / (1 + math.exp(-margin(r))) for r in others])
            if cost_u - prior * cost_p >= 0:
                slope.append(prior * plus_p + minus_u - prior * minus_p)
            else:
                slope.append(prior * minus_p - minus_u)
        for j in range(number):
            slope[j] += 1e-4 * theta[j] if j < number - 1 else 0.0
            moment[j] = 0.9 * moment[j] + 0.1 * slope[j]
            square[j] = 0.999 * square[j] + 0.001 * slope[j] ** 2
            theta[j] -= 0.05 * moment[j] / (1 - 0.9**step) / (math.sqrt(square[j] / (1 - 0.999**step)) + 1e-9)
    return theta


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_fit_equals_plain_loops(prior):
    draw = np.random.default_rng(7)
    x = (draw.random((60, 3)) < 0.4).astype(np.float32)
    positive = np.arange(60) < 20
    x[:16, 0] = 1
    weights, bias = toxicity.fit(x, positive, prior, rounds=150)
    assert [*weights, bias] == pytest.approx(plain_fit(x.tolist(), positive.tolist(), prior, 150), rel=1e-6)


def test_scores_equal_plain_sets_of_features():
    texts = ["Ab cdefgh, abcdefgh!", None, "", "été ABCDEFG x1", "zz " * 50 + "abcdef", "cdefghi"]

    def plain(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        raw = [w.encode() for w in words]
        return {(0, w) for w in raw} | {(n, w[:n]) for n in toxicity.BEGINNINGS for w in raw if len(w) > n}

    known = {}
    for text in texts:
        hashes, _ = toxicity.text_features(pa.array([text]))
        assert len(set(hashes.tolist())) == len(plain(text))
        for f in plain(text):
            if f[0] == 0:
                known[f] = int(toxicity.text_features(pa.array([f[1].decode()]))[0][0])
    chosen = sorted(known, key=lambda f: known[f])[::2]
    weights = {f: 0.5 * i - 1 for i, f in enumerate(chosen)}
    classifier = toxicity.Classifier(
        np.array([known[f] for f in chosen], np.uint64), np.array([weights[f] for f in chosen]), -0.25
    )
    want = [1 / (1 + math.exp(0.25 - sum(w for f, w in weights.items() if f in plain(t)))) for t in texts]
    assert classifier.score(pa.array(texts)).tolist() == pytest.approx(want, rel=1e-12)


def test_toxicity_of_odd_rows(spark, odd, none):
    nobody = spark.createDataFrame([(5, 0), (6, None)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(odd, nobody, F.lit(True)).collect()
    assert len(scored) == odd.count() and max(r["score"] for r in scored) < 1e-9
    some = spark.createDataFrame([(7, 1), (5, 0), (None, 1), (7, 1)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(odd, some, F.lit(True)).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.score_toxicity(none, some, F.lit(True)).collect() == []
