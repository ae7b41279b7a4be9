"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; any texts are the unlabelled rest, toxic ones among
them. With the share ``prior`` of toxic texts, the risk of a classifier is
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: what the unlabelled texts cost as negatives,
less what their toxic part costs. When that difference turns negative the classifier has begun to
fit single texts, and the step goes the other way.

The features are words and beginnings of words that are more frequent among the positives than among
the unlabelled texts, and so much so that by the prior they are likelier in a toxic text than in
another; Spark counts them. The classifier is linear, in numpy, on samples of bounded
size: at most ``sample`` positives and twice as many unlabelled texts, by a hash of their ids. The
prior is the share of toxic rows among all labels that may be learned from, unless it is given. Every
text is scored whole.

A null or empty text holds no feature and gets the score of that. Ids may repeat: each row is scored.
Null ids are passed through and not learned from. Only the id and the text are looked at. Without any
positive, every score is 0.

An empty table gives no rows. Words of a very long text are hashed in pieces; some 100 bytes per word are held
while it is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import (
    ALPHANUMERIC,
    Words,
    mix,
    ragged,
    span_hash_in_pieces,
    steps,
    text_bytes,
)
from tideglass.llm.common import materialize

#: Positives learned from at most, and features of a classifier at most.
SAMPLE_POSITIVES, MOST_FEATURES = 3_000, 4_096
#: How many standard errors a feature's share among positives must lie above that of the rest, and
#: the least chance, by the prior, that a text with the feature is toxic.
DISTINCT, LIKELY = 6.0, 0.5
#: Bytes of the beginnings of words that count as features.
BEGINNINGS = (4, 6)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and beginnings of words of a batch, and the row of each."""
    words = Words(column, ALPHANUMERIC)
    data, _ = text_bytes(column)
    parts, rows = [words.hash], [words.doc]
    for n in BEGINNINGS:
        long = words.end - words.start > n
        start = words.start[long]
        parts.append(mix(span_hash_in_pieces(data, start, start + n, lower=True) + np.uint64(n)))
        rows.append(words.doc[long])
    return np.concatenate(parts), np.concatenate(rows)


@dataclass
class Classifier:
    """Sorted feature hashes, their weights, and the score of a text without any of them."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        hashes, rows = text_features(column)
        total = np.full(len(column), self.bias)
        row, at = self.present(hashes, rows)
        np.add.at(total, row, self.weights[at])
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))

    def present(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return present(self.features, hashes, rows)


def present(features: np.ndarray, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each feature that a row holds, once."""
    if len(features) == 0 or len(hashes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(features, hashes)
    at[at == len(features)] = 0
    hit = features[at] == hashes
    pair = np.unique(rows[hit] * np.int64(len(features)) + at[hit])
    return pair // len(features), pair % len(features)


def _losses(margin: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -margin)


def fit(x: np.ndarray, positive: np.ndarray, prior: float, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Weights and bias with the least non-negative risk, by Adam on all rows at once. ``x`` has a
    row of features per text, ``positive`` says which rows are confirmed."""
    x_p, x_u = x[positive], x[~positive]
    if len(x_p) == 0:
        return np.zeros(x.shape[1]), -40.0
    if len(x_u) == 0:
        x_u = np.zeros((1, x.shape[1]))
    theta = np.zeros(x.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior))
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    p, u = np.column_stack([x_p, np.ones(len(x_p))]), np.column_stack([x_u, np.ones(len(x_u))])
    for step in range(1, rounds + 1):
        f_p, f_u = p @ theta, u @ theta
        # Slopes of the mean logistic losses as positive and as negative.
        plus_p = -(p.T @ (1 / (1 + np.exp(f_p)))) / len(p)
        minus_p = (p.T @ (1 / (1 + np.exp(-f_p)))) / len(p)
        minus_u = (u.T @ (1 / (1 + np.exp(-f_u)))) / len(u)
        rest = _losses(-f_u).mean() - prior * _losses(-f_p).mean()
        if rest >= 0:
            slope = prior * plus_p + minus_u - prior * minus_p
        else:
            slope = -(minus_u - prior * minus_p)
        slope[:-1] += 1e-4 * theta[:-1]
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        theta -= 0.05 * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def _sampled_features(documents: DataFrame, sampled: DataFrame) -> DataFrame:
    def run(batches):
        for batch in steps(batches):
            hashes, rows = text_features(batch.column("text"))
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order], rows[order]
            fresh = np.ones(len(hashes), dtype=bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            begin = np.searchsorted(rows[fresh], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(begin.astype(np.int32)), pa.array(hashes[fresh].astype(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), lists], names=["positive", "features"]
            )

    rows = documents.join(F.broadcast(sampled), "doc_id").select("positive", "text")
    return rows.mapInArrow(run, "positive boolean, features array<long>")


def train_classifier(
    documents: DataFrame, labels: DataFrame, train: Column, prior: float | None, sample: int
) -> Classifier:
    """``documents``: ``doc_id``, ``text``; ``labels``: ``doc_id``, ``label``."""
    spark = documents.sparkSession
    known = labels.where(train & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    if prior is None:
        prior = known.agg(F.avg("label")).first()[0]
    none = Classifier(np.zeros(0, np.uint64), np.zeros(0), -40.0)
    if not prior:
        return none
    prior = min(float(prior), 1 - 1e-6)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    positives = known.where("label = 1").select("doc_id").distinct().orderBy(*by_hash).limit(sample)
    others = (
        documents.where(train & F.col("doc_id").isNotNull())
        .select("doc_id").distinct().orderBy(*by_hash).limit(2 * sample)
    )
    sampled = positives.withColumn("positive", F.lit(True)).unionByName(
        others.withColumn("positive", F.lit(False))
    )
    held = materialize(spark, _sampled_features(documents, sampled), "toxicity-sample")
    sizes = {row["positive"]: row["n"] for row in held.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if n_p == 0:
        return none

    share_p, share_u = F.col("p") / n_p, F.col("u") / max(n_u, 1)
    pooled = (F.col("p") + F.col("u")) / (n_p + n_u)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / max(n_u, 1))) + F.lit(1e-12)
    counted = (
        held.select("positive", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
        .withColumn("distinct", (share_p - share_u) / error)
        .where((F.col("distinct") >= DISTINCT) & (prior * share_p >= LIKELY * share_u))
        .orderBy(F.desc("distinct"), "feature")
        .limit(MOST_FEATURES)
    )
    features = np.sort(np.array([r["feature"] for r in counted.collect()], np.int64).astype(np.uint64))

    def run(batches):
        for batch in batches:
            lists = batch.column("features")
            begin = lists.offsets.to_numpy().astype(np.int64)
            hashes = lists.values.to_numpy()[ragged(begin[:-1], np.diff(begin))].astype(np.uint64)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(begin))
            row, at = present(features, hashes, rows)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(first), pa.array(at))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), found], names=["positive", "at"])

    table = held.mapInArrow(run, "positive boolean, at array<long>").toArrow()
    rows = sorted(zip(table["positive"].to_pylist(), table["at"].to_pylist()))
    x = np.zeros((len(rows), len(features)), dtype=np.float32)
    for i, (_, at) in enumerate(rows):
        x[i, at] = 1
    weights, bias = fit(x, np.array([p for p, _ in rows]), prior)
    return Classifier(features, weights, bias)


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    train: Column,
    label: str = "toxic",
    threshold: float = 0.5,
    prior: float | None = None,
    sample: int = SAMPLE_POSITIVES,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``score`` (0 to 1, higher if toxic is likelier)
    and ``predicted``. ``train`` says by column ``doc_id`` which labels may be learned from."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label).alias("label"))
    classifier = train_classifier(rows, known, train, prior, sample)

    def run(batches):
        for batch in steps(batches):
            score = classifier.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))
