"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. The field scores a line by features of the line and of its
neighbours, and neighbouring labels by how often they follow each other; forward-backward gives each
line its probability of being good. Their mean, weighted by the lines' bytes, is the document's raw
quality, which a one-dimensional logistic curve turns into the probability of label 1.

Training lines take the label of their document. The model is fitted with numpy on a sample of at
most ``sample`` labelled documents, chosen by a hash of their ids; features are computed in Spark and
only numbers of sampled documents reach the driver. Every text is scored whole.

A null or empty text is one empty line, and has a score as well. Repeated documents are scored one by
one, null ids are passed through and never trained on. Only the id and the text are looked at.
Labels of a repeated id are averaged; ids without a label of 0 or 1 are not trained on. If the sample holds
less than both labels, every score is the smoothed share of label 1.

An empty table gives no rows. Of a very long text the features of all its lines are held at once,
about 400 bytes a line; a task that cannot hold them fails.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import SPACED, Words, steps, text_bytes
from tideglass.llm.common import with_text_column

#: Documents the model is fitted on at most.
SAMPLE_DOCUMENTS = 6_000

#: Classes of bytes whose shares are features.
_CLASSES = [
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "abcdefghijklmnopqrstuvwxyz",
    "0123456789",
    ".,;:",
    "!?",
    "|",
    "#*$%&@^~+=<>/\\_",
    "()[]{}\"'`-",
    " \t\r\n",
]
_CLASS = np.full(256, len(_CLASSES), dtype=np.int64)
for _i, _members in enumerate(_CLASSES):
    _CLASS[[ord(c) for c in _members]] = _i
_CLASS[128:] = len(_CLASSES) + 1
_KINDS = len(_CLASSES) + 2
#: Own features of a line; with those of both neighbours and a constant, the field's features.
OWN = _KINDS + 6
FEATURES = 3 * OWN + 1


@dataclass
class Lines:
    """Features of the lines of a batch, their bytes, and the first line of each text."""

    features: np.ndarray
    bytes: np.ndarray
    first: np.ndarray


def line_features(column: pa.Array) -> Lines:
    data, offsets = text_bytes(column)
    breaks = np.flatnonzero(data == 0x0A) + 1
    start = np.sort(np.concatenate([offsets[:-1], breaks]), kind="stable")
    # A break at the very end of a text begins an empty last line; the next text has its own start.
    first = np.searchsorted(breaks, offsets[:-1], side="right") + np.arange(len(offsets) - 1)
    first = np.append(first, len(start))
    size = np.diff(np.append(start, len(data)))
    lines = len(start)
    owner = np.repeat(np.arange(lines), size)
    counts = np.bincount(owner * _KINDS + _CLASS[data], minlength=lines * _KINDS)
    counts = counts.reshape(lines, _KINDS).astype(float)
    shares = counts / np.maximum(size, 1)[:, None]
    letters = counts[:, 0] + counts[:, 1]

    words = Words(column, SPACED)
    line = np.searchsorted(start, words.start, side="right") - 1
    number = np.bincount(line, minlength=lines).astype(float)
    some = np.maximum(number, 1)
    again = (words.hash[1:] == words.hash[:-1]) & (line[1:] == line[:-1])
    again = np.bincount(line[1:][again], minlength=lines)
    key = np.sort((line.astype(np.uint64) << np.uint64(40)) | (words.hash >> np.uint64(24)))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=lines)
    length = np.bincount(line, weights=(words.end - words.start), minlength=lines)
    own = np.column_stack(
        [
            shares,
            counts[:, 0] / np.maximum(letters, 1),
            again / some,
            1 - distinct / some,
            np.minimum(length / some, 40) / 10,
            np.log1p(number) / 5,
            number == 0,
        ]
    )
    before = np.zeros_like(own)
    after = np.zeros_like(own)
    before[1:] = own[:-1]
    after[:-1] = own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    constant = np.ones((lines, 1))
    return Lines(np.hstack([own, before, after, constant]), size, first)


@dataclass
class Field:
    """A fitted field: ``weights`` of a good line, scores ``follow[a, b]`` of label b after a, and the
    curve ``slope``, ``shift`` from the log-odds of the raw quality to those of label 1."""

    weights: np.ndarray
    follow: np.ndarray
    slope: float
    shift: float


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=-1, keepdims=True)))[..., 0]


def forward_backward(emit: np.ndarray, follow: np.ndarray, first: np.ndarray):
    """Marginal log-probabilities of both labels of every line, and the expected label pairs of all
    texts; ``emit`` has a score of each label per line. All texts go through side by side, line
    number by line number."""
    count = np.diff(first)
    forward, backward = emit.copy(), np.zeros_like(emit)
    order = np.argsort(-count, kind="stable")
    longest = int(count.max()) if len(count) else 0
    with_line = np.searchsorted(-count[order], -np.arange(longest + 1), side="left")
    for t in range(1, longest):
        at = first[:-1][order[: with_line[t]]] + t
        forward[at] += _log_sum(forward[at - 1][:, None, :] + follow.T)
    for t in range(longest - 2, -1, -1):
        at = first[:-1][order[: with_line[t + 1]]] + t
        backward[at] = _log_sum(follow + (emit[at + 1] + backward[at + 1])[:, None, :])
    both = forward + backward
    marginal = both - _log_sum(both)[:, None]
    inner = np.ones(len(emit), dtype=bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pair = forward[at - 1][:, :, None] + follow + (emit[at] + backward[at])[:, None, :]
    flat = pair.reshape(len(at), 4)
    pairs = np.exp(flat - _log_sum(flat)[:, None]).sum(axis=0).reshape(2, 2) if len(at) else np.zeros((2, 2))
    return marginal, pairs


def raw_quality(lines: Lines, weights: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Mean probability of good lines, by bytes; lines without bytes count as one byte."""
    score = lines.features @ weights
    emit = np.column_stack([np.zeros(len(score)), score])
    marginal, _ = forward_backward(emit, follow, lines.first)
    weight = np.maximum(lines.bytes, 1)
    texts = len(lines.first) - 1
    owner = np.repeat(np.arange(texts), np.diff(lines.first))
    good = np.bincount(owner, weights=weight * np.exp(marginal[:, 1]), minlength=texts)
    return good / np.bincount(owner, weights=weight, minlength=texts)


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(lines: Lines, label: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> Field:
    """A field from texts with labels 0 or 1. Texts weigh the same in both classes together, each
    line by its share of the text; the curve uses the classes as frequent as they are."""
    share = (label.sum() + 1) / (len(label) + 2)
    if len(np.unique(label)) < 2:
        return Field(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    texts = len(label)
    owner = np.repeat(np.arange(texts), np.diff(lines.first))
    mean, scale = lines.features.mean(axis=0), lines.features.std(axis=0)
    scale[scale < 1e-9] = 1
    mean[-1], scale[-1] = 0, 1
    x = (lines.features - mean) / scale
    y = label[owner]
    per_class = np.bincount(label, minlength=2)
    weight = 0.5 / per_class[y] / np.diff(lines.first)[owner]
    inner = np.ones(len(x), dtype=bool)
    inner[lines.first[:-1]] = False
    at = np.flatnonzero(inner)
    observed = np.bincount(y[at - 1] * 2 + y[at], minlength=4).reshape(2, 2) / max(len(at), 1)
    w, follow = np.zeros(FEATURES), np.zeros((2, 2))
    moment, square = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    for step in range(1, rounds + 1):  # Adam on the weighted likelihood
        score = x @ w
        emit = np.column_stack([np.zeros(len(score)), score])
        marginal, pairs = forward_backward(emit, follow, lines.first)
        slope_w = x.T @ (weight * (np.exp(marginal[:, 1]) - y)) + decay * w
        slope_f = pairs / max(len(at), 1) - observed + decay * follow
        slope = np.concatenate([slope_w, slope_f.ravel()])
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        change = moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        w -= 0.05 * change[:FEATURES]
        follow -= 0.05 * change[FEATURES:].reshape(2, 2)
    w = w / scale
    w[-1] -= (w[:-1] * mean[:-1]).sum()
    slope, shift = _curve(_log_odds(raw_quality(lines, w, follow)), label)
    return Field(w, follow, slope, shift)


def _curve(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps on smoothed labels."""
    ones = label.sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    a, b = 0.1, 0.0
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = _sigmoid(a * x + b)
        slope = design.T @ (p - target) + np.array([1e-3 * a, 0])
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        change = np.linalg.solve(curve, slope)
        size = np.abs(change).max()
        change *= min(1.0, 1.0 / max(size, 1e-9))
        a, b = a - change[0], b - change[1]
        if size < 1e-8:
            break
    return float(a), float(b)


def labelled_sample(labels: DataFrame, doc_id: str, label: str, train: Column, sample: int) -> DataFrame:
    """At most ``sample`` ids (``doc_id``, ``label``) of those that ``train`` holds for, by a hash."""
    return (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        .where(train & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def train_field(documents: DataFrame, sampled: DataFrame) -> Field:
    """``documents``: ``doc_id``, ``text``; ``sampled``: ``doc_id``, ``label``, few rows."""

    def run(batches):
        for batch in steps(batches):
            lines = line_features(batch.column("text"))
            rows = range(len(lines.first) - 1)
            spans = [slice(lines.first[i], lines.first[i + 1]) for i in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([lines.features[s].astype("<f8").tobytes() for s in spans]),
                    pa.array([lines.bytes[s].astype("<i8").tobytes() for s in spans]),
                ],
                names=["doc_id", "label", "features", "bytes"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.join(F.broadcast(sampled), "doc_id").select("doc_id", "label", "text")
    found = rows.mapInArrow(run, f"doc_id {kind}, label int, features binary, bytes binary").toArrow()
    if found.num_rows == 0:
        return Field(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, 0.0)
    found = found.sort_by([("doc_id", "ascending"), ("bytes", "ascending"), ("features", "ascending")])
    features = [np.frombuffer(v, "<f8").reshape(-1, FEATURES) for v in found["features"].to_pylist()]
    first = np.cumsum([0, *(len(f) for f in features)])
    sizes = np.concatenate([np.frombuffer(v, "<i8") for v in found["bytes"].to_pylist()])
    return fit(Lines(np.vstack(features), sizes, first), found["label"].to_numpy().astype(np.int64))


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    train: Column,
    label: str = "quality",
    threshold: float = 0.3,
    sample: int = SAMPLE_DOCUMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``score`` (0 to 1, higher if label 1 is likelier)
    and ``predicted``. ``train`` says by column ``doc_id`` which labels may be learned from."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    field = train_field(rows, labelled_sample(labels, label_id, label, train, sample))
    scored = score_column(rows, field).select("doc_id", "score")
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))


def keep_good(
    documents: DataFrame,
    labels: DataFrame,
    train: Column,
    label: str = "quality",
    threshold: float = 0.3,
    sample: int = SAMPLE_DOCUMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
) -> DataFrame:
    """The rows of ``documents`` with a score of at least ``threshold``, with their columns."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    field = train_field(rows, labelled_sample(labels, label_id, label, train, sample))
    name = "score"
    while name in documents.columns:
        name += "_"
    scored = score_column(documents, field, name, text).where(F.col(name) >= threshold)
    return scored.select(*[F.col(f"`{name}`") for name in documents.columns])


def score_column(documents: DataFrame, field: Field, name: str = "score", text: str = "text") -> DataFrame:
    """``documents`` with a column of scores by a fitted field."""

    def make(column: pa.Array) -> pa.Array:
        lines = line_features(column)
        raw = raw_quality(lines, field.weights, field.follow)
        return pa.array(_sigmoid(field.slope * _log_odds(raw) + field.shift))

    return with_text_column(documents, text, make, name, "double")
