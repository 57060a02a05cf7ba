"""Document quality from a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad from its own character statistics and those of the lines before and after it.  The
field is trained on a bounded sample of labelled documents, whose lines all carry the document's label; whole texts are
then scored inside the tasks that read them.  A document's quality is the mean marginal of "good" from the
forward-backward pass, weighted by line length, and calibrated by logistic regression on the same sample.

Null and empty texts are one empty line.  Without labels of both kinds there is nothing to learn: every score is then
the share of good labels, or 0.5 without any.  Rows that contradict each other about a document's label are not used.
Repeated rows get equal scores; a row without an id is scored and counts as not held out.  Texts of any length are
scored whole.  Of several texts of one labelled id the one with the least hash is learned from.  An empty table gives no
rows.  Columns other than ``doc_id`` and ``text`` are not read; ``keep_good`` returns them all, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import groups, mix, slices, words

#: Most labelled documents in the training sample, and most lines of them all together: documents go in by the hash of
#: their id until the lines are spent, whatever their own length.
SAMPLE_DOCUMENTS, SAMPLE_LINES = 3000, 120_000
STEPS, RATE, PENALTY = 200, 0.05, 1e-3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t",
    "stop": b".,",
    "exclaim": b"!?",
    "quote": b"'\"-:;()",
    "pipe": b"|",
    "other": b"#$%&*+/<=>@[\\]^_`{}~",
}
_CLASS = np.full(256, len(_CLASSES) + 1, np.uint8)
_CLASS[:128] = len(_CLASSES)
for _place, _members in enumerate(_CLASSES.values()):
    _CLASS[list(_members)] = _place
N_CLASSES = len(_CLASSES) + 2
N_OWN = 2 * N_CLASSES + 5
N_FEATURES = 3 * N_OWN + 3


@dataclass
class Lines:
    """Lines of a group of texts: text i has rows ``bounds[i]:bounds[i + 1]``."""

    features: np.ndarray
    length: np.ndarray
    bounds: np.ndarray


def lines(texts: list[bytes]) -> Lines:
    """Features of every line: shares of character classes and their roots, length, word length, repetition of words
    and of the line, and the same of the lines before and after."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(ends, text_ends)])
    kind = _CLASS[data]
    sums = np.empty((len(starts), N_CLASSES))
    for c in range(N_CLASSES):
        counted = np.concatenate([[0], np.cumsum(kind == c)])
        sums[:, c] = counted[ends] - counted[starts]
    own = np.empty((len(starts), N_OWN), np.float32)
    own[:, :N_CLASSES] = sums / np.maximum(length, 1)[:, None]
    own[:, N_CLASSES : 2 * N_CLASSES] = np.sqrt(own[:, :N_CLASSES])
    own[:, -5] = np.log1p(length) / 8
    own[:, -4] = np.minimum(length / (1 + sums[:, 3]), 40) / 10
    found = words(texts)
    of_line = np.searchsorted(ends, found.starts)
    count = np.maximum(np.bincount(of_line, minlength=len(starts)), 1)
    doubled = (found.hashes[1:] == found.hashes[:-1]) & (of_line[1:] == of_line[:-1])
    own[:, -3] = np.bincount(of_line[1:][doubled], minlength=len(starts)) / count
    _, once = np.unique(found.hashes ^ mix(of_line.astype(np.uint64)), return_index=True)
    own[:, -2] = np.bincount(of_line[once], minlength=len(starts)) / count
    raw = data.tobytes()
    repeated = np.zeros(len(starts), bool)
    for i in range(len(texts)):
        seen = set()
        for j in range(bounds[i], bounds[i + 1]):
            line = raw[starts[j] : ends[j]]
            repeated[j] = line in seen
            seen.add(line)
    own[:, -1] = repeated
    features = np.zeros((len(starts), N_FEATURES), np.float32)
    features[:, :N_OWN] = own
    first, last = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    first[bounds[:-1]], last[bounds[1:] - 1] = True, True
    features[1:, N_OWN : 2 * N_OWN] = own[:-1]
    features[:-1, 2 * N_OWN : 3 * N_OWN] = own[1:]
    features[first, N_OWN : 2 * N_OWN] = 0
    features[last, 2 * N_OWN : 3 * N_OWN] = 0
    features[:, -3], features[:, -2], features[:, -1] = first, last, 1
    return Lines(features, length, bounds)


@dataclass
class Model:
    """Label weights (features x 2), transitions (2 x 2), and the calibration of a document's mean marginal."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None


def _by_place(bounds: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Texts from the longest to the shortest, and how many have a line at each place."""
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    ordered = counts[order]
    return order, [int(np.searchsorted(-ordered, -t, side="left")) for t in range(int(counts.max(initial=0)))]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def marginals(model: Model, found: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Per line the probabilities of bad and good, and the expected transitions summed over all lines."""
    scores = found.features @ model.weights
    order, alive = _by_place(found.bounds)
    begin = found.bounds[:-1][order]
    forward = np.empty_like(scores)
    backward = np.zeros_like(scores)
    for t, n in enumerate(alive):
        row = begin[:n] + t
        if t:
            forward[row] = scores[row] + _log_sum(forward[row - 1][:, :, None] + model.transitions, 1)
        else:
            forward[row] = scores[row]
    for t in range(len(alive) - 2, -1, -1):
        row = begin[: alive[t + 1]] + t
        onward = (scores[row + 1] + backward[row + 1])[:, None, :] + model.transitions
        backward[row] = _log_sum(onward, 2)
    total = forward + backward
    total -= _log_sum(total, 1)[:, None]
    moves = np.zeros((2, 2))
    inner = np.ones(len(scores), bool)
    inner[found.bounds[1:] - 1] = False
    here = np.flatnonzero(inner)
    if len(here):
        joint = forward[here][:, :, None] + model.transitions + (scores[here + 1] + backward[here + 1])[:, None, :]
        joint = np.exp(joint - _log_sum(joint.reshape(-1, 4), 1)[:, None, None])
        moves = joint.sum(0)
    return np.exp(total), moves


def document_means(probabilities: np.ndarray, found: Lines) -> np.ndarray:
    """Mean probability of good per text, weighted by line length; an empty line weighs as one character."""
    weight = np.maximum(found.length, 1).astype(float)
    total = np.add.reduceat(weight * probabilities[:, 1], found.bounds[:-1])
    return total / np.add.reduceat(weight, found.bounds[:-1])


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def train(texts: list[bytes], labels: list[int]) -> Model:
    """Maximum likelihood by Adam; every line carries its document's label."""
    good = np.array(labels, int)
    model = Model(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))
    if len(set(labels)) < 2:
        model.constant = float(good.mean()) if len(good) else 0.5
        return model
    parts = [lines(group) for _, group in groups(texts)]
    counts = np.concatenate([np.diff(p.bounds) for p in parts])
    found = Lines(
        np.concatenate([p.features for p in parts]),
        np.concatenate([p.length for p in parts]),
        np.concatenate([[0], np.cumsum(counts)]),
    )
    label = np.repeat(good, np.diff(found.bounds))
    observed = np.zeros((len(label), 2))
    observed[np.arange(len(label)), label] = 1
    stays = np.bincount(good, np.diff(found.bounds) - 1, 2)
    size = len(label)
    # Documents count alike, whatever their number of lines.
    each = np.repeat(1 / np.diff(found.bounds), np.diff(found.bounds))[:, None]
    moment, power = [0.0, 0.0], [0.0, 0.0]
    for step in range(1, STEPS + 1):
        expected, moves = marginals(model, found)
        slopes = [
            found.features.T @ ((observed - expected) * each) / len(good) - PENALTY * model.weights,
            (np.diag(stays) - moves) / size - PENALTY * model.transitions,
        ]
        for k, slope in enumerate(slopes):
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            power[k] = 0.999 * power[k] + 0.001 * slope**2
            move = RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(power[k] / (1 - 0.999**step)) + 1e-8)
            if k:
                model.transitions = model.transitions + move
            else:
                model.weights = model.weights + move
    odds = _log_odds(document_means(marginals(model, found)[0], found))
    for _ in range(50):  # Newton steps of a ridge logistic regression on the log odds
        p = 1 / (1 + np.exp(-(model.slope * odds + model.shift)))
        x = np.stack([odds, np.ones_like(odds)], 1)
        slope = x.T @ (good - p) - 1e-2 * np.array([model.slope, model.shift])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        change = np.linalg.solve(curve, slope)
        change *= min(1.0, 1.0 / max(1e-12, np.abs(change).max()))
        model.slope, model.shift = model.slope + change[0], model.shift + change[1]
    return model


def score(model: Model, texts: Iterable[bytes | None]) -> np.ndarray:
    """Scores between 0 and 1, higher for better texts."""
    if model.constant is not None:
        return np.array([model.constant for _ in texts])
    parts = [np.zeros(0)]
    for _, group in groups(texts):
        found = lines(group)
        odds = _log_odds(document_means(marginals(model, found)[0], found))
        parts.append(1 / (1 + np.exp(-(model.slope * odds + model.shift))))
    return np.concatenate(parts)


def training_sample(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``doc_id, text, label`` of at most ``limit`` labelled documents, chosen by a hash of the id."""
    agreed = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("high"))
        .filter("label = high")
    )
    chosen = agreed.orderBy(F.xxhash64("labelled"), "labelled").limit(limit).select("labelled", "label")
    texts = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # The limit bounds the chosen ids, so they go to every task.
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    # Of several texts of one id the one with the least hash stands.
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return one.select("doc_id", F.col("least.text").alias("text"), "label")


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, left = [], SAMPLE_LINES
    # The documents come in the order of their hash.
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for doc_id, label, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), texts, strict=True):
            if left > 0:
                rows.append((doc_id, label, text))
            left -= text.count(b"\n") + 1
    rows.sort()
    model = train([text for _, _, text in rows], [label for _, label, _ in rows])
    yield pa.RecordBatch.from_pydict(
        {
            "weights": [model.weights.ravel()],
            "transitions": [model.transitions.ravel()],
            "slope": [model.slope],
            "shift": [model.shift],
            "constant": pa.array([model.constant], pa.float64()),
        }
    )


def fitted(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCUMENTS) -> Model:
    """The model of a training sample; one task trains it, the driver gets its weights."""
    schema = "weights array<double>, transitions array<double>, slope double, shift double, constant double"
    sample = training_sample(documents, labels, limit)
    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    found = ordered.mapInArrow(_fit, schema).first()
    if found is None:
        return train([], [])
    weights, transitions = np.array(found.weights).reshape(-1, 2), np.array(found.transitions).reshape(2, 2)
    return Model(weights, transitions, found.slope, found.shift, found.constant)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = score(model, batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id, parts: int, part: int):
    """Whether crc32 of the id as text leaves this remainder; a row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; held-out documents are not learned from."""
    known = labels.filter(~held_out(F.col("doc_id"), 3, 1))
    model = fitted(documents, known)
    return scored(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` with a score of at least 0.5, all columns."""
    known = labels.filter(~held_out(F.col("doc_id"), 3, 1))
    model = fitted(documents, known)

    @F.pandas_udf("double")
    def predict(texts):
        import pandas as pd

        return pd.Series(score(model, (None if t is None else t.encode() for t in texts)))

    return documents.filter(predict(F.col("text")) >= 0.5)
