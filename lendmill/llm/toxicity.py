"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are the hashed words of a text and their beginnings of several lengths, each
present or not. One weight per feature is shared by all grades; ordered thresholds turn the weighted sum into the
probability of each grade or more, and their sum is the expected severity. The weights
are fitted by proximal gradient steps with an L1 penalty, so few of them are not zero,
on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.learn import sample
from lendmill.llm.tables import documents, stored
from lendmill.llm.words import PUNCTUATION, SPACES, Chunk, chunks, prefixes, words

#: Labelled rows of each grade that the model is fitted on, at most.
SAMPLE_EACH = 2000
FEATURES = 1 << 31
BEGINNINGS = (4, 5, 6, 7)
#: Features of fewer sample texts, or less linked to the grade than by chance at so many
#: standard deviations, have no weight.
LEAST_TEXTS = 4
LEAST_DEVIATIONS = 5
#: A text is toxic from this probability of grade 1 or more on.
LEAST_SCORE = 0.25
PENALTY = 0.002
STEPS = 300


@dataclass
class Model:
    #: Features that have a weight, ascending, and the weights.
    features: np.ndarray
    weights: np.ndarray
    #: Ascending: the weighted sum above which a grade or more is likelier than not.
    thresholds: np.ndarray


def _found(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each word of each text and of its beginnings, with repetitions."""
    found = words(chunk, SPACES + PUNCTUATION)
    parts = [(found.text, found.hashes), *(prefixes(chunk, found, k) for k in BEGINNINGS)]
    row = np.concatenate([text for text, _ in parts])
    hashes = np.concatenate([h for _, h in parts])
    return row, (hashes >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def _present(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature, each pair once, by row."""
    row, feature = _found(chunk)
    pairs = np.unique(row * FEATURES + feature)
    return pairs // FEATURES, pairs % FEATURES


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            row, feature = _present(chunk)
            ends = np.searchsorted(row, np.arange(chunk.rows + 1))
            packed = [feature[a:b].astype(np.uint32).tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade").slice(chunk.first, chunk.rows), pa.array(packed, pa.binary())],
                names=["grade", "features"],
            )


@dataclass
class Sample:
    """Distinct texts: ``row`` and ``feature`` of each of their words, and their grades."""

    row: np.ndarray
    feature: np.ndarray
    grade: np.ndarray


def gathered(rows: DataFrame) -> Sample:
    """The features of ``text`` and the ``grade`` (0 and up) of each of a bounded number of
    rows; of rows with equal features and grade one."""
    found = rows.select("text", F.col("grade").cast("int").alias("grade")).mapInArrow(
        _packed, "grade int, features binary"
    ).toArrow()
    texts = sorted(set(zip(found.column("grade").to_pylist(), found.column("features").to_pylist())))
    features = [np.frombuffer(f, np.uint32) for _, f in texts]
    row = np.repeat(np.arange(len(texts)), [len(f) for f in features])
    flat = np.concatenate([np.empty(0, np.uint32), *features]).astype(np.int64)
    return Sample(row.astype(np.int64), flat, np.array([g for g, _ in texts], int))


def train(sample: Sample) -> Model | None:
    """``None`` if there are not two grades. A grade that no row has keeps its threshold
    between its neighbours'."""
    if len(np.unique(sample.grade)) < 2:
        return None
    known, at = np.unique(sample.feature, return_inverse=True)
    common = _telling(sample, at, len(known))
    row, at = sample.row[common[at]], (np.cumsum(common) - 1)[at[common[at]]]
    known = known[common]
    weights, thresholds = _fit(row, at, len(known), sample.grade)
    used = weights != 0
    return Model(known[used], weights[used], thresholds)


def _telling(sample: Sample, at: np.ndarray, size: int) -> np.ndarray:
    """Whether a feature comes with the upper grades more often than by chance."""
    upper = sample.grade > 0
    share = upper.mean()
    n = np.bincount(at, minlength=size)
    seen = np.bincount(at, upper[sample.row], size)
    deviations = (seen - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return (n >= LEAST_TEXTS) & (deviations >= LEAST_DEVIATIONS * np.sqrt(1 - n / (len(upper) + 1)))


def split_top(sample: Sample) -> Sample:
    """Grade 1 cut in two, where only two grades are known: 2 for the rows above the median
    of the weighted sums that a first fit gives to grade 1."""
    first = train(sample)
    if first is None or not len(first.features):
        return sample
    place = np.searchsorted(first.features, sample.feature).clip(max=len(first.features) - 1)
    hit = first.features[place] == sample.feature
    total = np.bincount(sample.row[hit], first.weights[place[hit]], len(sample.grade))
    top = sample.grade == 1
    return Sample(sample.row, sample.feature, sample.grade + (top & (total > np.median(total[top]))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _fit(row: np.ndarray, at: np.ndarray, size: int, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each threshold is a yes-or-no question, "this grade or more", to the same weighted sum."""
    levels = np.arange(1, grade.max() + 1)
    above = grade[:, None] >= levels
    share = np.full(len(grade), 1 / len(grade))
    step = 1 / (0.25 * len(levels) * _largest(row, at, size, share) + 1e-12)
    weights, ahead, pace = np.zeros(size), np.zeros(size), 1.0
    thresholds = np.linspace(0, 1, len(levels))
    for _ in range(STEPS):
        total = np.bincount(row, ahead[at], len(grade))
        wrong = share[:, None] * (_sigmoid(total[:, None] - thresholds) - above)
        moved = ahead - step * np.bincount(at, wrong.sum(1)[row], size)
        moved = np.sign(moved) * np.maximum(0, np.abs(moved) - step * PENALTY)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / faster * (moved - weights)
        weights, pace = moved, faster
        thresholds = np.sort(thresholds + wrong.sum(0))
    return weights, thresholds


def _largest(row: np.ndarray, at: np.ndarray, size: int, share: np.ndarray) -> float:
    """The largest eigenvalue of the weighted feature products, which bounds the step."""
    vector = np.ones(size)
    for _ in range(20):
        norm = np.sqrt(vector @ vector)
        vector = np.bincount(at, (share * np.bincount(row, vector[at] / norm, len(share)))[row], size)
    return float(np.sqrt(vector @ vector))


def _predicting(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                grades = np.zeros((chunk.rows, 1 if model is None else len(model.thresholds)))
                if model is not None:
                    total = np.zeros(chunk.rows)
                    if len(model.features):
                        row, feature = _found(chunk)
                        place = np.minimum(np.searchsorted(model.features, feature), len(model.features) - 1)
                        hit = model.features[place] == feature
                        pairs = np.unique(row[hit] * len(model.features) + place[hit])
                        total = np.bincount(
                            pairs // len(model.features), model.weights[pairs % len(model.features)], chunk.rows
                        )
                    grades = _sigmoid(total[:, None] - model.thresholds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, chunk.rows),
                        pa.array(grades.sum(1)),
                        pa.array((grades >= 0.5).sum(1).astype(np.int32)),
                        pa.array(grades[:, 0]),
                    ],
                    names=["doc_id", "severity", "grade", "toxic_score"],
                )

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``severity`` (expected grade), ``grade`` (the highest that is likelier
    than not), ``toxic_score`` (probability of grade 1 or more), ``toxic`` for each row.

    A null or empty text has no feature. Without a model every severity is 0.
    """
    return (
        documents(docs, "doc_id", "text")
        .mapInArrow(_predicting(model), "doc_id long, severity double, grade int, toxic_score double")
        .withColumn("toxic", F.col("toxic_score") >= LEAST_SCORE)
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and score all. The labels only say whether a
    text is toxic; :func:`split_top` makes grades 1 and 2 of those that are. Of several
    labels of one document the highest counts."""
    graded = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", F.when(F.col("toxic") == 0, 0).otherwise(1).alias("grade")
    )
    graded = stored(graded.groupBy("doc_id").agg(F.max("grade").alias("grade")), "labelled")
    chosen = stored(sample(graded, "grade", "doc_id", SAMPLE_EACH), "graded")
    rows = documents(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return score(docs, train(split_top(gathered(rows))))
