"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of two, three and four bytes of the lower-cased text, in which each
run of white space is one blank. The embeddings of all subwords of a text are averaged
and go through a linear softmax. The model is trained by stochastic gradient descent in
numpy on a bounded sample of labelled rows, and calibrated by a temperature on a part of
the sample that was not trained on. As average and softmax input are linear, prediction
adds up one score vector per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.learn import fold, sample
from lendmill.llm.tables import documents
from lendmill.llm.words import Chunk, chunks, sums

UNDETERMINED = "und"
#: Labelled rows of each language that the model is fitted on, at most.
SAMPLE_EACH = 2000
#: A document is rejected below this score.
LEAST_SCORE = 0.5

#: Texts scored at once; the arrays on the way take some fifty times as much memory.
SCORED_BYTES = 1 << 18

BUCKETS = 1 << 13
DIMENSIONS = 16
LENGTHS = (2, 3, 4)
EPOCHS = 30
RATE = 0.5
BATCH = 32
SEED = 7
#: Shares travel to the driver in half precision, times this.
SHARE_SCALE = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Model:
    languages: list[str]
    #: Score of each language by bucket, and its constant part.
    scores: np.ndarray
    bias: np.ndarray
    temperature: float


def _squeezed(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with a blank before and after each text and single blanks within, and the
    number of bytes of each text."""
    data = _LOWER[chunk.data]
    blank = _SPACE[data]
    data[blank] = 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    first = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
    keep[first] = True
    kept = sums(keep.astype(np.int64), np.diff(chunk.offsets))
    starts = np.cumsum(kept) - kept
    at = np.stack([starts, starts + kept], 1).ravel()
    return np.insert(data[keep], at, 0x20), kept + 2


def _buckets(data: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subword of that length, and their number by text."""
    ends = np.cumsum(counts)
    inside = np.ones(len(data), bool)
    for k in range(1, length):
        inside[ends - k] = False
    code = np.zeros(len(data) - length + 1, np.uint32)
    for k in range(length):
        code = code * np.uint32(0x01000193) + data[k : len(data) - length + 1 + k]
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * length)
    code = (code >> np.uint32(32 - BUCKETS.bit_length() + 1))[inside[: len(code)]]
    return code, np.maximum(0, counts - length + 1)


def _logits(chunk: Chunk, scores: np.ndarray) -> np.ndarray:
    data, counts = _squeezed(chunk)
    total = np.zeros((chunk.rows, scores.shape[1]))
    number = np.zeros(chunk.rows)
    for length in LENGTHS:
        if len(data) < length:
            continue
        code, n = _buckets(data, counts, length)
        total += sums(scores[code].astype(np.float64), n)
        number += n
    return total / np.maximum(number, 1)[:, None]


def _features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The share of each bucket among the subwords of each text."""
    for chunk in chunks(texts):
        data, counts = _squeezed(chunk)
        row = np.zeros((chunk.rows, BUCKETS), np.float32)
        for length in LENGTHS:
            if len(data) >= length:
                code, n = _buckets(data, counts, length)
                np.add.at(row, (np.repeat(np.arange(chunk.rows), n), code), 1)
        yield row / np.maximum(row.sum(1, keepdims=True), 1)


def _packed_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's non-empty buckets and shares, whatever its length."""
    for batch in batches:
        for first in range(0, batch.num_rows, 64):
            part = batch.slice(first, 64)
            rows = np.concatenate(list(_features(part.column("text"))))
            used = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("lang"),
                    pa.array([u.astype(np.uint16).tobytes() for u in used], pa.binary()),
                    pa.array([(SHARE_SCALE * r[u]).astype(np.float16).tobytes() for r, u in zip(rows, used)], pa.binary()),
                ],
                names=["lang", "buckets", "shares"],
            )


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(rows: DataFrame, each: int = SAMPLE_EACH) -> Model | None:
    """Fit on ``text`` and ``lang`` of at most ``each`` rows of a language, chosen by the
    hash of ``doc_id``. ``None`` if no row has both."""
    named = documents(rows, "doc_id", "lang", "text").where("lang IS NOT NULL")
    chosen = sample(
        named.where("text RLIKE '[\\\\p{L}]'"), "lang", "doc_id", each, named.select("lang")
    )
    found = (
        chosen.select("doc_id", "lang", "text")
        .mapInArrow(_packed_features, "lang string, buckets binary, shares binary")
        .toArrow()
    )
    if not found.num_rows:
        return None
    names = found.column("lang").to_pylist()
    packed = list(zip(found.column("buckets").to_pylist(), found.column("shares").to_pylist()))
    del found
    pa.default_memory_pool().release_unused()
    order = sorted(range(len(names)), key=lambda i: (names[i], packed[i]))
    texts = [
        (np.frombuffer(packed[i][0], np.uint16), np.frombuffer(packed[i][1], np.float16)) for i in order
    ]

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for to, i in enumerate(rows):
            x[to, texts[i][0]] = texts[i][1]
        return x / SHARE_SCALE

    languages = sorted(set(names))
    y = np.array([languages.index(names[i]) for i in order])
    rng = np.random.default_rng(SEED)
    mixed = rng.permutation(len(y))
    apart = mixed[: len(y) // 5]
    learn = mixed[len(y) // 5 :]
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    linear = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    target = np.eye(len(languages), dtype=np.float32)[y]
    scale = 1 / float(np.mean([np.linalg.norm(shares.astype(np.float32) / SHARE_SCALE) for _, shares in texts]))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(learn)
        for low in range(0, len(learn), BATCH):
            batch = learn[low : low + BATCH]
            own = dense(batch) * scale
            hidden = own @ embed
            wrong = (_softmax(hidden @ linear + bias) - target[batch]) / len(batch)
            back = own.T @ (wrong @ linear.T)
            linear -= rate * (hidden.T @ wrong)
            bias -= rate * wrong.sum(0)
            embed -= rate * back
    scores = (embed @ linear) * scale
    z = np.array([shares.astype(np.float32) / SHARE_SCALE @ scores[buckets] + bias for buckets, shares in (texts[i] for i in apart)])
    return Model(languages, scores.astype(np.float32), bias.astype(np.float64), _temperature(z, y[apart]))


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature under which rows that were not trained on are likeliest."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.25, 20, 60)
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _answers(model: Model | None, texts: pa.Array, letters: pa.Array) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray]]:
    """Language and score of each text, by chunk."""
    lettered = letters.to_numpy(zero_copy_only=False).astype(bool)
    for chunk in chunks(texts, SCORED_BYTES):
        known = lettered[chunk.first : chunk.first + chunk.rows] & (model is not None)
        names = np.full(chunk.rows, UNDETERMINED, object)
        score = np.zeros(chunk.rows)
        if known.any():
            likely = _softmax((_logits(chunk, model.scores) + model.bias) / model.temperature)
            names[known] = np.array(model.languages, object)[likely.argmax(1)][known]
            score[known] = likely.max(1)[known]
        yield chunk, names, score


def _predicting(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, names, score in _answers(model, batch.column("text"), batch.column("letters")):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, chunk.rows),
                        pa.array(names, pa.string()),
                        pa.array(score),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def _accepting(model: Model | None):
    def run(texts: pa.Array, letters: pa.Array) -> pa.Array:
        found = [
            (names != UNDETERMINED) & (score >= LEAST_SCORE)
            for _, names, score in _answers(model, texts, letters)
        ]
        return pa.array(np.concatenate([np.empty(0, bool), *found]).astype(bool), pa.bool_())

    return run


def _has_letters() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for each row, from the whole text alone.

    A null text or one without any letter is ``und`` with score 0, and so is every text
    without a model. Repeated rows get equal results.
    """
    rows = documents(docs, "doc_id", "text").withColumn("letters", _has_letters())
    return rows.mapInArrow(_predicting(model), "doc_id long, lang_pred string, score double")


def _held_out() -> Column:
    return F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))


def _trained(docs: DataFrame) -> Model | None:
    """Fit on the rows outside the held-out fold."""
    return train(documents(docs, "doc_id", "text", "lang").where("doc_id IS NOT NULL").where(~_held_out()))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fold and predict all of them."""
    return predict(docs, _trained(docs)).withColumn("held_out", _held_out())


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is determined with a sufficient score, each
    judged by its own text, also rows without ``doc_id``. Nothing is shuffled."""
    accept = F.arrow_udf(_accepting(_trained(docs)), "boolean")
    return docs.where(accept(F.col("text"), _has_letters()))
