"""Hard negatives of embeddings by exact integer scores from a residue number system.

Components are whole numbers. Their inner products are computed modulo a few small primes,
each as a float32 matrix product that no sum can round, and put together again by Chinese
remaindering with signed digits: the largest score decides how many primes are needed. Of
the exact scores each block keeps what may be among the first; Spark's windows make the
final choice.

Anchors meet all rows in blocks. Rows are dealt to blocks by a hash of their id, which is
unique, so a block has a bounded size whatever the labels and vectors are.

Columns: ``vec_id``, ``embedding`` and ``label``; others are not looked at. A row without id,
label or vector, or with a null, NaN or infinite component, takes no part. Of rows with
the same id one takes part, the smallest by label and then by vector. A shorter
vector goes on with zeros. A table without rows that take part gives no rows. Scores beyond
62 bits raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm.tables import documents, stored

SCALE = 256
ANCHOR_EACH = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least this share of its positive's score, and not more than all of it.
PERCENT = 80

BLOCK_ROWS = 4_096
#: So many anchors are multiplied with a block at once.
SLICE = 256
#: Longer vectors are multiplied in panels, or no prime would be small enough.
PANEL = 1_024
EXACT_FLOAT32 = 1 << 24
MOST_BITS = 62

POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = POSITIVE + ", negative_id long, negative_score long"


def whole_rows(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (floors of the scaled components) of all rows that
    take part."""
    rows = documents(embeddings, "vec_id", "embedding", "label")
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    ).where(finite)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    wide = F.exists("embedding", lambda x: F.abs(x.cast("double")) * SCALE >= 2.0**31)
    refused = F.raise_error(F.lit("a component is too large for exact scores"))
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.when(wide, refused).otherwise(scaled).cast("array<int>").alias("vector"),
    )
    first = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return first.select("vec_id", "row.label", "row.vector")


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """The first negatives of each anchor and positive by score, ranked from 1.

    ``rows`` has a unique ``vec_id``, ``label`` and ``vector`` and is read more than once;
    ``is_anchor`` says which rows are queries.
    """
    squares = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    total, anchors, width, bound = rows.agg(
        F.count(F.lit(1)),
        F.count(F.when(is_anchor, 1)),
        F.max(F.size("vector")),
        F.max(squares),
    ).first()
    if not anchors:
        return rows.sparkSession.createDataFrame([], NEGATIVE + ", rank int").select(_RESULT)
    system = Residues(width, math.ceil(bound * (1 + 1e-9)))

    row_blocks, anchor_blocks = (max(1, math.ceil(n / BLOCK_ROWS)) for n in (total, anchors))
    number = F.xxhash64("vec_id")
    row_block = F.pmod(number, F.lit(row_blocks)).cast("int")
    anchor_block = F.pmod(F.xxhash64(number), F.lit(anchor_blocks)).cast("int")
    # Each block of rows meets each block of anchors, every pair of blocks in a task.
    candidates = rows.select(
        row_block.alias("row_block"),
        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("anchor_block"),
        "vec_id", "label", "vector",
    )
    cells = F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("row_block")
    queries = rows.where(is_anchor)

    def meet(queries: DataFrame, function, schema: str) -> DataFrame:
        spread = queries.select(cells, anchor_block.alias("anchor_block"), *queries.columns)
        keys = "row_block", "anchor_block"
        return spread.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(function, schema)

    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = meet(queries, lambda a, b: system.positives(a, b), POSITIVE)
    positives = positives.withColumn("place", F.row_number().over(ranked))
    positives = positives.where(F.col("place") <= POSITIVES).groupBy("anchor_id")
    positives = positives.agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    queries = queries.join(positives, queries["vec_id"] == positives["anchor_id"]).drop("anchor_id")
    queries = stored(queries, "negative-queries")

    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id"
    )
    negatives = meet(queries, lambda a, b: system.negatives(a, b), NEGATIVE)
    negatives = negatives.withColumn("rank", F.row_number().over(ranked))
    return negatives.where(F.col("rank") <= NEGATIVES).select(_RESULT)


_RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def is_prime(number: int) -> bool:
    return number > 1 and all(number % d for d in range(2, math.isqrt(number) + 1))


class Residues:
    """Exact inner products of vectors up to ``width`` long that are at most ``bound`` in size."""

    def __init__(self, width: int, bound: int) -> None:
        if bound.bit_length() > MOST_BITS:
            raise ValueError(f"scores up to {bound} have more than {MOST_BITS} bits")
        self.width = width
        self.panel = max(1, min(width, PANEL))
        half = math.isqrt(EXACT_FLOAT32 // self.panel)
        self.primes: list[int] = []
        largest = 2 * half + 1
        while math.prod(self.primes) <= 2 * bound + 1:
            while not is_prime(largest):
                largest -= 1
            self.primes.append(largest)
            largest -= 1

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The components modulo each prime, as float32 between plus and minus half of it."""
        return [_signed(vectors, p).astype(np.float32) for p in self.primes]

    def scores(self, some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
        """All inner products of two sets of split vectors."""
        total, modulus = None, 1
        for p, a, b in zip(self.primes, some, others):
            rest = np.zeros((len(a), len(b)), np.int64)
            for low in range(0, self.width, self.panel):
                panel = slice(low, low + self.panel)
                rest += (a[:, panel] @ b[:, panel].T).astype(np.int64)
            if total is None:
                total = _signed(rest, p)
            else:
                digit = _signed(_signed(rest - total, p) * pow(modulus, -1, p), p)
                total = total + digit * modulus
            modulus *= p
        return total

    def positives(self, queries: pa.Table, rows: pa.Table) -> pa.Table:
        """The first rows of the same label of each query, itself left out."""
        found = _Found(POSITIVE)
        ids, labels, vectors = self._columns(rows)
        for label in np.unique(queries["label"].to_numpy()):
            same = np.flatnonzero(labels == label)
            own = queries.filter(pa.array(queries["label"].to_numpy() == label))
            for query, scores in self._each(own, vectors[same]):
                others = np.flatnonzero(ids[same] != own["vec_id"][query].as_py())
                score, other = scores[others], ids[same[others]]
                first = np.lexsort((other, -score))[:POSITIVES]
                found.add(own["vec_id"][query].as_py(), other[first], score[first])
        return found.table()

    def negatives(self, queries: pa.Table, rows: pa.Table) -> pa.Table:
        """For each query and positive the first rows of other labels within the window."""
        found = _Found(NEGATIVE)
        ids, labels, vectors = self._columns(rows)
        own = queries["label"].to_numpy()
        for query, scores in self._each(queries, vectors):
            anchor = queries["vec_id"][query].as_py()
            wanted = [(w["positive_id"], w["positive_score"]) for w in queries["positives"][query].as_py()]
            most = max(score for _, score in wanted)
            least = min(_least(score) for _, score in wanted)
            others = np.flatnonzero((labels != own[query]) & (scores <= most) & (scores >= least))
            others = others[np.lexsort((ids[others], -scores[others]))]
            downwards = -scores[others]
            for positive, score in wanted:
                low = np.searchsorted(downwards, -score)
                high = np.searchsorted(downwards, -_least(score), side="right")
                first = others[low : max(low, min(high, low + NEGATIVES))]
                found.add(anchor, positive, score, ids[first], scores[first])
        return found.table()

    def _columns(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return rows["vec_id"].to_numpy(), rows["label"].to_numpy(), self._matrix(rows)

    def _matrix(self, rows: pa.Table) -> np.ndarray:
        vectors = rows["vector"].combine_chunks()
        lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        matrix = np.zeros((len(vectors), self.width), np.int64)
        matrix[np.arange(self.width) < lengths[:, None]] = pc.list_flatten(vectors).to_numpy(zero_copy_only=False)
        return matrix

    def _each(self, queries: pa.Table, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Number and scores of each query."""
        if not queries.num_rows or not len(vectors):
            return
        others = self.split(vectors)
        for low in range(0, queries.num_rows, SLICE):
            some = self.split(self._matrix(queries.slice(low, SLICE)))
            for i, scores in enumerate(self.scores(some, others)):
                yield low + i, scores


def _signed(values: np.ndarray, prime: int) -> np.ndarray:
    half = prime // 2
    return (values + half) % prime - half


def _least(score: int) -> int:
    """The smallest whole score that has its share of ``score``."""
    return -(-PERCENT * score // 100)


class _Found:
    """Rows of a result, gathered as arrays; single values stand for all rows of an entry."""

    def __init__(self, schema: str) -> None:
        self.names = [column.split(" ")[0] for column in schema.split(", ")]
        self.entries: list[list[np.ndarray]] = []

    def add(self, *values) -> None:
        if size := len(values[-1]):
            self.entries.append([np.broadcast_to(np.int64(v), size) for v in values])

    def table(self) -> pa.Table:
        empty = np.empty(0, np.int64)
        columns = [np.concatenate([empty, *parts]) for parts in zip(*self.entries)] or [
            empty for _ in self.names
        ]
        return pa.table(columns, names=self.names)
