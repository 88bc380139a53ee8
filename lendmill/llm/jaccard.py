"""N-gram Jaccard join of documents on their distinct word shingles.

Documents of one shingle set form a class first, so exact copies cost one row each. A
first pass over the classes takes a prefix of every set in hash order and drops the
classes that share too few of its shingles with any other class to reach the threshold.
The sets left are ordered rare-first by the exact number of classes that hold a shingle.
Two sets can only link if their prefixes in this order share a shingle; pairs that share
one must pass the length and the positional filter and a parity bitmap, which bounds the
shingles in just one of the two, and then, once per pair, the suffix filter and the exact
count.

Shingles travel as packed arrays, one row per task and bucket of the hash range.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.links import connected
from lendmill.llm.tables import documents, partitions, stored
from lendmill.llm.words import chunks, mix, shingles, sums, words

SIZE = 5
#: Two sets link when the intersection holds this many percent of the union.
PERCENT = 80
BUCKET_ENTRIES = 1 << 20
LEAST_BUCKETS = 64
BITMAP_WORDS = 4

_PACKED = "bucket int, nodes binary, counts binary, hashes binary"


def jaccard_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row of ``doc_id``, ``text``.

    ``component_id`` is the smallest ``doc_id`` reachable by links. A text without words
    and a null text have no shingle and link with nothing. A row without ``doc_id`` is
    counted but links with nothing; its ``component_id`` is null. Rows of one ``doc_id``
    are one document if their texts are equal. Other columns are ignored. Words and
    shingles are compared by 64-bit hashes.
    """
    docs = documents(docs, "doc_id", "text")
    sets = stored(docs.mapInArrow(_signatures(size), "doc_id long, n long, node long"), "sets")
    linkable = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("node").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id"))
    candidates = stored(_with_partners(docs, linkable, classes, size, percent), "candidates")
    ordered = stored(_rare_first(docs, candidates, size, percent), "ordered")
    members = ordered.select(
        "node",
        "n",
        F.posexplode("prefix").alias("i", "bucket"),
        "shared",
        "bits",
    ).withColumn("pos", F.col("n") - F.col("shared") + F.col("i")).drop("i")

    def possible(a, b):
        rest = F.least(a("n") - a("pos"), b("n") - b("pos"))
        both = a("n") + b("n")
        apart = reduce(
            Column.__add__,
            (F.bit_count(a("bits")[i].bitwiseXOR(b("bits")[i])) for i in range(BITMAP_WORDS)),
        )
        return (
            (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n")))
            & ((100 + percent) * rest >= percent * both)
            & ((100 + percent) * (a("shared") + b("shared") - apart) >= 2 * percent * both)
        )

    groups = connected(members, possible, lambda pairs: _verified(pairs, ordered, percent))
    classes = classes.join(groups, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("class")
    )
    least = classes.groupBy("class").agg(F.min("doc_id").alias("least"))
    named = stored(classes.join(least, "class").select("node", "least"), "least")
    return sets.join(named, (F.col("n") > 0) & (sets["node"] == named["node"]), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` but for those whose component has a smaller ``doc_id``."""
    found = jaccard_components(docs, size, percent)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(docs[f"`{c}`"] for c in docs.columns))


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, set sizes and hashes (ascending within a set) for each run of rows."""
    for chunk in chunks(batch.column("text")):
        text, hashes = shingles(words(chunk), size)
        yield chunk.first, np.bincount(text, minlength=chunk.rows), hashes


def _nodes(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A hash of each set, whatever the order."""
    return mix(sums(mix(hashes, 11), counts) + counts.astype(np.uint64), 12).view(np.int64)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts, hashes in _sets(batch, size):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(counts)),
                        pa.array(counts.astype(np.int64)),
                        pa.array(_nodes(counts, hashes)),
                    ],
                    names=["doc_id", "n", "node"],
                )

    return run


def _bucket_count(entries: int | None, spark) -> int:
    return max(LEAST_BUCKETS, partitions(spark), -(-(entries or 0) // BUCKET_ENTRIES))


def _packing(size: int, buckets: int, percent: int | None):
    """Send each set, or with ``percent`` only its prefix in hash order, to the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, counts, hashes, held = [], [], [], 0
        for batch in batches:
            for _, n, found in _sets(batch, size):
                own = _nodes(n, found)
                if percent is not None:
                    rank = np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)
                    length = np.minimum(n, _spare(n, percent) + _needed(n))
                    found = found[rank < np.repeat(length, n)]
                    n = length
                nodes.append(own)
                counts.append(n)
                hashes.append(found)
                held += len(found)
                if held >= BUCKET_ENTRIES:
                    yield _pack(nodes, counts, hashes, buckets)
                    nodes, counts, hashes, held = [], [], [], 0
        if held:
            yield _pack(nodes, counts, hashes, buckets)

    return run


def _spare(n, percent: int):
    """How many shingles of a set may be missing from a set it links with."""
    return n - -(-n * percent // 100)


def _needed(n):
    """A prefix longer by this many less one shares this many shingles with any partner."""
    return np.maximum(1, n // 10)


def _pack(nodes: list, counts: list, hashes: list, buckets: int) -> pa.RecordBatch:
    nodes, counts, hashes = map(np.concatenate, (nodes, counts, hashes))
    row = np.repeat(np.arange(len(nodes)), counts)
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    row, hashes, bucket = row[order], hashes[order], bucket[order]
    opens = np.ones(len(row), bool)
    opens[1:] = (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])
    at = np.flatnonzero(opens)
    lengths = np.diff(np.append(at, len(row))).astype(np.int32)
    owners, of = nodes[row[at]], bucket[at]
    used, first = np.unique(of, return_index=True)
    ends = np.append(first[1:], len(of))
    from_entry = at[first]
    to_entry = np.append(from_entry[1:], len(row))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used.astype(np.int32)),
            pa.array([owners[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            pa.array([lengths[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            pa.array([hashes[a:b].tobytes() for a, b in zip(from_entry, to_entry)], pa.binary()),
        ],
        names=["bucket", "nodes", "counts", "hashes"],
    )


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, node and number of nodes with that hash, by hash and node, each pair once."""
    counts = _joined(table.column("counts"), np.int32)
    nodes = np.repeat(_joined(table.column("nodes"), np.int64), counts)
    hashes = _joined(table.column("hashes"), np.uint64)
    order = np.lexsort((nodes, hashes))
    hashes, nodes = hashes[order], nodes[order]
    once = np.ones(len(hashes), bool)
    once[1:] = (hashes[1:] != hashes[:-1]) | (nodes[1:] != nodes[:-1])
    hashes, nodes = hashes[once], nodes[once]
    opens = np.ones(len(hashes), bool)
    opens[1:] = hashes[1:] != hashes[:-1]
    df = np.diff(np.append(np.flatnonzero(opens), len(hashes)))
    return hashes, nodes, np.repeat(df, df)


def _count_shared(table: pa.Table) -> pa.Table:
    _, nodes, df = _entries(table)
    node, shared = np.unique(nodes[df > 1], return_counts=True)
    return pa.table({"node": pa.array(node), "shared": pa.array(shared.astype(np.int64))})


def _with_partners(
    docs: DataFrame, linkable: DataFrame, classes: DataFrame, size: int, percent: int
) -> DataFrame:
    """``doc_id``, ``n``, ``node`` of one document of each class that may have a partner.

    A partner has at least ``percent`` of the shingles, so its prefix shares at least as
    many as :func:`_needed` gives for that size.
    """
    spark = docs.sparkSession
    length = f"least(n, n - ceil(n * {percent} / 100) + greatest(1, floor(n / 10)))"
    entries = linkable.selectExpr(f"CAST(sum({length}) AS LONG)").first()[0]
    buckets = _bucket_count(entries, spark)
    shared = (
        docs.where("doc_id IS NOT NULL")
        .mapInArrow(_packing(size, buckets, percent), _PACKED)
        .groupBy("bucket")
        .applyInArrow(_count_shared, "node long, shared long")
        .groupBy("node")
        .agg(F.sum("shared").alias("shared"))
    )
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 10))
    return classes.join(shared, "node").where(F.col("shared") >= least).select("doc_id", "n", "node")


def _shares(table: pa.Table) -> pa.Table:
    """For each node: its number of shingles here, and those that other nodes have too."""
    hashes, nodes, df = _entries(table)
    order = np.argsort(nodes, kind="stable")
    hashes, nodes, df = hashes[order], nodes[order], df[order].astype(np.uint32)
    node, first, n = np.unique(nodes, return_index=True, return_counts=True)
    kept = np.concatenate([[0], np.cumsum(df > 1)])
    low, high = kept[first], kept[first + n]
    hashes, df = hashes[df > 1], df[df > 1]
    return pa.table(
        {
            "node": pa.array(node),
            "held": pa.array(n.astype(np.int64)),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(low, high)], pa.binary()),
            "df": pa.array([df[a:b].tobytes() for a, b in zip(low, high)], pa.binary()),
        }
    )


def _rare_first(docs: DataFrame, candidates: DataFrame, size: int, percent: int) -> DataFrame:
    """For each candidate its size ``n``, its ``shared`` shingles with their numbers of
    holders, rare ones first, and those among them that lie in the ``prefix``."""
    spark = docs.sparkSession
    entries = candidates.agg(F.sum("n")).first()[0]
    buckets = _bucket_count(entries, spark)
    return (
        docs.join(candidates.select("doc_id").hint("merge"), "doc_id", "left_semi")
        .mapInArrow(_packing(size, buckets, None), _PACKED)
        .groupBy("bucket")
        .applyInArrow(_shares, "node long, held long, hashes binary, df binary")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(
            _ordered(percent),
            "node long, n long, shared long, hashes binary, df binary, prefix array<long>, bits array<long>",
        )
    )


def _ordered(percent: int):
    def one(rows: list[tuple]) -> dict | None:
        n = sum(r[1] for r in rows)
        hashes = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
        df = np.frombuffer(b"".join(r[3] for r in rows), np.uint32)
        spare = int(_spare(n, percent))
        if len(hashes) < n - spare:
            return None
        order = np.lexsort((hashes, df))
        hashes, df = hashes[order], df[order]
        prefix = hashes[: spare + 1 - (n - len(hashes))].view(np.int64)
        return {
            "node": rows[0][0], "n": n, "shared": len(hashes), "hashes": hashes.tobytes(),
            "df": df.tobytes(), "prefix": prefix.tolist(), "bits": _parity(hashes).tolist(),
        }

    schema = pa.schema(
        [
            ("node", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()),
            ("hashes", pa.binary()), ("df", pa.binary()), ("prefix", pa.list_(pa.int64())),
            ("bits", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and rows[0][0] != row[0]:
                    done.append(one(rows))
                    rows = []
                rows.append(row)
            yield pa.RecordBatch.from_pylist([d for d in done if d], schema)
        if rows and (last := one(rows)):
            yield pa.RecordBatch.from_pylist([last], schema)

    return run


def _parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each class of hashes: whether their number is odd. Two sets differ in at
    least as many shingles as their bitmaps in bits."""
    odd = np.bincount((hashes % np.uint64(64 * BITMAP_WORDS)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _verified(pairs: DataFrame, ordered: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold, each checked once."""
    side = lambda p: ordered.select(
        F.col("node").alias(p), *(F.col(c).alias(f"{c}_{p}") for c in ("n", "hashes", "df"))
    )
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        _checked(percent), "a long, b long"
    )


def _checked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("n_a", "hashes_a", "df_a", "n_b", "hashes_b", "df_b")
            links = [
                _links(percent, *row)
                for row in zip(*(batch.column(name).to_pylist() for name in names))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return run


def _links(percent: int, n_a: int, hashes_a: bytes, df_a: bytes, n_b: int, hashes_b: bytes, df_b: bytes) -> bool:
    a, b = np.frombuffer(hashes_a, np.uint64), np.frombuffer(hashes_b, np.uint64)
    least = -(-percent * (n_a + n_b) // (100 + percent))
    most_apart = len(a) + len(b) - 2 * least
    if most_apart < 0:
        return False
    fa, fb = np.frombuffer(df_a, np.uint32), np.frombuffer(df_b, np.uint32)
    if _apart_at_least(a, fa, b, fb, most_apart, 2) > most_apart:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= least


def _apart_at_least(a, fa, b, fb, most: int, depth: int) -> int:
    """The suffix filter: a lower bound of the elements in just one of two ordered sets.

    Both are cut at the middle element of ``b``; what is missing on one side of the cut
    cannot be made up for on the other.
    """
    bound = abs(len(a) - len(b))
    if depth == 0 or bound > most or not len(a) or not len(b):
        return bound
    middle = len(b) // 2
    low, high = np.searchsorted(fa, fb[middle]), np.searchsorted(fa, fb[middle], side="right")
    cut = low + int(np.searchsorted(a[low:high], b[middle]))
    left = abs(cut - middle)
    right = abs((len(a) - cut) - (len(b) - middle))
    if left + right > most:
        return left + right
    left = _apart_at_least(a[:cut], fa[:cut], b[:middle], fb[:middle], most - right, depth - 1)
    if left + right > most:
        return left + right
    return left + _apart_at_least(a[cut:], fa[cut:], b[middle:], fb[middle:], most - left, depth - 1)
