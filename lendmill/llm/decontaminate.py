"""Benchmark decontamination by CGK embedding, bit-sampling LSH and edit distance.

The CGK embedding reads words by a random walk: at step t it writes the word at its place
and moves on if a random bit of (t, word) says so. Two windows a small edit distance apart
become two strings that mostly agree place by place, so edit distance turns into Hamming
distance. The words at a few sampled steps make a key that such windows often share;
repetitions with other walks and samples raise the share of windows met to a target.

An item of n words of which k may be edited is cut into at least k // 2 + 1 windows, so
one of them has at most one edit. The repetitions are as many as bring windows of one
edit to the target, measured for each size of window. The windows of the documents begin
at every word. Beside them, and named as such, the k + 1 exact pieces of an item are looked
up, one of which no edit touches: what the samples miss is found by these. Every
hit of either kind is verified by the exact edit distance, in words, of the whole item to
the best place around it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.tables import documents, fresh
from lendmill.llm.words import PUNCTUATION, SPACES, chunks, mix, words

#: Items of a block and bytes of their texts at most, a longer item is a block of its own.
#: Every task holds the index of a block; each block is one pass over the documents.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 8 << 20
#: An item is found where at most this many percent of its words are edited.
PERCENT_APART = 20
#: Sizes of windows, in words.
WINDOWS = (8, 6, 5, 4, 3, 2, 1)
#: Steps of a walk that make a key, one in each of as many equal parts of the walk.
SAMPLED = 3
#: The share of windows with one edited word that must be met in some repetition.
RECALL = 0.97
#: By how many words a window may be met beside its place.
SLACK = 4
CHUNK_BYTES = 256 << 10
_KEY_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Table:
    """Ascending ``keys``, the ``window`` of each, and ``seen``: which low bits occur at all."""

    keys: np.ndarray
    window: np.ndarray
    seen: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray) -> Table:
        order = np.argsort(keys, kind="stable")
        seen = np.zeros(1 << max(12, int(16 * len(keys)).bit_length()), bool)
        seen[keys & np.uint64(len(seen) - 1)] = True
        return cls(keys[order], order, seen)

    def met(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``keys`` and the windows that have the same key."""
        at = np.flatnonzero(self.seen[keys & np.uint64(len(self.seen) - 1)])
        a = np.searchsorted(self.keys, keys[at])
        times = np.searchsorted(self.keys, keys[at], side="right") - a
        places = np.repeat(at, times)
        k = np.repeat(a - np.cumsum(times) + times, times) + np.arange(len(places))
        return places, self.window[k]


@dataclass
class Class:
    """The windows of ``size`` words, the ``item`` of each and where in it it begins.

    Sampled windows have a table for each repetition and need ``least`` of their words in the
    document, at their places or beside them; exact pieces have one table and no ``least``.
    """

    size: int
    item: np.ndarray
    shift: np.ndarray
    windows: np.ndarray
    least: int
    tables: list[Table]


def embedded_keys(own: np.ndarray, begin: np.ndarray, last: np.ndarray, places: np.ndarray, repetition: int) -> np.ndarray:
    """The key of the walk of each window, which reads ``own`` from ``begin`` to before
    ``last`` and then stays. ``own`` has a word more than any window reads."""
    scattered = mix(own, 2 * repetition + 1)
    at, key = begin.astype(np.int64), np.zeros(len(begin), np.uint64)
    size = int((last - begin).max(initial=0))
    # before step ``size`` only windows of fewer words can have come to their end
    short = np.flatnonzero(last - begin < size)
    short_last = last[short]
    word, move, going = np.empty_like(key), np.empty_like(key), np.empty(len(begin), bool)
    sampled = set(places.tolist())
    for step in range(int(places.max()) + 1):
        np.take(scattered, at, out=word, mode="clip")
        if step < size:
            word[short[at[short] == short_last]] = 0
        else:
            np.multiply(word, np.not_equal(at, last, out=going), out=word)
        if step in sampled:
            key *= _KEY_STEP
            key += word
        np.right_shift(word, np.uint64(step % 64), out=move)
        move &= np.uint64(1)
        at += move.view(np.int64)
    return key


@cache
def sampled_places(size: int, repetition: int) -> np.ndarray:
    """A step in each part of a walk of twice as many steps as the window has words."""
    rng = np.random.default_rng([size, repetition])
    bounds = np.linspace(0, 2 * size, min(SAMPLED, 2 * size) + 1).astype(np.int64)
    return rng.integers(bounds[:-1], bounds[1:])


def _row_keys(windows: np.ndarray, repetition: int) -> np.ndarray:
    rows, size = windows.shape
    begin = np.arange(rows) * size
    return embedded_keys(
        np.append(windows.ravel(), np.uint64(0)), begin, begin + size, sampled_places(size, repetition), repetition
    )


@cache
def repetitions(size: int, recall: float = RECALL, trials: int = 3000) -> int:
    """How many repetitions meet the wanted share of windows with one word replaced, taken
    out or put in, measured on random words."""
    rng = np.random.default_rng(size)
    before = rng.integers(1, 1 << 62, (trials, size + 1)).astype(np.uint64)
    after = before[:, :size].copy()
    place, kind = rng.integers(0, size, trials), rng.integers(0, 3, trials)
    for row, (k, change) in enumerate(zip(place, kind)):
        if change == 1:
            after[row, k:] = before[row, k + 1 :]
        elif change == 2:
            after[row, k + 1 :] = before[row, k : size - 1]
        if change != 1:
            after[row, k] = rng.integers(1, 1 << 62)
    missed = np.ones(trials, bool)
    count = 0
    while missed.mean() > 1 - recall:
        missed &= _row_keys(before[:, :size], count) != _row_keys(after, count)
        count += 1
    return count


def window_size(n: int, percent: int = PERCENT_APART) -> int:
    """The largest size of which an item of ``n`` words has a window of at most one edit."""
    most = n // (n * percent // 100 // 2 + 1)
    return next(size for size in WINDOWS if size <= most)


def piece_size(n: int, percent: int = PERCENT_APART) -> tuple[int, int]:
    """The words of an exact piece and the number of pieces: one more than edits."""
    pieces = min(n, n * percent // 100 + 1)
    return n // pieces, pieces


def piece_keys(hashes: np.ndarray, piece: int) -> np.ndarray:
    """The hash of the ``piece`` words that begin at each word but the last ones."""
    count = max(0, len(hashes) - piece + 1)
    key = np.zeros(count, np.uint64)
    for k in range(piece):
        key = mix(key + hashes[k : k + count], 5)
    return key


def _cut(items: list[tuple[int, np.ndarray]], members: list[tuple[int, int]], size: int) -> tuple[np.ndarray, ...]:
    """The item, the first word and the words of all windows; a member is an item and the
    number of its windows."""
    item = np.concatenate([np.full(count, i) for i, count in members])
    shift = np.concatenate([np.arange(count) * size for _, count in members])
    held = [items[i][1][: count * size].reshape(count, size) for i, count in members]
    return item, shift, np.concatenate(held)


def sampled_index(items: list[tuple[int, np.ndarray]], percent: int = PERCENT_APART) -> list[Class]:
    """The classes of the items' sampled windows; an item is its place in ``items``."""
    by: dict[tuple[int, bool], list[tuple[int, int]]] = {}
    for i, (_, hashes) in enumerate(items):
        if n := len(hashes):
            exact = n * percent < 100
            size = n if exact else window_size(n, percent)
            by.setdefault((size, exact), []).append((i, n // size))
    classes = []
    for (size, exact), members in sorted(by.items()):
        item, shift, windows = _cut(items, members, size)
        tables = [Table.of(_row_keys(windows, r)) for r in range(1 if exact else repetitions(size))]
        classes.append(Class(size, item, shift, windows, size if exact else -(-size // 2), tables))
    return classes


def piece_index(items: list[tuple[int, np.ndarray]], percent: int = PERCENT_APART) -> list[Class]:
    """The classes of the items' exact pieces."""
    by: dict[int, list[tuple[int, int]]] = {}
    for i, (_, hashes) in enumerate(items):
        if len(hashes):
            size, pieces = piece_size(len(hashes), percent)
            by.setdefault(size, []).append((i, pieces))
    classes = []
    for size, members in sorted(by.items()):
        item, shift, windows = _cut(items, members, size)
        key = np.zeros(len(windows), np.uint64)
        for k in range(size):
            key = mix(key + windows[:, k], 5)
        classes.append(Class(size, item, shift, windows, 0, [Table.of(key)]))
    return classes


def _alike(hashes: np.ndarray, at: np.ndarray, windows: np.ndarray, least: int) -> np.ndarray:
    """Whether so many words of the window are in the document, at most one place beside."""
    count, top = np.zeros(len(at), np.int8), len(hashes) - 1
    for k in range(windows.shape[1]):
        same = np.zeros(len(at), bool)
        for beside in (-1, 0, 1):
            same |= hashes[np.clip(at + k + beside, 0, top)] == windows[:, k]
        count += same
    return count >= least


def candidates(hashes: np.ndarray, text: np.ndarray, firsts: np.ndarray, counts: np.ndarray, classes: list[Class]) -> np.ndarray:
    """Distinct rows of text, item and the word at which the item would begin, ascending."""
    hits = [np.empty((0, 3), np.int64)]
    begin, ends = np.arange(len(hashes)), (firsts + counts)[text]
    own = np.append(hashes, np.uint64(0))
    for c in classes:
        for r, table in enumerate(c.tables):
            if c.least:
                last = np.minimum(begin + c.size, ends)
                keys = embedded_keys(own, begin, last, sampled_places(c.size, r), r)
            else:
                keys = piece_keys(hashes, c.size)
            at, window = table.met(keys)
            for low in range(0, len(at), 1 << 18):
                a, w = at[low : low + (1 << 18)], window[low : low + (1 << 18)]
                if c.least:
                    good = _alike(hashes, a, c.windows[w], c.least)
                else:  # not those that run on into the next text
                    good = a + c.size <= ends[a]
                a, w = a[good], w[good]
                hits.append(np.stack([text[a], c.item[w], a - c.shift[w]], axis=1).astype(np.int64))
    return np.unique(np.concatenate(hits), axis=0)


def regions(found: np.ndarray, lengths: np.ndarray, percent: int) -> np.ndarray:
    """Rows of text, item and the words from and to which a place of the item may reach;
    those of one text and item that overlap are one, so that no word is read twice."""
    if not len(found):
        return np.empty((0, 4), np.int64)
    text, item, begin = found.T
    n = lengths[item]
    most = n * percent // 100 + SLACK
    new = np.ones(len(found), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(begin) > (n + 3 * most)[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(found)) - 1
    return np.stack([text[first], item[first], (begin - most)[first], (begin + n + 2 * most)[last]], axis=1)


def least_edits(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """The least edit distance of the item to a part of the region, and where it ends.

    Bit-parallel: a column of the table of distances is two numbers of as many bits as
    the item has words.
    """
    m = len(item)
    where: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best, end = m, 0
    for j, word in enumerate(region.tolist(), 1):
        same = where.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right, left = down | ~(diagonal | up) & full, up & diagonal
        distance += (right & top > 0) - (left & top > 0)
        right, left = right << 1 & full, left << 1 & full
        up, down = left | ~(diagonal | right) & full, right & diagonal
        if distance < best:
            best, end = distance, j
    return best, end


def _matching(items: list[tuple[int, np.ndarray]], classes: list[Class], percent: int):
    lengths = np.array([len(hashes) for _, hashes in items], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids = batch.column("doc_id")
            for chunk in chunks(batch.column("text"), CHUNK_BYTES):
                found = words(chunk, SPACES + PUNCTUATION)
                best: dict[tuple[int, int], tuple[int, int]] = {}
                met = candidates(found.hashes, found.text, found.firsts, found.counts, classes)
                for text, i, low, high in regions(met, lengths, percent).tolist():
                    item = items[i][1]
                    most = len(item) * percent // 100
                    first = int(found.firsts[text])
                    low, high = max(first, low), min(first + int(found.counts[text]), high)
                    edits, end = least_edits(item, found.hashes[low:high])
                    if edits <= most:
                        at = (edits, low - first + end)
                        best[text, i] = min(best.get((text, i), at), at)
                rows += [
                    (ids[chunk.first + text].as_py(), items[i][0], edits, 1 - edits / len(items[i][1]), end)
                    for (text, i), (edits, end) in best.items()
                ]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.float64()),
                    pa.array(columns[4], pa.int64()),
                ],
                names=["doc_id", "item_id", "edits", "similarity", "end_word"],
            )

    return run


def blocks(items: DataFrame) -> list[tuple[int, int]]:
    """The least and the greatest hash of the items of each block."""
    sized = items.select(
        F.xxhash64("item_id", "text").alias("key"), F.octet_length("text").alias("bytes")
    ).toArrow().sort_by("key")
    found: list[tuple[int, int]] = []
    count = total = 0
    for key, size in zip(sized.column("key").to_pylist(), sized.column("bytes").to_pylist()):
        full = count == BLOCK_ITEMS or total + size > BLOCK_BYTES
        if not found or full and key != found[-1][1]:
            found.append((key, key))
            count = total = 0
        found[-1] = found[-1][0], key
        count, total = count + 1, total + size
    return found or [(0, 0)]


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT_APART, exact: bool = True) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``similarity``, ``end_word`` for each document row
    and benchmark item that it holds, with at most ``percent`` of the item's words edited.

    Words are lower-cased and end at white space and ASCII punctuation. ``end_word`` counts
    the document's words up to the end of the best place, the first of equal ones. Null and
    empty texts and items without words match nothing. The benchmark is taken in blocks of
    a bounded number of items and bytes; each block is one pass over the documents without a shuffle.
    Without ``exact`` only the sampled windows are looked up, to measure their recall.
    """
    items = documents(benchmark, "item_id", "text").where("text IS NOT NULL").distinct()
    found = None
    for least, greatest in blocks(items):
        rows = items.where(F.xxhash64("item_id", "text").between(least, greatest)).toArrow()
        rows = rows.sort_by([("item_id", "ascending"), ("text", "ascending")])
        held = []
        for chunk in chunks(pc.cast(rows.column("text"), pa.large_string())):
            parts = words(chunk, SPACES + PUNCTUATION)
            held += [
                (rows.column("item_id")[chunk.first + k].as_py(), parts.hashes[a : a + n].copy())
                for k, (a, n) in enumerate(zip(parts.firsts, parts.counts))
            ]
        own = documents(docs, "doc_id", "text").mapInArrow(
            _matching(held, sampled_index(held, percent) + (piece_index(held, percent) if exact else []), percent),
            "doc_id long, item_id long, edits int, similarity double, end_word long",
        )
        found = own if found is None else found.unionByName(own)
    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found; rows of one ``doc_id`` go
    together, those without ``doc_id`` are judged by their own text."""
    names = docs.columns
    # a hash may equal some doc_id, so rows with and without one are told apart
    own, key = fresh(names, "named"), fresh(names, "key")
    marked = docs.withColumn(own, F.col("doc_id").isNotNull()).withColumn(
        key, F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    )
    gone = reduce(
        DataFrame.unionByName,
        (
            leaks(marked.where(F.col(own) == named).select(F.col(key).alias("doc_id"), "text"), benchmark)
            .select(F.col("doc_id").alias(key))
            .distinct()
            .withColumn(own, F.lit(named))
            for named in (True, False)
        ),
    )
    return marked.join(gone, [own, key], "left_anti").select(*(F.col(f"`{n}`") for n in names))
