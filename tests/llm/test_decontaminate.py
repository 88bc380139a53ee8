"""Decontamination: recall against brute force, exact distances, edges."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendmill.llm import decontaminate
from lendmill.llm.decontaminate import clean, leaks, least_edits, piece_index, repetitions, sampled_index, window_size
from lendmill.llm.words import PUNCTUATION, SPACES, chunks, words

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[" + re.escape((SPACES + PUNCTUATION).decode()) + "]+", text) if w]


def brute_edits(item, region):
    """The last row of the full table, the item against any part of the region."""
    row = [0] * (len(region) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(region, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    best = min(row)
    return best, row.index(best)


def brute(docs, items):
    """Pairs by a seed that any place with at most 20 % edits of the longer items must
    have: a run of three of the item's words."""
    found = {}
    held = {i: tokens(t) for i, t in items}
    for d, text in docs:
        own = tokens(text)
        runs = {tuple(own[k : k + 3]) for k in range(len(own) - 2)}
        for i, item in held.items():
            if item and (len(item) < 15 or any(tuple(item[k : k + 3]) in runs for k in range(len(item) - 2))):
                edits, _ = brute_edits(item, own)
                if edits <= len(item) * 20 // 100:
                    found[d, i] = edits
    return found


def test_edit_distance():
    rng = np.random.default_rng(3)
    for _ in range(300):
        item = rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64)
        region = rng.integers(0, 4, rng.integers(0, 50)).astype(np.uint64)
        assert least_edits(item, region) == brute_edits(item.tolist(), region.tolist())
    long = rng.integers(0, 9, 200).astype(np.uint64)
    assert least_edits(long, long) == (0, 200)


def test_whole_table(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    items = [tuple(r) for r in benchmark.collect()]
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in leaks(documents, benchmark).collect()}
    assert found == brute(docs, items) and found


def planted(rate, seed, count=150):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(15, 60)))) for i in range(count)]
    docs = []
    for i, text in items:
        own = []
        for w in text.split(" "):
            x = rng.random()
            if x < rate / 3:
                own += [word(), w]
            elif x < 2 * rate / 3:
                own.append(word())
            elif x >= rate:
                own.append(w)
        around = [" ".join(word() for _ in range(rng.randint(0, 300))) for _ in range(2)]
        docs.append((i, f"{around[0]}. {' '.join(own).upper()}! {around[1]}"))
    docs += [(1000 + i, " ".join(word() for _ in range(400))) for i in range(100)]
    return docs, items


@pytest.mark.parametrize("rate, recall", [(0.0, 1.0), (0.05, 0.97), (0.1, 0.9)])
def test_recall_against_brute_force(spark, rate, recall):
    docs, items = planted(rate, 7)
    wanted = brute(docs, items)
    found = {
        (r["doc_id"], r["item_id"]): r["edits"]
        for r in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    }
    assert found.items() <= wanted.items()
    assert len(found) >= recall * len(wanted) > 100


def test_blocks_give_the_same(spark, monkeypatch):
    docs, items = planted(0.0, 9, 40)
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, leaks(*frames).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 10)
    assert sorted(map(tuple, leaks(*frames).collect())) == whole


def test_short_items_and_edges(spark):
    items = [(1, "Alpha, beta gamma!"), (2, None), (3, "... "), (4, "one two three four five six seven"), (1, "Alpha, beta gamma!"), (None, "solo")]
    docs = [
        (1, "alpha BETA gamma"), (2, "x y alpha beta gamma z"), (3, None), (4, ""), (5, "alpha beta"),
        (6, "pad " * 60_000 + "one two 3 four five six seven"), (None, "alpha beta gamma"), (7, "alpha beta gamma"), (7, "nothing here"),
    ]
    df = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit("clash")).withColumn("edits", F.lit(1))
    benchmark = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(0))
    found = {(r["doc_id"], r["item_id"], r["edits"], r["end_word"]) for r in leaks(df, benchmark).collect()}
    assert found == {(1, 1, 0, 3), (2, 1, 0, 5), (6, 4, 1, 60_007), (None, 1, 0, 3), (7, 1, 0, 3)}
    kept = clean(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted([(3,), (4,), (5,)], key=str)
    assert leaks(df.limit(0), benchmark).collect() == [] and leaks(df, benchmark.limit(0)).collect() == []


def test_windows_follow_the_edits():
    """One more window than half the edits: one of them has at most one edit."""
    for n in range(5, 300):
        assert n // window_size(n) >= n * 20 // 100 // 2 + 1
    chunk = next(chunks(pa.array(["a b c d e f g h i j k l m n o p"])))
    found = words(chunk, SPACES)
    assert [(c.size, len(c.windows)) for c in sampled_index([(0, found.hashes)])] == [(8, 2)]
    assert [(c.size, len(c.windows)) for c in piece_index([(0, found.hashes)])] == [(4, 4)]


@pytest.mark.parametrize("size", [4, 8])
def test_repetitions_reach_the_recall_of_one_edit(size):
    rng = np.random.default_rng(99)
    before = rng.integers(1, 1 << 62, (2000, size)).astype(np.uint64)
    after = before.copy()
    after[np.arange(2000), rng.integers(0, size, 2000)] = rng.integers(1, 1 << 62, 2000)
    met = np.zeros(2000, bool)
    for r in range(repetitions(size)):
        met |= decontaminate._row_keys(before, r) == decontaminate._row_keys(after, r)
    assert met.mean() >= 0.95


@pytest.mark.parametrize("size", [1, 2, 5, 8])
def test_walk_keys_stand_for_the_words_read(monkeypatch, size):
    """Keys are equal just where a plain walk reads the same; the words are scattered in one pass."""
    rng = np.random.default_rng(size)
    counts = rng.integers(0, 3 * size + 2, 60)
    ends = np.repeat(np.cumsum(counts), counts)
    own = np.append(rng.integers(1, 4, len(ends)).astype(np.uint64), np.uint64(0))
    begin, passes = np.arange(len(ends)), []
    last = np.minimum(begin + size, ends)
    mix = decontaminate.mix
    monkeypatch.setattr(decontaminate, "mix", lambda *a: passes.append(1) or mix(*a))
    for repetition in range(4):
        places = decontaminate.sampled_places(size, repetition)
        passes.clear()
        keys = decontaminate.embedded_keys(own, begin, last, places, repetition)
        assert len(passes) == 1
        scattered, read = mix(own, 2 * repetition + 1).tolist(), []
        for at, end in zip(begin.tolist(), last.tolist()):
            steps = []
            for step in range(int(places.max()) + 1):
                word = scattered[at] if at < end else 0
                if step in places:
                    steps.append(word)
                at += word >> step % 64 & 1
            read.append(tuple(steps))
        assert len(set(zip(keys.tolist(), read))) == len(set(read)) == len(set(keys.tolist()))
