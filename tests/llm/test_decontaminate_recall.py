"""Decontamination: every item within 20 % edited words is found."""

import random

import pytest

from lendmill.llm import decontaminate
from lendmill.llm.decontaminate import blocks, clean, leaks
from tests.llm.test_decontaminate import DOCS, ITEMS, brute_edits


def edited(words, edits, rng, word):
    """As many words of the item replaced, taken out or joined by one before them."""
    places, own = set(rng.sample(range(len(words)), edits)), []
    for k, w in enumerate(words):
        own += rng.choice(([word()], [], [word(), w])) if k in places else [w]
    return own


@pytest.mark.parametrize("percent", [15, 20])
def test_all_items_within_the_edits_are_found(spark, percent):
    rng = random.Random(percent)
    word = lambda: f"w{rng.randrange(3000)}"
    docs, items, wanted = [], [], {}
    for i, n in enumerate([5, 10, 39, 45, 71, 78] * 25):
        item = [word() for _ in range(n)]
        own = [word() for _ in range(rng.randrange(30))] + edited(item, n * percent // 100, rng, word)
        own += [word() for _ in range(rng.randrange(30))]
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(own)))
        edits, end = brute_edits(item, own)
        wanted[i] = (edits, end)
        assert edits <= n * 20 // 100
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {r["doc_id"]: (r["edits"], r["end_word"]) for r in found if r["doc_id"] == r["item_id"]} == wanted


@pytest.mark.parametrize("percent", [5, 10, 15, 20])
def test_recall_of_the_samples_alone(spark, percent):
    """Without the exact pieces, item sizes one by one."""
    rng = random.Random(1000 + percent)
    word = lambda: f"w{rng.randrange(3000)}"
    docs, items = [], []
    sizes = [5, 39, 45, 71, 78]
    for i, n in enumerate(sizes * 60):
        item = [word() for _ in range(n)]
        own = [word() for _ in range(rng.randrange(30))] + edited(item, n * percent // 100, rng, word)
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(own + [word() for _ in range(rng.randrange(30))])))
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), exact=False).collect()
    met = {r["doc_id"] for r in found if r["doc_id"] == r["item_id"]}
    shares = {n: sum(i in met for i in range(k, len(docs), 5)) / 60 for k, n in enumerate(sizes)}
    assert all(share >= 0.95 for share in shares.values()), shares


def test_repeated_words_are_read_once(spark):
    docs = [(1, "la " * 20_000 + "end"), (2, "end " + "la " * 3)]
    items = [(1, "la " * 30), (2, "la la la la la end")]
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"], r["end_word"]) for r in found} == {(1, 1, 0, 30), (1, 2, 0, 20_001)}


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(300 if i == 7 else 20))) for i in range(60)]
    frames = spark.createDataFrame(items, DOCS), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, leaks(*frames).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    ranges = blocks(frames[1])
    keyed = frames[1].selectExpr("item_id", "xxhash64(item_id, text) AS key", "octet_length(text) AS bytes").collect()
    held = [[r for r in keyed if low <= r["key"] <= high] for low, high in ranges]
    assert all(len(b) == 1 or sum(r["bytes"] for r in b) <= 1000 for b in held)
    assert sorted(r["item_id"] for b in held for r in b) == list(range(60))
    assert sorted(map(tuple, leaks(*frames).collect())) == whole and len(whole) >= 60


def test_rows_without_doc_id_are_judged_by_their_text(spark):
    docs = [(None, "x alpha beta gamma y"), (None, "nothing here"), (None, None), (1, "alpha beta gamma"), (1, "other"), (2, "nothing here")]
    benchmark = spark.createDataFrame([(1, "alpha beta gamma")], ITEMS)
    kept = clean(spark.createDataFrame(docs, DOCS), benchmark)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([docs[1], docs[2], docs[5]], key=str)
