"""The Jaccard join against all pairs."""

import random
import re
from itertools import combinations

import pytest

from lendmill.llm.jaccard import jaccard_components, keep_one

SCHEMA = "doc_id long, text string"


def sets_of(rows, size=5):
    found = {}
    for doc_id, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        found[doc_id] = runs or ({tuple(words)} if words else set())
    return found


def brute(rows, size=5, percent=80):
    sets = sets_of(rows, size)
    component = {d: d for d in sets}

    def top(d):
        while component[d] != d:
            d = component[d]
        return d

    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    pairs = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            component[high] = low
    return sorted((d, len(s), top(d)) for d, s in sets.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def variants(seed, groups, copies, words, changes):
    """Groups of texts in which each copy changes some words of one base."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(10_000)}" for _ in range(rng.randint(5, words))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, changes)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i * 3, text) for i, text in enumerate(rows)]


def test_whole_table(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert rows_of(jaccard_components(documents)) == brute(rows)


@pytest.mark.parametrize("seed", range(2))
def test_variants(spark, seed):
    rows = variants(seed, 30, 12, 150, 3)
    assert rows_of(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_one_large_group_and_other_threshold(spark):
    rows = variants(5, 1, 300, 120, 4) + [(10_000 + i, f"other text number {i} of its own") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(jaccard_components(df)) == brute(rows)
    assert rows_of(jaccard_components(df, size=2, percent=60)) == brute(rows, 2, 60)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO"), (6, "one two three"),
        (7, long), (8, long + " more"), (9, "é É ß ẞ x"), (10, "é É ß ẞ X"), (11, "É É ß ẞ x"),
    ]
    assert rows_of(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(5, "a b c d e f", 1, "x"), (5, "a b c d e f", 2, "y"), (3, "A b c d e f", 3, "z"), (None, "a b c d e f", 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, `node` string")
    assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == sorted(
        [(3, 2, 3), (5, 2, 3), (5, 2, 3), (None, 2, None)], key=str
    )
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["n"] for r in kept.collect()) == [3, 4]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jaccard_components(df).collect() == [] and keep_one(df).collect() == []
