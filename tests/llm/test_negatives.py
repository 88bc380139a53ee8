"""Hard negatives against brute force over whole numbers of Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmill.llm.negatives import Residues, hard_negatives, is_prime, whole_rows
from lendmill.llm.queries import QUERIES
from lendmill.llm.tables import stored

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, each=100):
    kept = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if vec_id not in kept or (label, whole) < kept[vec_id]:
            kept[vec_id] = (label, whole)
    found = set()
    for anchor, (label, vector) in kept.items():
        if anchor % each:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, other)), vec_id, kind == label)
            for vec_id, (kind, other) in kept.items()
            if vec_id != anchor
        ]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2]][:5]:
            inside = [
                (i, s) for s, i, same in scored if not same and 80 * -score <= 100 * -s <= 100 * -score
            ]
            for rank, (negative, s) in enumerate(inside[:5], 1):
                found.add((anchor, positive, rank, negative, -score, -s))
    return found


def mined(df, each=100):
    rows = stored(whole_rows(df), "rows")
    found = [tuple(r) for r in hard_negatives(rows, F.col("vec_id") % each == 0).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_of_the_tables(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    moved = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label)
        for r in rows
    ]
    found = QUERIES["op13_hard_negatives"](spark, f"/root/testdata/{sf}")
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    wanted = brute(moved)
    assert wanted and {tuple(r) for r in found.collect()} == wanted


def made(seed, size, width, labels=3, spread=1.0):
    rnd = random.Random(seed)
    base = [[rnd.uniform(-spread, spread) for _ in range(width)] for _ in range(4)]
    return [
        (i, [float(np.float32(x + rnd.choice([0, 0, 0.02 * spread]))) for x in rnd.choice(base)], rnd.randrange(labels))
        for i in range(size)
    ]


@pytest.mark.parametrize("width, spread", [(3, 1.0), (70, 1.0), (5, 5000.0), (1, 0.0)])
def test_blocks_and_ties(spark, monkeypatch, width, spread):
    monkeypatch.setattr("lendmill.llm.negatives.BLOCK_ROWS", 40)
    rows = made(width, 300, width, spread=spread)
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == brute(rows, 10)


def test_edge_rows(spark):
    rows = made(1, 60, 4)
    odd = [
        (None, [1.0], 1), (500, None, 1), (501, [1.0], None), (502, [None, 1.0], 1),
        (503, [float("nan")], 1), (504, [float("inf")], 1), (505, [], 2), (600, [], 1),
        (506, [0.5], 1), (10, [0.25, 0.25, 0.25, 0.25], 0), (-100, [0.5, 0.5], 1),
    ]
    rows += odd + rows[:5]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("positive_id", F.lit("x")).withColumn("row", F.lit(1))
    assert mined(df, 10) == brute(rows, 10)
    assert mined(df.limit(0)) == set()
    assert mined(df.where("vec_id = 1")) == set()


def test_scores_beyond_the_numbers_raise(spark):
    df = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        mined(df)
    with pytest.raises(ValueError, match="62 bits"):
        Residues(2, 1 << 62)


@pytest.mark.parametrize("width, size", [(1, 1), (64, 300), (1500, 1 << 20), (3, 1 << 29)])
def test_residues_give_exact_products(width, size):
    rnd = np.random.default_rng(width)
    a, b = (rnd.integers(-size, size + 1, (n, width)) for n in (7, 9))
    bound = max(int((m.astype(object) ** 2).sum(axis=1).max()) for m in (a, b))
    system = Residues(width, bound)
    assert all(map(is_prime, system.primes)) and len(set(system.primes)) == len(system.primes)
    assert all(system.panel * (p // 2) ** 2 <= 1 << 24 for p in system.primes)
    wanted = a.astype(object) @ b.astype(object).T
    assert (system.scores(system.split(a), system.split(b)) == wanted).all()
