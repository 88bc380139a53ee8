"""The hash tree's laws."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendmill.llm.sharding import Shard, even_tree, grown, place, sharded

SCHEMA = "doc_id long, text string"


def test_whole_table(spark, documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = sharded(documents, even_tree(16)).collect()
    assert len(found) == len(rows)
    slots = {}
    for r in found:
        data = rows[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0.02 < sum(r["grown_shard"] == 16 for r in found) / len(found) < 0.12


def shards(spark, tree, n=40_000):
    return [r[0] for r in spark.range(n).select(place(F.col("id"), tree)).collect()]


def test_weights_are_followed(spark):
    tree = [Shard("a", "x", 0, 1.0), Shard("a", "x", 1, 3.0), Shard("a", "y", 2, 2.0), Shard("b", "x", 3, 2.0)]
    counts = Counter(shards(spark, tree))
    for s in tree:
        assert abs(counts[s.shard] / 40_000 - s.weight / 8) < 0.01


def test_a_change_moves_only_into_or_out_of_its_subtree(spark):
    tree = even_tree(16, 4, 2)
    before = shards(spark, tree)
    heavier = [Shard(s.region, s.rack, s.shard, 2.0 if s.shard == 5 else 1.0) for s in tree]
    region = {s.shard for s in tree if s.region == tree[5].region}
    moved = [(a, b) for a, b in zip(before, shards(spark, heavier)) if a != b]
    assert moved and all(b in region for _, b in moved)
    rack = {s.shard for s in tree if (s.region, s.rack) == (tree[5].region, tree[5].rack)}
    assert all(b == 5 for a, b in moved if a in rack) and all(b in rack for a, b in moved if a in region)
    assert all(b == 16 for a, b in zip(before, shards(spark, grown(tree))) if a != b)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "é" * 500_000), (4, "x"), (4, "x"), (4, "y"), (None, "z")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash")).withColumn("size", F.lit(0))
    found = sharded(df, even_tree(3)).collect()
    assert sorted(r["size"] for r in found) == [1, 1, 2, 2, 2, 2, 1_000_001]
    assert len({r["shard"] for r in found if r["doc_id"] == 4}) == 1
    assert len({(r["shard"], r["slot"]) for r in found}) == len(rows)
    assert sharded(spark.createDataFrame([], SCHEMA), even_tree(3)).collect() == []
    for wrong in ([], [Shard("a", "b", 0, 0.0)], [Shard("a", "b", 0), Shard("a", "c", 0)]):
        with pytest.raises(ValueError):
            place(F.lit(1), wrong)


def test_slots_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr("lendmill.llm.sharding.CHUNK_ROWS", 7)
    found = sharded(spark.range(1000).selectExpr("id AS doc_id", "'t' AS text"), even_tree(4)).collect()
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
