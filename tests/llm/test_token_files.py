"""Token files: a round trip through the index, and the index itself."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendmill.llm import token_files
from lendmill.llm.queries import tokenizer_path
from lendmill.llm.token_files import Index, id_type, look_up, read_digests, token_digests, write_token_files

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def wanted(rows, tokenizer, end=2):
    """By document in ascending order: start, number and checksum of its ids."""
    found, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        found.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def digests(df):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=lambda r: r[1])


def test_whole_table(spark, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 300_000)
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 100)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert digests(token_digests(documents, tokenizer_path(), 2)) == wanted(rows, tokenizer)


def test_edges(spark, tokenizer):
    rows = [
        (5, None), (3, ""), (9, "word " * 60_000), (1, "ΟΔΟΣ <|endoftext|> x.\x0b日本 é A. B."), (7, "same"), (7, "same"),
        (-4, "<|StartOfText|> It's, 'll \\u0000"), (8, "a" * 200_000), (2, "  \n\n\t "), (None, "no id"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit("clash")).withColumn("shard", F.lit(1))
    assert digests(token_digests(df, tokenizer_path(), 2)) == wanted(rows, tokenizer)
    assert token_digests(spark.createDataFrame([], SCHEMA), tokenizer_path(), 2).collect() == []


def test_files_hold_raw_ids_and_foreign_keys_are_not_found(spark, tokenizer, tmp_path):
    rows = [(i, f"text number {i}") for i in range(500)]
    folder = str(tmp_path / "set")
    keys = write_token_files(spark.createDataFrame(rows, SCHEMA), folder, tokenizer_path(), 2)
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "set").glob("ids-*.u16")))
    ids = [x for _, t in rows for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    assert id_type(tokenizer_path(), 2) == "<u2" and id_type(tokenizer_path(), 1 << 16) == "<u4"
    assert np.frombuffer(raw, "<u2").tolist() == ids
    assert not list((tmp_path / "set").glob("*.tmp"))
    foreign = keys.withColumn("key", F.xxhash64("key", F.lit("other")))
    assert look_up(folder, foreign).collect() == []
    one = read_digests(folder, keys.where("doc_id = 77"), "<u2").first()
    assert one["n_tokens"] == len(tokenizer.encode("text number 77").ids) + 1


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 40_000])
def test_index_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    index = Index.load(Index.build(keys, np.arange(n) % 7, np.arange(n) * 3, np.arange(n) + 1).dump())
    assert sorted(index.slot(keys).tolist()) == list(range(n))
    found = index.find(keys)
    assert found["start"].tolist() == [3 * i for i in range(n)] and found["length"].tolist() == list(range(1, n + 1))
    other = np.random.default_rng(n + 1).integers(0, 1 << 63, 2000).astype(np.uint64)
    assert (index.find(other)["shard"] != 0xFFFFFFFF).mean() < 0.001


def test_keys_left_after_the_last_level(monkeypatch):
    monkeypatch.setattr(token_files, "_LEVELS", 1)
    keys = np.random.default_rng(5).integers(0, 1 << 63, 1000).astype(np.uint64)
    index = Index.load(Index.build(keys, keys % 3, np.arange(1000), np.arange(1000)).dump())
    assert len(index.rest) > 100 and sorted(index.slot(keys).tolist()) == list(range(1000))
