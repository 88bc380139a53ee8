"""Language identification: held-out accuracy, prediction against a plain loop, edges."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lendmill.llm import language
from lendmill.llm.language import accepted, identify, predict, train
from lendmill.llm.words import chunks

SCHEMA = "doc_id long, text string, lang string"


def test_held_out_accuracy_and_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    right = found["lang"] == found["lang_pred"]
    assert right.mean() > 0.99 and found["score"].between(0, 1).all()
    assert abs(found["score"].mean() - right.mean()) < 0.02
    assert found["score"][right].mean() > found["score"][~right].mean()


def test_folds_and_what_predictions_use(spark, documents):
    found = {r["doc_id"]: r for r in identify(documents).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in found.items())
    held_out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(3)) == 1
    other = documents.withColumn("lang", F.when(held_out, F.lit("xx")).otherwise(F.col("lang")))
    assert {r["doc_id"]: tuple(r) for r in identify(other.withColumn("source", F.lit(1))).collect()} == {
        d: tuple(r) for d, r in found.items()
    }


def test_subwords_against_a_loop():
    texts = ["Ab  é\n", "", None, "x", "  \t yes NO ", "ab" * 50]
    chunk = next(chunks(pa.array(texts)))
    data, counts = language._squeezed(chunk)
    plain = []
    for t in texts:
        t = "".join(c.lower() if c.isascii() else c for c in t or "")
        plain.append((" " + " ".join(t.replace("\n", " ").replace("\t", " ").split(" ")) + " ").encode())
    plain = [b" " + __import__("re").sub(rb"\s+", b" ", p[1:-1]) + b" " for p in plain]
    assert bytes(data) == b"".join(plain) and counts.tolist() == [len(p) for p in plain]
    for length in language.LENGTHS:
        _, n = language._buckets(data, counts, length)
        assert n.tolist() == [max(0, len(p) - length + 1) for p in plain]
    scores = np.random.default_rng(0).normal(size=(language.BUCKETS, 3)).astype(np.float32)
    whole = language._logits(chunk, scores)
    for i, t in enumerate(texts):
        one = language._logits(next(chunks(pa.array([t], pa.string()))), scores)
        assert np.allclose(one[0], whole[i], atol=1e-6)
    shares = np.concatenate(list(language._features(pa.array(texts))))
    assert np.allclose(shares @ scores, whole, atol=1e-5)


def test_edges(spark):
    rows = [(i, "the cat sat on the mat and more" if i % 2 else "der hund und die katze im haus", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !!", "de"), (103, "the mat", None), (None, "the mat", "en"), (104, "der hund " * 50_000, "de"), (104, "der hund", "de")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("letters", F.lit(0))
    found = identify(df).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows)
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (100, 101, 102))
    assert by[103]["lang_pred"] == by[None]["lang_pred"] == "en" and not by[None]["held_out"]
    kept = accepted(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    empty = spark.createDataFrame([], SCHEMA)
    assert identify(empty).collect() == [] and train(empty) is None
    assert [tuple(r) for r in predict(df.where("doc_id = 1"), None).collect()] == [(1, "und", 0.0)]
