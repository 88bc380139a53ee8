"""Toxicity: accuracy on rows that were not fitted, the model against a loop, edges."""

import numpy as np
from pyspark.sql import functions as F

from lendmill.llm import toxicity as module
from lendmill.llm.toxicity import Sample, gathered, score, split_top, toxicity, train


def test_rows_that_were_not_fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity(docs, labels.where("doc_id % 2 = 0"))
    rows = found.withColumnRenamed("toxic", "found").join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    caught = rows["found"][rows["toxic"] == 1].mean()
    wrong = rows["found"][rows["toxic"] == 0].mean()
    assert caught > 0.8 and wrong < 0.05
    assert rows["severity"][rows["toxic"] == 1].mean() > 5 * rows["severity"][rows["toxic"] == 0].mean()


def test_grades_share_weights_and_are_ordered():
    rng = np.random.default_rng(1)
    grade = np.repeat([0, 1, 2], 200)
    row, feature = [], []
    for i, g in enumerate(grade):
        for f in range(12):
            if rng.random() < 0.05 + 0.3 * g:
                row.append(i)
                feature.append(f)
        row += [i, i]
        feature += rng.integers(100, 150, 2).tolist()
    pairs = np.unique(np.stack([row, feature], 1), axis=0)
    model = train(Sample(pairs[:, 0], pairs[:, 1], grade))
    assert set(model.features) >= set(range(12)) and (model.weights > 0).mean() > 0.9
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]


def test_top_half_gets_its_own_grade():
    row, feature = np.array([(i, f) for i in range(80) for f in range(i // 20 + 1)]).T
    grade = (np.arange(80) >= 20).astype(int)
    split = split_top(Sample(row, feature, grade)).grade
    assert set(split[:20]) == {0} and set(split[20:]) <= {1, 2}


def test_edges(spark):
    clean = "some plain words about the day number "
    rows = [(i, clean + str(i) + (" you moronic fool" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(200)]
    docs = [(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (1002, "plain day " * 40_000), (1003, clean + "MORONIC, fool!"), (1003, clean + "MORONIC, fool!"), (None, "moronic fool")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("grade", F.lit("clash")).withColumn("toxic", F.lit(5))
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(0, 1, 1), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    found = toxicity(df, labels).collect()
    assert len(found) == len(docs)
    by = {r["doc_id"]: r for r in found}
    assert all(by[i]["toxic"] == (i % 4 == 0) for i in range(200))
    assert by[1003]["toxic"] and by[None]["toxic"] and not by[1002]["toxic"]
    assert by[1000]["severity"] == by[1001]["severity"] < 0.25
    none = toxicity(df, labels.limit(0)).collect()
    assert len(none) == len(docs) and not any(r["toxic"] or r["severity"] for r in none)
    assert toxicity(df.limit(0), labels).collect() == []
    assert score(df.limit(0), None).collect() == []


def test_distinct_texts_only(spark):
    df = spark.createDataFrame([("a b c", 0), ("A, b. c", 0), ("a b c", 1)], "text string, grade int")
    assert gathered(df).grade.tolist() == [0, 1]
    assert module.FEATURES == 1 << 31
