"""Tasks that fail after giving out all their rows and are run again."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from lendmill.operators import count_by, flatten_messages, share_by, synth_messages, upsert_by_key
from lendmill.sinks import write_parquet


def lose_first_attempts(batches):
    yield from batches
    task = TaskContext.get()
    if task.attemptNumber() < 2 and task.partitionId() in (1, 3):
        raise RuntimeError("executor lost")


@pytest.fixture
def flaky(spark):
    return spark.range(0, 20_000, 1, 8).mapInPandas(lose_first_attempts, "id long")


@pytest.mark.parametrize("files, shuffle", [(None, True), (3, True), (3, False)])
def test_observed_figures_count_each_row_once(spark, flaky, tmp_path, files, shuffle):
    written = write_parquet(
        flaky, str(tmp_path / "t"), files, shuffle=shuffle, metrics=[F.sum("id").alias("ids")]
    )
    assert written == {"rows": 20_000, "ids": sum(range(20_000))}
    assert spark.read.parquet(str(tmp_path / "t")).distinct().count() == 20_000


def test_results_are_whole(spark, flaky):
    flat = flatten_messages(synth_messages(flaky))
    assert flat.select("application_id").distinct().count() == flat.count() == 20_000
    assert {r["cnt"] for r in count_by(flat, "decision_status").collect()} == {5_000}
    assert {r["share"] for r in share_by(flat, "decision_status").collect()} == {25.0}
    held = spark.range(10_000, 30_000).selectExpr("id AS k", "'old' AS v")
    merged = upsert_by_key(held, flaky.selectExpr("id AS k", "'new' AS v"), ["k"])
    assert {r["v"]: r["cnt"] for r in count_by(merged, "v").collect()} == {"new": 20_000, "old": 10_000}
