"""Large ordered extracts, sorted in parallel."""

import random

import pytest

from lendmill.operators import ordered_range
from lendmill.sinks import export_csv
from lendmill.sinks import files as sinks

SCHEMA = "a int, b string, c double"


def made(size, ties):
    rnd = random.Random(size)
    return [
        (rnd.choice([None, *range(ties)]), rnd.choice([None, "", "x", "y"]), rnd.choice([None, float("nan"), -1.0, rnd.random()]))
        for _ in range(size)
    ]


def key(row):
    return [(v is not None, v != v, 0 if v is None or v != v else v) for v in row]


@pytest.mark.parametrize("rows", [0, 1, 3, 250, 499, 500, 900])
@pytest.mark.parametrize("ties", [1, 3, 1000])
def test_same_rows_as_a_full_sort(spark, rows, ties):
    data = made(500, ties)
    df = spark.createDataFrame(data, SCHEMA)
    found = [tuple(r) for r in ordered_range(df, rows, ["a", "b", "c"], ranges=6).collect()]
    assert list(map(key, found)) == list(map(key, sorted(data, key=key)[:rows]))


def test_half_of_a_table_in_several_ordered_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "HEAD_ROWS", 1000)
    path = tmp_path / "csv"
    df = spark.range(0, 20_000, 1, 8).selectExpr("pmod(id * 7919, 20000) AS k", "'x' AS v")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_csv(stored, str(path), limit=10_000, order_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(path.glob("part-*"))
    assert len(files) > 2
    lines = [line for f in files for line in f.read_text().splitlines()[1:]]
    assert lines == [f"{k},x" for k in range(10_000)]


def test_no_task_sorts_the_whole_extract(spark):
    df = spark.range(0, 10_000, 1, 4).selectExpr("id AS k")
    plan = ordered_range(df, 5_000, ["k"], ranges=8)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan
    limits = [int(part.split(",")[0]) for part in plan.split("TakeOrderedAndProject(limit=")[1:]]
    assert limits and max(limits) <= 2_500


def test_no_order_raises(spark):
    with pytest.raises(ValueError, match="order"):
        ordered_range(spark.range(3), 2, [])
