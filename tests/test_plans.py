"""What the physical plans must and must not hold."""

import re

import pytest

from lendmill.catalogue import QUERIES
from lendmill.operators import (
    application_metrics,
    enrich_applications,
    flatten_messages,
    ordered_head,
    share_by,
    stored_head,
    synth_messages,
    upsert_by_key,
)
from lendmill.schemas import APPLICATIONS
from lendmill.sources import MessageDir, read_csv_dir, read_messages

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in (
        "EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin",
    ):
        assert operator not in text


def test_flatten_is_narrow_and_parses_once(spark, tmp_path):
    synth_messages(spark.range(10)).write.text(str(tmp_path / "m"))
    text = plan(flatten_messages(read_messages(spark, MessageDir(str(tmp_path / "m")))))
    assert "Exchange" not in text
    assert text.count("from_json(") == 1


def test_enrich_is_narrow(spark):
    df = spark.read.schema(APPLICATIONS).parquet(f"{SF_DIR}/orders.parquet")
    assert "Exchange" not in plan(enrich_applications(df, "d"))


def test_metrics_read_only_what_they_need(spark, tmp_path):
    spark.createDataFrame([], APPLICATIONS).write.option("header", True).csv(str(tmp_path / "in"))
    df = enrich_applications(read_csv_dir(spark, str(tmp_path / "in"), APPLICATIONS), "d")
    text = plan(application_metrics(df))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(
        ["application_id", "region_code", "product_type", "decision_status", "requested_amount", "credit_score"]
    )
    assert "PushedFilters: [IsNotNull(application_id)]" in text
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_share_scans_once(spark):
    df = share_by(spark.read.parquet(f"{SF_DIR}/events.parquet"), "event_type")
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_ordered_head_is_a_top_n(spark):
    df = ordered_head(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), 10, ["l_orderkey", "l_linenumber"])
    assert "TakeOrderedAndProject" in plan(df)
    assert "rangepartitioning" not in plan(df)


def test_stored_head_pushes_its_bound_into_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(stored_head(orders, 10, ["o_orderkey"]))
    assert "PushedFilters: [Or(IsNull(o_orderkey),LessThanOrEqual(o_orderkey,ScalarSubquery" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_batch_is_reduced_before_the_shuffle(spark):
    target = spark.read.parquet(f"{SF_DIR}/customer.parquet").selectExpr("c_custkey AS k", "c_name AS v")
    batch = spark.read.parquet(f"{SF_DIR}/events.parquet").selectExpr("user_id AS k", "event_type AS v", "ts")
    text = plan(upsert_by_key(target, batch, ["k"], order_by=["ts"]))
    assert "partial_max" in text
    assert "BroadcastHashJoin" in text and "Window" not in text
    assert re.search(r"PushedFilters: \[[^\]]*\], ReadSchema: struct<user_id:bigint>", text)


def test_hot_key_sends_one_row_per_task(spark):
    """A third of the batch has one key; the shuffle sees it once per map task."""
    batch = spark.range(0, 30_000, 1, 4).selectExpr("if(id < 10000, -1, id) AS k", "id AS v", "id AS at")
    merged = upsert_by_key(spark.range(100).selectExpr("id AS k", "id AS v"), batch, ["k"], order_by=["at"])
    rows = {r["k"]: r["v"] for r in merged.collect()}
    assert rows[-1] == 9_999 and len(rows) == 20_101
    text = merged._jdf.queryExecution().executedPlan()
    shuffled = []

    def walk(node):
        if node.nodeName() == "Exchange":
            shuffled.append(node.metrics().apply("shuffleRecordsWritten").value())
        for children in (node.children(), node.innerChildren()):
            for i in range(children.size()):
                walk(children.apply(i))
        for inner in ("plan", "executedPlan"):
            if node.nodeName() in ("ShuffleQueryStage", "ResultQueryStage", "BroadcastQueryStage") and inner == "plan":
                walk(node.plan())
            if node.nodeName() == "AdaptiveSparkPlan" and inner == "executedPlan":
                walk(node.executedPlan())

    walk(text)
    assert shuffled and max(shuffled) <= 20_000 + 4
