import json

import pytest

from lendmill.cli import main, message_place, read_settings
from lendmill.schemas import APPLICATIONS, CALLS
from lendmill.sinks import snapshot_table
from lendmill.sources import MessageDir, Topic


@pytest.fixture
def run(spark, capsys):
    def go(*argv):
        main([str(a) for a in argv], spark)
        return capsys.readouterr().out

    return go


def last(output):
    return json.loads(output.strip().splitlines()[-1])


def test_messages_to_dashboard(run, spark, tmp_path):
    topic, flat, checkpoint = tmp_path / "topic", tmp_path / "flat", tmp_path / "checkpoint"
    assert last(run("publish", topic, "--rows", 1200)) ["rows"] == 1200
    out = run("flatten-batch", topic, flat, "--extract", tmp_path / "csv", "--preview")
    assert last(out)["rows"] == 1200
    assert "|-- doc_status: string" in out and "passport" in out
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1000
    assert last(run("flatten-stream", topic, tmp_path / "stream", checkpoint, "--preview"))["rows"] == 1200
    again = tmp_path / "again"
    run("publish", again, "--table", flat)
    assert spark.read.text(str(again)).count() == 1200
    paths = last(run("dashboard", flat, tmp_path / "charts"))
    assert spark.read.parquet(paths["decision_count"]).count() == 4


def test_loan_batch(run, spark, tmp_path):
    rows = [("a", None, "c", "R", "p", 10.0, 1, 700, "low", "Approved", 1.0, "web", True, 1)]
    snapshot_table(spark.createDataFrame(rows, APPLICATIONS), str(tmp_path / "in"))
    printed = run("loan-batch", tmp_path / "in", tmp_path / "out", "2026-06-16", "--keys", "region_code", "--preview")
    out = last(printed)
    assert "|-- is_approved: boolean" in printed and out["malformed"] == 0
    assert (out["loaded"], out["total"], out["approved"], out["avg_score"]) == (1, 1, 1, 700.0)
    with pytest.raises(ValueError, match="s3a"):
        run("loan-batch", tmp_path / "in", tmp_path / "out", "2026-06-16", "--schemes", "s3a")


def test_calls(run, spark, tmp_path):
    rows = [(f"c{i}", "t", "client", "DE-HE", "loan_offer", "busy", "declined", i, "true") for i in range(3)]
    snapshot_table(spark.createDataFrame(rows, CALLS), str(tmp_path / "day1"))
    snapshot_table(spark.createDataFrame([("c9", *rows[0][1:])], CALLS), str(tmp_path / "day2"))
    assert last(run("call-upsert", tmp_path / "day1", tmp_path / "calls", "--buckets", 4)) == {"rows": 3}
    assert last(run("call-upsert", tmp_path / "day2", tmp_path / "calls")) == {"rows": 4}
    repeated = [("c1", *rows[0][1:7], n, "true") for n in (7, 8)]
    snapshot_table(spark.createDataFrame(repeated, CALLS), str(tmp_path / "day3"))
    with pytest.raises(Exception, match="key repeated"):
        run("call-upsert", tmp_path / "day3", tmp_path / "calls")
    out = run("call-upsert", tmp_path / "day3", tmp_path / "calls", "--order-by", "duration_sec")
    assert last(out) == {"rows": 4}
    assert "|total_rows|" in run("call-report", tmp_path / "calls")
    run("call-snapshot", tmp_path / "calls", tmp_path / "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4


def test_message_place(tmp_path):
    options = tmp_path / "options.json"
    options.write_text('{"kafka.bootstrap.servers": "host:9092"}')
    assert message_place("topic:loans", str(options)) == Topic("loans", {"kafka.bootstrap.servers": "host:9092"})
    assert message_place("s3a://bucket/in", None) == MessageDir("s3a://bucket/in")


def test_settings_from_a_file(run, spark, tmp_path):
    file = tmp_path / "job.properties"
    file.write_text("# job\nspark.sql.shuffle.partitions = 3\n\nspark.sql.adaptive.enabled true\nspark.master: x=y\n")
    assert read_settings(str(file)) == {
        "spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.enabled": "true", "spark.master": "x=y",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        run("--settings", file, "publish", tmp_path / "topic", "--rows", 5)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
