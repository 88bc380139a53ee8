import pytest

from lendmill.operators import flatten_messages, synth_messages
from lendmill.plans import run_flatten_batch, run_flatten_stream, run_publish
from lendmill.schemas import FLAT
from lendmill.sinks import write_messages
from lendmill.sources import MessageDir
from lendmill.streaming import read_message_stream, write_stream


@pytest.fixture
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("topic", "flat", "checkpoint", "batch", "csv")}


def same_rows(left, right):
    return left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_stream_equals_batch(spark, places):
    source = MessageDir(places["topic"])
    run_publish(spark, source, 5000)
    edges = ["{bad", "[1]", '{"documents":[{"type":"a"},{"type":"b"}]}', '{"documents":[]}']
    write_messages(spark.createDataFrame([(e,) for e in edges], "value string"), source)
    batch = run_flatten_batch(spark, source, places["batch"])
    streamed = run_flatten_stream(spark, source, places["flat"], places["checkpoint"], view="streamed")
    assert batch.rows == streamed.count() == 5005
    assert same_rows(streamed, spark.read.parquet(batch.flat_path))
    assert spark.sql("SELECT count(*) FROM streamed").first()[0] == 5005


def test_restart_takes_only_what_is_new(spark, places):
    source = MessageDir(places["topic"])
    run_publish(spark, source, 100)

    def run():
        return run_flatten_stream(spark, source, places["flat"], places["checkpoint"]).count()

    assert run() == 100
    assert run() == 100
    write_messages(synth_messages(spark.range(100, 130)), source)
    assert run() == 130


def test_cut_off_run_goes_on_without_loss_or_doubles(spark, places):
    source = MessageDir(places["topic"], files_per_trigger=1)
    for start in range(0, 60, 10):
        write_messages(synth_messages(spark.range(start, start + 10, numPartitions=2)), source)
    flat = flatten_messages(read_message_stream(spark, source))
    with pytest.raises(TimeoutError):
        write_stream(flat, places["flat"], places["checkpoint"], timeout=0.01)
    result = run_flatten_stream(spark, source, places["flat"], places["checkpoint"])
    assert result.count() == result.select("application_id").distinct().count() == 60


def test_empty_source(spark, places, tmp_path):
    (tmp_path / "topic").mkdir()
    source = MessageDir(places["topic"])
    result = run_flatten_stream(spark, source, places["flat"], places["checkpoint"])
    assert result.count() == 0
    assert result.columns == FLAT.names


def test_query_name_and_mode(spark, places):
    source = MessageDir(places["topic"])
    run_publish(spark, source, 10)
    flat = flatten_messages(read_message_stream(spark, source))
    assert flat.isStreaming
    query = write_stream(flat, places["flat"], places["checkpoint"], name="flat_run", timeout=120)
    assert query.name == "flat_run"
    assert not query.isActive
    assert query.lastProgress["numInputRows"] == 10


def test_batch_extract_is_ordered_and_limited(spark, places):
    source = MessageDir(places["topic"])
    run_publish(spark, source, 2500)
    run = run_flatten_batch(spark, source, places["batch"], places["csv"], extract_rows=1000)
    assert run.rows == 2500
    extract = spark.read.option("header", True).schema(FLAT).csv(places["csv"])
    ids = sorted(f"loan_{i}" for i in range(2500))[:1000]
    assert sorted(r["application_id"] for r in extract.collect()) == ids


def test_same_path_twice_raises(spark, places):
    source = MessageDir(places["topic"])
    with pytest.raises(ValueError, match="same path"):
        run_flatten_stream(spark, source, places["flat"], places["flat"])
    with pytest.raises(ValueError, match="same path"):
        run_flatten_batch(spark, source, places["batch"], places["batch"])
