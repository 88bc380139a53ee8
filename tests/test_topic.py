"""The connector path, with a stand-in that keeps a topic in a directory of JSON lines.

It takes the connector's options and has its columns; what a real broker adds is not tested.
"""

import base64
import json
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    SimpleDataSourceStreamReader,
    WriterCommitMessage,
)

from lendmill.plans import (
    read_increments,
    run_flatten_batch,
    run_flatten_incremental,
    run_flatten_stream,
    run_publish,
)
from lendmill.schemas import FLAT
from lendmill.sinks import write_messages
from lendmill.sources import Topic, read_messages

SERVERS = "kafka.bootstrap.servers"


def stored(options):
    """Every message of the topic with its offset, nulls among them."""
    bodies = []
    for file in sorted(Path(options[SERVERS], options["subscribe"]).glob("*.jsonl")):
        bodies += [json.loads(line) for line in file.read_text().splitlines()]
    start, end = (range_of(options, name) for name in ("startingOffsets", "endingOffsets"))
    for offset, body in list(enumerate(bodies))[start if start >= 0 else 0 : end if end >= 0 else None]:
        value = None if body is None else base64.b64decode(body)
        yield None, value, options["subscribe"], 0, offset


def range_of(options, name):
    """The offset of the only partition; below 0 for the beginning and the end."""
    text = options.get(name.lower(), "earliest")
    return json.loads(text)[options["subscribe"]]["0"] if text.startswith("{") else -1


class StandIn(DataSource):
    @classmethod
    def name(cls):
        return "topic_stand_in"

    def schema(self):
        return "key binary, value binary, topic string, partition int, offset long"

    def reader(self, schema):
        return BatchReader(dict(self.options))

    def simpleStreamReader(self, schema):
        assert self.options["startingOffsets"] == "earliest"
        return StreamReader(dict(self.options))

    def writer(self, schema, overwrite):
        assert schema.names == ["value"] and not overwrite
        return Writer(dict(self.options))


class BatchReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def read(self, partition):
        return stored(self.options)


class StreamReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.options = options

    def initialOffset(self):
        return {"next": 0}

    def read(self, start):
        rows = list(stored(self.options))[start["next"]:]
        return iter(rows), {"next": start["next"] + len(rows)}

    def readBetweenOffsets(self, start, end):
        return iter(list(stored(self.options))[start["next"]:end["next"]])


class Writer(DataSourceWriter):
    def __init__(self, options):
        self.options = options

    def write(self, rows):
        folder = Path(self.options[SERVERS], self.options["topic"])
        folder.mkdir(parents=True, exist_ok=True)
        lines = []
        for row in rows:
            body = row["value"]
            lines.append(json.dumps(None if body is None else base64.b64encode(body.encode()).decode()))
        if lines:
            (folder / f"{time.time_ns()}-{uuid.uuid4().hex}.jsonl").write_text("\n".join(lines) + "\n")
        return WriterCommitMessage()


@pytest.fixture
def topic(spark, tmp_path):
    spark.dataSource.register(StandIn)
    return Topic("loans", {SERVERS: str(tmp_path / "broker")}, connector="topic_stand_in")


def test_publish_and_flatten(spark, topic, tmp_path):
    run_publish(spark, topic, 300)
    assert read_messages(spark, topic).schema.simpleString() == "struct<value:string>"
    run = run_flatten_batch(spark, topic, str(tmp_path / "flat"), str(tmp_path / "csv"))
    assert run.rows == 300
    flat = spark.read.parquet(run.flat_path)
    assert flat.columns == FLAT.names
    assert flat.select("application_id").distinct().count() == 300


def test_null_bodies_pass_the_topic_and_are_dropped_on_flatten(spark, topic, tmp_path):
    write_messages(spark.createDataFrame([(None,), ("{}",)], "value string"), topic)
    assert read_messages(spark, topic).count() == 2
    assert run_flatten_batch(spark, topic, str(tmp_path / "flat")).rows == 1


def test_stream_goes_on_from_its_checkpoint(spark, topic, tmp_path):
    def run():
        places = (str(tmp_path / "flat"), str(tmp_path / "checkpoint"))
        return run_flatten_stream(spark, topic, *places, view="from_topic").count()

    run_publish(spark, topic, 50)
    assert run() == 50
    assert run() == 50
    run_publish(spark, topic, 20)
    assert run() == 70
    assert spark.sql("SELECT count(DISTINCT application_id) FROM from_topic").first()[0] == 50


def test_batches_take_each_message_once(spark, topic, tmp_path):
    path = str(tmp_path / "flat")

    def run():
        return run_flatten_incremental(spark, topic, path)

    run_publish(spark, topic, 50)
    assert (run(), run()) == (50, 0)
    run_publish(spark, topic, 20)
    with pytest.raises(Exception, match="cut off"):
        run_flatten_incremental(spark, topic, path, lambda m: m.selectExpr("raise_error('cut off') AS region"))
    assert read_increments(spark, path).count() == 50
    assert (run(), run()) == (20, 0)
    found = read_increments(spark, path)
    assert found.count() == 70 and found.select("application_id").distinct().count() == 50
    # A null body adds no row; its offset is taken all the same.
    write_messages(spark.createDataFrame([(None,)], "value string"), topic)
    assert (run(), run()) == (0, 0)


def test_offsets_name_every_partition():
    topic = Topic("loans", {}, partitions=3)
    options = topic.range_options({"0": 5}, None)
    assert json.loads(options["startingOffsets"]) == {"loans": {"0": 5, "1": -2, "2": -2}}
    options = topic.range_options({"0": 5, "1": 2}, {"0": 9, "3": 1})
    assert json.loads(options["startingOffsets"]) == {"loans": {"0": 5, "1": 2, "2": -2, "3": -2}}
    assert json.loads(options["endingOffsets"]) == {"loans": {"0": 9, "1": 2, "2": -1, "3": 1}}
