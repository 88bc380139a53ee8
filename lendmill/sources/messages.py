"""Message sources: a topic behind Spark's Kafka connector, or a text directory.

Both give one column ``value`` with the message body as text.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Topic:
    """A topic. ``options`` holds servers and credentials, from the caller.

    Reading takes one task per topic partition; ``minPartitions`` in ``options``
    splits large partitions further, ``maxOffsetsPerTrigger`` bounds a micro-batch.
    ``connector`` names the Spark data source. Reading from given offsets has to name
    all ``partitions`` of the topic; those without messages so far start at their beginning.
    """

    name: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    connector: str = "kafka"
    partitions: int = 1

    def read_options(self) -> dict[str, str]:
        return {"subscribe": self.name, "startingOffsets": "earliest", **self.options}

    def range_options(self, start: Mapping[str, int], end: Mapping[str, int] | None) -> dict[str, str]:
        """To read from the offsets ``start``, by partition, up to those of ``end``."""
        every = {str(p) for p in range(self.partitions)} | {*start} | {*(end or ())}
        earliest, latest = -2, -1
        first = {p: start.get(p, earliest) for p in sorted(every)}
        options = self.read_options() | {"startingOffsets": json.dumps({self.name: first})}
        if end is not None:
            last = {p: end.get(p, start.get(p, latest)) for p in sorted(every)}
            options["endingOffsets"] = json.dumps({self.name: last})
        return options

    def write_options(self) -> dict[str, str]:
        return {"topic": self.name, **self.options}


@dataclass(frozen=True)
class MessageDir:
    """A directory of text files, one message per line."""

    path: str
    files_per_trigger: int | None = None

    def read_options(self) -> dict[str, str]:
        return {"lineSep": "\n"}

    def stream_options(self) -> dict[str, str]:
        limit = self.files_per_trigger
        return self.read_options() | ({} if limit is None else {"maxFilesPerTrigger": str(limit)})


MessageSource = Topic | MessageDir


def message_body(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("CAST(value AS STRING) AS value")


def read_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """Everything the source holds, from its beginning to its end at the start of the job."""
    if isinstance(source, Topic):
        reader = spark.read.format(source.connector).options(**source.read_options())
        return message_body(reader.load())
    return message_body(spark.read.format("text").options(**source.read_options()).load(source.path))


def topic_end(spark: SparkSession, topic: Topic, start: Mapping[str, int]) -> dict[str, int]:
    """Up to where each partition is filled now, those without anything after ``start`` left
    out. A pass of its own over offsets, so that the reading pass has a fixed range."""
    reader = spark.read.format(topic.connector).options(**topic.range_options(start, None))
    ends = reader.load().groupBy("partition").agg((F.max("offset") + 1).alias("end"))
    return {str(row["partition"]): row["end"] for row in ends.collect()}


def read_range(
    spark: SparkSession, topic: Topic, start: Mapping[str, int], end: Mapping[str, int]
) -> DataFrame:
    """The messages between two sets of offsets, the same whenever they are read."""
    reader = spark.read.format(topic.connector).options(**topic.range_options(start, end))
    return message_body(reader.load())


def read_files(spark: SparkSession, source: MessageDir, names: Sequence[str]) -> DataFrame:
    """The messages of some files of a directory."""
    reader = spark.read.format("text").options(**source.read_options())
    return message_body(reader.load([f"{source.path.rstrip('/')}/{name}" for name in names]))
