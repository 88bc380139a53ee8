"""Batches that take from a source just what no run before has taken.

The table's versions carry a ledger: the files or the offsets that its rows come from. A run
reads what the ledger lacks, writes it aside, and commits rows and ledger as one version. A
run that is cut off leaves both as they were, so the next one takes the same messages
again, and each message counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructType

from lendmill.operators import flatten_messages
from lendmill.plans.paths import check_apart, check_path
from lendmill.schemas import FLAT, table
from lendmill.sinks import write_parquet
from lendmill.sources import MessageDir, MessageSource, Topic
from lendmill.sources.messages import read_files, read_range, topic_end
from lendmill.versions import Versions

TAKEN = table(name=StringType(), length=LongType())


def run_flatten_incremental(
    spark: SparkSession,
    source: MessageSource,
    flat_path: str,
    flatten: Callable[[DataFrame], DataFrame] = flatten_messages,
) -> int:
    """Flatten the messages that are new since the last run into the flat table; returns the
    number of rows added.

    Files of a directory must not change once they are there. The names of files already
    taken lie beside the rows of each run as a table, and only new names come to the driver;
    of a topic the ledger holds one offset per partition. One run at a time.
    """
    flat_path = check_path("flat_path", flat_path)
    place = source.path if isinstance(source, MessageDir) else None
    check_apart(spark, source=place, flat_path=flat_path)
    versions = Versions(spark, flat_path)
    last = versions.current()
    number = last.number + 1 if last else 1
    parts = last.parts if last else []
    offsets = dict(last.content["offsets"]) if last else {}
    directory = versions.fresh(number)
    if isinstance(source, Topic):
        end = topic_end(spark, source, offsets)
        if not end:
            return 0
        messages = read_range(spark, source, offsets, end)
        offsets |= end
    else:
        files = _new_files(spark, source, versions, parts)
        if not files:
            return 0
        spark.createDataFrame(files, TAKEN).coalesce(1).write.parquet(f"{versions.root}/{directory}/taken")
        messages = read_files(spark, source, [name for name, _ in files])
    written = write_parquet(flatten(messages), f"{versions.root}/{directory}/rows")
    versions.commit(number, {"parts": [*parts, directory], "offsets": offsets})
    return written["rows"]


def read_increments(spark: SparkSession, flat_path: str, schema: StructType = FLAT) -> DataFrame:
    """All rows that runs have added so far."""
    versions = Versions(spark, flat_path)
    version = versions.current()
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{versions.root}/{part}/rows" for part in version.parts])


def _new_files(
    spark: SparkSession, source: MessageDir, versions: Versions, parts: list[str]
) -> list[tuple[str, int]]:
    """Name and length of the files that no part has taken, by name."""
    listed = Versions(spark, source.path).sizes()
    # Unfinished and other hidden files, as Spark's readers know them, are not messages.
    found = [(name, size) for name, size in listed.items() if not name.startswith("_")]
    if not parts or not found:
        return found
    taken = spark.read.schema(TAKEN).parquet(*[f"{versions.root}/{part}/taken" for part in parts])
    left = spark.createDataFrame(found, TAKEN).join(taken, "name", "left_anti")
    return sorted((row["name"], row["length"]) for row in left.collect())
