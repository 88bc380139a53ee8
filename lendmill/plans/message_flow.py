"""Nested messages: publish, flatten as a batch, flatten as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lendmill.functions.layout import Layout
from lendmill.operators import (
    flatten_messages,
    ordered_range,
    pack_messages,
    stored_head,
    synth_messages,
)
from lendmill.plans.paths import check_apart, check_path
from lendmill.schemas import FLAT, MESSAGE_LAYOUT
from lendmill.sinks import export_csv, refresh_table, write_messages
from lendmill.sinks.files import HEAD_ROWS
from lendmill.sources import MessageDir, MessageSource, read_messages, read_parquet_table, table_path
from lendmill.streaming import read_message_stream, stream_result, write_stream

EXTRACT_ROWS = 1000


@dataclass(frozen=True)
class FlattenResult:
    rows: int
    flat_path: str
    extract_path: str | None


def run_publish(
    spark: SparkSession, sink: MessageSource, rows: DataFrame | int, layout: Layout = MESSAGE_LAYOUT
) -> None:
    """Append a message for each row of a table to the sink, nested by ``layout``.

    A number stands for so many synthetic applications, numbered from 0.
    """
    if isinstance(rows, int):
        messages = synth_messages(spark.range(rows))
    else:
        messages = pack_messages(rows, layout)
    write_messages(messages, sink)


def _place(source: MessageSource) -> str | None:
    return source.path if isinstance(source, MessageDir) else None


def run_flatten_batch(
    spark: SparkSession,
    source: MessageSource,
    flat_path: str,
    extract_path: str | None = None,
    extract_rows: int = EXTRACT_ROWS,
) -> FlattenResult:
    """Everything in the source -> flat Parquet table, plus an ordered CSV extract.

    The source is read once; the extract comes from the written table, so the two
    agree even while messages keep arriving.
    """
    flat_path = check_path("flat_path", flat_path)
    if extract_path is not None:
        extract_path = check_path("extract_path", extract_path)
    check_apart(spark, source=_place(source), flat_path=flat_path, extract_path=extract_path)
    written = refresh_table(flatten_messages(read_messages(spark, source)), flat_path)
    if extract_path is not None:
        flat = read_parquet_table(spark, flat_path, FLAT)
        head = ordered_range if extract_rows > HEAD_ROWS else stored_head
        export_csv(head(flat, extract_rows, FLAT.names), extract_path)
    return FlattenResult(written["rows"], table_path(spark, flat_path), extract_path)


def run_flatten_stream(
    spark: SparkSession,
    source: MessageSource,
    flat_path: str,
    checkpoint: str,
    view: str = "flat_messages",
    timeout: float | None = None,
) -> DataFrame:
    """Messages new since the last run -> appended to the flat table; returns the whole table."""
    flat_path = check_path("flat_path", flat_path)
    checkpoint = check_path("checkpoint", checkpoint)
    check_apart(spark, source=_place(source), flat_path=flat_path, checkpoint=checkpoint)
    flat = flatten_messages(read_message_stream(spark, source))
    write_stream(flat, flat_path, checkpoint, name=view, timeout=timeout)
    return stream_result(spark, flat_path, view, FLAT)
