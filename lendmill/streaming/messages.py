"""Message streams that process what is there and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lendmill.sources.files import read_parquet_table, register_table
from lendmill.sources.messages import MessageSource, Topic, message_body


def read_message_stream(spark: SparkSession, source: MessageSource) -> DataFrame:
    """The source as a stream, from its beginning; later runs go on from the checkpoint."""
    if isinstance(source, Topic):
        stream = spark.readStream.format(source.connector).options(**source.read_options())
        return message_body(stream.load())
    stream = spark.readStream.format("text").options(**source.stream_options())
    return message_body(stream.load(source.path))


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    timeout: float | None = None,
) -> StreamingQuery:
    """Append all input present now to a Parquet table, exactly once, and stop.

    The checkpoint and the table's own file log let a run that was cut off go on
    where it stopped, and a run without new input add nothing. Raises
    ``TimeoutError`` if the run takes more than ``timeout`` seconds.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name is not None:
        writer = writer.queryName(name)
    query = writer.start(path)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream not finished after {timeout} s; a new run goes on from {checkpoint}")
    return query


def stream_result(
    spark: SparkSession, path: str, view: str, schema: StructType | None = None
) -> DataFrame:
    """What a stream has written, also under a name for ``spark.sql``."""
    return register_table(read_parquet_table(spark, path, schema), view)
