"""Message sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.sources.messages import MessageSource, Topic


def write_messages(messages: DataFrame, sink: MessageSource) -> None:
    """Append the column ``value``; no key and no deduplication, so a second run adds again.

    A text line cannot hold a null body, so a directory gets none; flattening
    drops such bodies anyway. A body with a line break raises there, as it would be read
    back as several; JSON writers escape line breaks.
    """
    bodies = messages.select("value")
    if isinstance(sink, Topic):
        writer = bodies.write.format(sink.connector).options(**sink.write_options())
        writer.mode("append").save()
    else:
        present = bodies.where(F.col("value").isNotNull())
        broken = F.raise_error(F.lit("a message body has a line break"))
        text = F.col("value").cast("string")
        breaks = F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
        present = present.select(F.when(breaks, broken).otherwise(F.col("value")).alias("value"))
        present.write.mode("append").option("lineSep", "\n").text(sink.path)
