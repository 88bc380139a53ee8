"""Bounded samples of labelled rows for the models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def sample(rows: DataFrame, label: str, key: str, each: int, counted: DataFrame | None = None) -> DataFrame:
    """At most ``each`` rows of every label, those whose keys hash lowest.

    The labels are counted first, in ``counted`` or ``rows``, so that only rows whose hash
    is below a share of all hashes are sorted: about twice as many as asked for, however
    large the table is. Labels are few, as the models have weights or thresholds for each.
    """
    numbers = (rows if counted is None else counted).groupBy(F.col(label).alias("_label")).agg(
        F.count(F.lit(1)).alias("_number")
    )
    order = Window.partitionBy(label).orderBy("_hash", key)
    share = F.col("_hash").cast("double") / float(1 << 64) + 0.5
    return (
        rows.withColumn("_hash", F.xxhash64(key))
        .join(F.broadcast(numbers), F.col(label) == F.col("_label"))
        .where(share * F.col("_number") <= 2 * each + 100)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= each)
        .drop("_hash", "_rank", "_label", "_number")
    )


def fold(key: Column, folds: int = 3) -> Column:
    """The CRC-32 of the key as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(folds))
