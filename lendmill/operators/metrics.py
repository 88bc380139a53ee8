"""Grouped and global figures.

Every aggregate here combines on the map side, so a key that holds most of the
rows costs one partial row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lendmill.functions import exact_mean, percent

# Keys and names of the application figures.
METRIC_KEYS = ("region_code", "product_type", "decision_status")
METRIC_MEANS = {"avg_requested": "requested_amount", "avg_score": "credit_score"}
STAT_MEANS = {"avg_score": "credit_score"}


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def count_by(df: DataFrame, *keys: str, name: str = "cnt", weight: str | None = None) -> DataFrame:
    """Rows per key, largest first; equal counts in key order.

    ``weight`` counts rows that were already grouped.
    """
    counts = df.groupBy(*keys).agg(_rows(weight).alias(name))
    return counts.orderBy(F.desc(name), *keys)


def share_by(df: DataFrame, key: str, name: str = "cnt", weight: str | None = None) -> DataFrame:
    """Rows per key and their share of all rows in percent.

    The total is a scalar subquery over the same counts: its plan reuses their
    shuffle, and no task sees more than one key range.
    """
    counts = df.groupBy(key).agg(_rows(weight).alias(name))
    total = counts.agg(F.sum(name)).scalar()
    return counts.withColumn("share", percent(name, total))


def mean_by(df: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    """Mean of a value per key, the same for any order of rows; nulls do not count."""
    return df.groupBy(key).agg(exact_mean(value).alias(name))


def histogram(
    df: DataFrame,
    value: str,
    width: int | None = None,
    name: str = "cnt",
    weight: str | None = None,
) -> DataFrame:
    """Rows per value, or per bin of ``width`` labelled by its lower edge.

    With ``width``, NaN and infinity are in no bin: they count under null, as null does.
    """
    edge = F.col(value)
    if width is not None and isinstance(df.schema[value].dataType, IntegralType):
        edge = edge.cast("long") - F.pmod(edge.cast("long"), F.lit(width).cast("long"))
    elif width is not None:
        finite = ~F.isnan(edge) & (F.abs(edge) < float("inf"))
        edge = F.when(finite, F.floor(edge / width) * width)
    return df.groupBy(edge.alias("bin")).agg(_rows(weight).alias(name))


def figures(means: Mapping[str, str], flag: str = "is_approved") -> list[Column]:
    """Rows, rows with the flag and means, to select, to group or to observe during a write.

    ``means`` maps a result name to the column averaged; the order of rows does not matter.
    Over no rows all but the first are null.
    """
    return [
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col(flag).cast("long")).alias("approved"),
        *[exact_mean(value).alias(name) for name, value in means.items()],
    ]


def application_metrics(
    df: DataFrame,
    keys: Sequence[str] = METRIC_KEYS,
    means: Mapping[str, str] = METRIC_MEANS,
) -> DataFrame:
    """Applications, approvals, means and approval rate in percent per key.

    With the decision among the keys the rate is 0 or 100 in every group; leave
    it out for a rate that says something.
    """
    grouped = df.groupBy(*keys).agg(*figures(means))
    return grouped.withColumn("approval_rate", percent("approved", "total"))


def overall_stats(df: DataFrame, means: Mapping[str, str] = STAT_MEANS) -> DataFrame:
    """One row with the global figures; on empty input 0 and nulls."""
    return df.agg(*figures(means))
