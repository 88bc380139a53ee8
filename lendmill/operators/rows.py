"""Row filters, constant columns and ordered previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

NO_ORDER = "a limited extract needs an order, or its rows may vary"


def require_key(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are all set."""
    if not columns:
        raise ValueError("name at least one key column")
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def stamp(df: DataFrame, name: str, value: object) -> DataFrame:
    """Add one constant column."""
    return df.withColumn(name, F.lit(value))


def ordered_head(df: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``rows`` rows in the given order: a distributed top-n, no full sort."""
    if not order_by:
        raise ValueError(NO_ORDER)
    return df.orderBy(*order_by).limit(rows)


def ordered_range(
    table: DataFrame, rows: int, order_by: Sequence[str], *, ranges: int | None = None
) -> DataFrame:
    """The first ``rows`` rows in the given order, sorted in parallel, for large parts of a table.

    The order columns alone are dealt to ranges, as many as there are shuffle partitions; one
    line for each range comes to the driver, with its number of rows and its ends. So it is
    known which ranges belong to the result whole, and only the one that the last
    row falls into needs a top-n. The result is then sorted by ranges, so it is written as
    several files that are in order one after the other. The table is read three times, so it
    should be a stored one; rows equal in all order columns take any order.
    """
    if not order_by:
        raise ValueError(NO_ORDER)
    if rows <= 0:
        return table.limit(0)
    if ranges is None:
        ranges = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*order_by)
    dealt = table.select(*order_by).repartitionByRange(ranges, *order_by)
    ends = dealt.groupBy(F.spark_partition_id().alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    before = 0
    for end in sorted(ends.collect(), key=lambda r: r["range"]):
        if before + end["rows"] >= rows:
            break
        before += end["rows"]
    else:
        return table.orderBy(*order_by)

    def literal(row: Row) -> Column:
        return F.struct(*[F.lit(row[c]).cast(table.schema[c].dataType).alias(c) for c in order_by])

    low, high = literal(end["low"]), literal(end["high"])
    # The bound of the leading column reaches the scan; nulls sort first and stay in.
    leading = F.col(order_by[0])
    within = leading.isNull() | (leading <= F.lit(end["high"][order_by[0]]))
    near = table if end["high"][order_by[0]] is None else table.where(within)
    last = near.where((key >= low) & (key <= high))
    last = ordered_head(last, rows - before, order_by)
    return near.where(key < low).unionByName(last).orderBy(*order_by)


def stored_head(table: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """``ordered_head`` of a stored columnar table, reading the other columns only where needed.

    A first pass over the leading order column alone finds its largest value among
    the first rows. That bound is pushed into the scan of the second pass, which
    skips all row groups and pages that lie beyond it.
    """
    if not order_by:
        raise ValueError(NO_ORDER)
    leading = order_by[0]
    first = ordered_head(table.select(leading), rows, [leading])
    bound = first.agg(F.max(leading)).scalar()
    # Nulls sort first and stay in; with nothing but nulls the bound is null too.
    within = F.col(leading).isNull() | (F.col(leading) <= bound)
    return ordered_head(table.where(within), rows, order_by)
