"""The keyed call table: upsert, report queries, CSV snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendmill.operators import count_by, stored_head, upsert_by_key
from lendmill.plans.paths import check_apart, check_path
from lendmill.schemas import CALLS, CALLS_KEY
from lendmill.sinks import read_keyed_table, snapshot_table, upsert_keyed_table, write_keyed_table
from lendmill.versions import Versions

PREVIEW_ROWS = 10
#: Parts of a call table, for some tens of GB.
CALL_BUCKETS = 64


def run_call_upsert(
    spark: SparkSession,
    table_path: str,
    batch: DataFrame,
    order_by: Sequence[str] = (),
    buckets: int = CALL_BUCKETS,
) -> int:
    """Put a batch into the call table; returns its number of rows then.

    The first batch makes the table, with ``buckets`` parts. Later ones write only the parts
    that hold keys of the batch.
    """
    return run_keyed_upsert(
        spark, table_path, batch, keys=CALLS_KEY, schema=CALLS, buckets=buckets, order_by=order_by
    )


def run_keyed_upsert(
    spark: SparkSession,
    table_path: str,
    batch: DataFrame,
    *,
    keys: Sequence[str],
    schema: StructType,
    buckets: int,
    order_by: Sequence[str] = (),
) -> int:
    """The same for a table of any schema and key."""
    table_path = check_path("table_path", table_path)
    if Versions(spark, table_path).current() is None:
        first = upsert_by_key(spark.createDataFrame([], schema), batch, keys, order_by)
        write_keyed_table(first, table_path, keys, buckets)
    else:
        upsert_keyed_table(spark, table_path, batch, order_by)
    return read_keyed_table(spark, table_path).count()


def call_report(calls: DataFrame) -> dict[str, DataFrame]:
    """Number of calls, first calls by key, calls per region."""
    return {
        "total_rows": calls.agg(F.count(F.lit(1)).alias("total_rows")),
        "preview": stored_head(calls, PREVIEW_ROWS, CALLS_KEY),
        "calls_by_region": count_by(calls, "region_code"),
    }


def run_call_snapshot(
    spark: SparkSession, table_path: str, csv_path: str, *, lossless: bool = False
) -> None:
    """The whole call table as CSV."""
    table_path = check_path("table_path", table_path)
    csv_path = check_path("csv_path", csv_path)
    check_apart(spark, table_path=table_path, csv_path=csv_path)
    snapshot_table(read_keyed_table(spark, table_path), csv_path, lossless=lossless)
