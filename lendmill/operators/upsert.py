"""Insert-or-replace by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_by_key(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``target`` with the rows of ``batch`` put in, replacing rows of the same key.

    ``target`` holds each key once. With ``order_by`` the batch may repeat a key:
    the row with the largest order columns wins, then the one with the largest
    remaining columns. Without it a repeated key raises. Order columns that
    ``target`` lacks are dropped.

    A null key is a key like any other.

    The batch is read again for its keys only, so it must not change meanwhile: write
    rows from a topic to a table first. With ``order_by`` it is reduced per key on the
    map side before it is shuffled, so a hot key costs one row per task; without, only
    its keys are shuffled, to be counted. The target stays
    where it is while the batch keys are below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it is shuffled by key.
    A keyed table (``upsert_keyed_table``) reads only the part of it that the batch touches.
    """
    if missing := [k for k in keys if k not in target.columns]:
        raise ValueError(f"keys {missing} are not columns of the target")
    incoming = _newest(target, batch, keys, order_by) if order_by else _checked(target, batch, keys)

    other = {k: free_name(k, target.columns) for k in keys}
    touched = batch.select(*[F.col(k).alias(other[k]) for k in keys]).distinct()
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(other[k])) for k in keys])
    return target.join(touched, same_key, "left_anti").unionByName(incoming)


def _newest(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The largest row of each key."""
    row = free_name("row", keys)
    wanted = [c for c in target.columns if c not in keys and c not in order_by]
    newest = batch.groupBy(*keys).agg(F.max(F.struct(*order_by, *wanted)).alias(row))
    return newest.select(
        *[
            (F.col(f.name) if f.name in keys else F.col(row)[f.name]).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def _checked(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows as they are; only their keys are counted, and a repeated one raises.

    The check adds no row. It is part of the new rows, not of the join, which Spark takes
    out where the target is empty.
    """
    copies = free_name("copies", keys)
    repeated = (
        batch.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(copies))
        .where(F.col(copies) > 1)
        .where(_raise_if(F.col(copies) > 1, "key repeated in the batch", keys))
    )
    rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])
    none = repeated.select(
        *[
            (F.col(f.name) if f.name in keys else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    return rows.unionByName(none)


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name`` with underscores before it, one at least, until no column has it."""
    lower = {t.lower() for t in taken}
    name = "_" + name
    while name.lower() in lower:
        name = "_" + name
    return name


def _raise_if(test: Column, message: str, keys: Sequence[str]) -> Column:
    """True for every row that does not raise."""
    text = F.concat(F.lit(f"{message}: "), F.to_json(F.struct(*keys)))
    return F.when(test, F.raise_error(text)).otherwise(True).cast("boolean")
