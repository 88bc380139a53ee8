"""A table with one row per key, of which a batch rewrites only what it touches.

Rows lie in a fixed number of parts by a hash of their key, one Parquet file each. An upsert
writes the parts of the batch's keys anew and commits a version that takes all other parts
from the version before as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendmill.operators.upsert import free_name, upsert_by_key
from lendmill.versions import Version, Versions


def write_keyed_table(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> Version:
    """Replace the whole table by ``df``, which holds each key once.

    Take so many ``buckets`` that a part has the size of a good file; a batch rewrites at
    least one part for each key that falls into another.
    """
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"keys {missing} are not columns of the table")
    versions = Versions(df.sparkSession, root)
    last = versions.current()
    number = last.number + 1 if last else 1
    content = {"keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue()}
    parts = _write(df, versions, number, keys, buckets, list(range(buckets)))
    return versions.commit(number, content | {"parts": parts})


def read_keyed_table(spark: SparkSession, root: str) -> DataFrame:
    """The last version committed."""
    version = _existing(spark, root)
    return _read(spark, root, version, list(version.content["parts"].values()))


def upsert_keyed_table(
    spark: SparkSession, root: str, batch: DataFrame, order_by: Sequence[str] = ()
) -> Version:
    """Put a batch into the table, by the rules of ``upsert_by_key``.

    Only the parts that hold keys of the batch are read, merged and written, so the cost
    follows the batch; the rest stays byte for byte. An empty batch changes nothing. The
    numbers of the touched parts come to the driver, at most ``buckets`` of them.
    """
    version = _existing(spark, root)
    keys, buckets, parts = (version.content[name] for name in ("keys", "buckets", "parts"))
    schema = StructType.fromJson(version.content["schema"])
    typed = [F.col(k).cast(schema[k].dataType).alias(k) for k in keys]
    found = batch.select(typed).select(_bucket(keys, buckets).alias("bucket")).distinct().collect()
    touched = sorted(row["bucket"] for row in found)
    if not touched:
        return version
    held = _read(spark, root, version, [parts[str(t)] for t in touched if str(t) in parts])
    merged = upsert_by_key(held, batch, keys, order_by)
    versions, number = Versions(spark, root), version.number + 1
    written = _write(merged, versions, number, keys, buckets, touched)
    return versions.commit(number, version.content | {"parts": parts | written})


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _existing(spark: SparkSession, root: str) -> Version:
    version = Versions(spark, root).current()
    if version is None:
        raise ValueError(f"no keyed table at {root}")
    return version


def _read(spark: SparkSession, root: str, version: Version, parts: Sequence[str]) -> DataFrame:
    schema = StructType.fromJson(version.content["schema"])
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{part}" for part in parts])


def _write(
    df: DataFrame,
    versions: Versions,
    number: int,
    keys: Sequence[str],
    buckets: int,
    touched: Sequence[int],
) -> dict[str, str]:
    """The rows as one file a part, sorted by key, one task for each; where each part lies."""
    name, directory = free_name("bucket", df.columns), versions.fresh(number)
    rows = df.withColumn(name, _bucket(keys, buckets))
    place = F.array_position(F.lit(list(touched)), F.col(name)) - 1
    if len(touched) == buckets:
        place = F.col(name)
    rows = rows.repartitionById(len(touched), place.cast("int")).sortWithinPartitions(name, *keys)
    rows.write.partitionBy(name).parquet(f"{versions.root}/{directory}")
    written = [child for child in versions.children(directory) if child.startswith(f"{name}=")]
    return {child.split("=")[1]: f"{directory}/{child}" for child in written}
