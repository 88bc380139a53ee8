"""Tables cut off from their lineage, in the folder that all executors share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.workspace import scratch_path


#: Lets go of the shuffle files of a query when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back; nothing else of it is kept on disk."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def documents(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others of any name cannot clash."""
    return docs.select(*(F.col(f"`{n}`") for n in names))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where the session was started without it
    on the path; on a cluster the package is shipped with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, known)])
