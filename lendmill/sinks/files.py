"""Parquet and CSV sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lendmill.operators.rows import ordered_head, ordered_range
from lendmill.sources.files import CSV_DIALECT, LOSSLESS_NULL, escaped
from lendmill.versions import Versions

# Blanks and microseconds survive, unlike with Spark's CSV writing defaults.
CSV_WRITE = CSV_DIALECT | {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

#: An extract of at most so many rows is one file.
HEAD_ROWS = 100_000


def write_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    *,
    shuffle: bool = True,
    metrics: Sequence[Column] = (),
) -> dict[str, object]:
    """Overwrite a Parquet table; returns the number of rows and any further metrics.

    The figures are taken from the rows as they are written, in the writing
    stage itself: no second pass, and a task that is repeated counts once.

    Left alone, each task writes a file. ``files`` sets their number: with a
    shuffle, which suits a small result of a wide stage, or without one by giving
    each task several input splits, which suits a large narrow stage.
    """
    if files is not None:
        df = df.repartition(files) if shuffle else df.coalesce(files)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.mode("overwrite").parquet(path)
    return seen.get


def refresh_table(
    df: DataFrame,
    root: str,
    files: int | None = None,
    *,
    shuffle: bool = True,
    metrics: Sequence[Column] = (),
    check: Callable[[], None] | None = None,
) -> dict[str, object]:
    """The same as a new version of the table at ``root``: until all rows lie there, and if the
    run fails, readers get the version before, whole.

    ``check`` is called before the new version takes effect and may raise.
    ``read_parquet_table`` finds the last version; other readers take its directory
    from ``table_path``.
    """
    versions = Versions(df.sparkSession, root)
    last = versions.current()
    number = last.number + 1 if last else 1
    directory = versions.fresh(number)
    written = write_parquet(df, f"{versions.root}/{directory}", files, shuffle=shuffle, metrics=metrics)
    if check is not None:
        check()
    versions.commit(number, {"parts": [directory]})
    return written


def export_csv(
    df: DataFrame,
    path: str,
    limit: int | None = None,
    order_by: Sequence[str] | None = None,
    null_value: str = "",
    *,
    lossless: bool = False,
) -> None:
    """Overwrite a CSV directory with header; ``limit`` keeps the first rows by ``order_by``.

    Up to ``HEAD_ROWS`` rows are merged by one task into one file; more are sorted in
    parallel, into several files in order.

    ``lossless`` writes every row on one line, for a reader with the same flag: line
    breaks and backslashes in texts are escaped by a backslash, and null is ``\\N``. Without it, a
    ``null_value`` that occurs in no text, given to the reader as well, keeps null and
    empty text apart.
    """
    if limit is not None and limit > HEAD_ROWS:
        df = ordered_range(df, limit, order_by or df.columns)
    elif limit is not None:
        df = ordered_head(df, limit, order_by or df.columns)
    elif order_by:
        df = df.orderBy(*order_by)
    if lossless:
        texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
        df = df.withColumns({name: escaped(F.col(f"`{name}`")) for name in texts})
        null_value = LOSSLESS_NULL
    df.write.mode("overwrite").options(**CSV_WRITE, nullValue=null_value).csv(path)


def snapshot_table(df: DataFrame, path: str, null_value: str = "", *, lossless: bool = False) -> None:
    """The whole table as CSV, written in parallel."""
    export_csv(df, path, null_value=null_value, lossless=lossless)
