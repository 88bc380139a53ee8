"""File tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lendmill.versions import Versions

# Quotes are doubled inside quoted fields (RFC 4180), on both sides.
CSV_DIALECT = {"header": "true", "escape": '"'}


# What stands for null in a lossless file; there a text's own backslashes are doubled.
LOSSLESS_NULL = "\\N"


def read_csv_dir(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    multi_line: bool = False,
    null_value: str = "",
    lossless: bool = False,
    rejected: str | None = None,
    fail_fast: bool = False,
) -> DataFrame:
    """All CSV files of a directory, each with a header line.

    With a schema the header of every file must name its columns in order; a file
    with swapped columns raises instead of being misread. Without one the types
    are inferred, which costs a pass over all data.

    A value that does not parse is null, and so is a missing one. ``rejected`` names a further
    column with the text of each line that has such a value, too few or too many, null for
    good lines; it needs a schema, and selecting it parses every line whole. ``fail_fast``
    raises at such a value or line instead.

    ``lossless`` reads what ``export_csv`` wrote so: texts keep their line breaks, empty text
    and null stay apart, and files still split. For files of others, ``multi_line`` allows
    line breaks inside quoted fields; a file is then read by one task, so keep the files
    small. ``null_value`` is the text that stands for null; with the default an
    empty text is null too.
    """
    reader = spark.read.options(**CSV_DIALECT, multiLine=multi_line)
    reader = reader.option("nullValue", LOSSLESS_NULL if lossless else null_value)
    if fail_fast:
        reader = reader.option("mode", "FAILFAST")
    if rejected is not None:
        if schema is None or fail_fast:
            raise ValueError("rejected lines need a schema and must not fail")
        reader = reader.option("columnNameOfCorruptRecord", rejected)
        schema = StructType(list(schema)).add(rejected, StringType())
    if schema is None:
        rows = reader.option("inferSchema", True).csv(path)
    else:
        rows = reader.schema(schema).option("enforceSchema", False).csv(path)
    if rejected is not None:
        # Spark converts only the values that a plan needs, and finds bad ones only there. So
        # this column needs all others, to no effect.
        parity = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema if f.name != rejected]) % 2
        never = F.when(parity == 2, F.lit(""))
        rows = rows.withColumn(rejected, F.coalesce(F.col(f"`{rejected}`"), never))
    if lossless:
        texts = [f.name for f in rows.schema if isinstance(f.dataType, StringType) and f.name != rejected]
        rows = rows.withColumns({name: unescaped(F.col(f"`{name}`")) for name in texts})
    return rows


def escaped(text: Column) -> Column:
    """The text on one line: backslashes doubled, line breaks as a backslash and a letter."""
    for sign, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(sign), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given. Between doubled backslashes a single one starts a
    line break; one that starts nothing stays."""

    def line_breaks(part: Column) -> Column:
        part = F.replace(part, F.lit("\\n"), F.lit("\n"))
        return F.replace(part, F.lit("\\r"), F.lit("\r"))

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), line_breaks), "\\")
    return F.when(F.contains(text, F.lit("\\")), whole).otherwise(text)


def table_path(spark: SparkSession, root: str) -> str:
    """Where the last version of a refreshed table lies; ``root`` itself for a plain one."""
    version = Versions(spark, root).current()
    return root if version is None else f"{root.rstrip('/')}/{version.parts[0]}"


def read_parquet_table(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """A Parquet table, of a refreshed one the last version.

    With a schema, an empty or missing footer set is no error.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(spark, path))


def register_table(df: DataFrame, name: str) -> DataFrame:
    """Give a table a name for ``spark.sql`` and return it by that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
