"""Loan applications: CSV directory -> clean table, grouped metrics, global figures."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from lendmill.operators import application_metrics, enrich_applications
from lendmill.operators.metrics import METRIC_KEYS, STAT_MEANS, figures
from lendmill.plans.paths import check_apart, check_path
from lendmill.schemas import APPLICATIONS
from lendmill.sinks import refresh_table
from lendmill.sources import read_csv_dir, read_parquet_table, table_path


REJECTED = "_rejected_line"


@dataclass(frozen=True)
class LoanBatchResult:
    loaded: int
    total: int
    approved: int | None
    avg_score: float | None
    clean_path: str
    aggregated_path: str
    malformed: int = 0
    rejected_path: str | None = None


class MalformedInput(ValueError):
    """More lines than allowed did not parse; no table has been changed."""


def run_loan_batch(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    report_date: str,
    *,
    keys: Sequence[str] = METRIC_KEYS,
    clean_files: int | None = None,
    aggregated_files: int | None = None,
    schemes: Collection[str] | None = None,
    most_malformed: int | None = None,
) -> LoanBatchResult:
    """Full refresh of ``output_path``/clean and ``output_path``/aggregated, each as a new
    version that takes effect when it is complete; the result names their directories.

    The CSV is read once: counts and global figures are observed while the clean
    rows are written. The metrics are then grouped from the written Parquet, of
    which only the key and value columns are read. ``clean_files`` bounds the
    number of clean files without a shuffle, so the job stays one narrow stage.

    Lines that do not parse are counted in the same pass; their good values go on, the others
    are null. Their texts are written to ``output_path``/rejected, by a second pass that
    is made only if there are any. More than ``most_malformed`` raise ``MalformedInput``, and both
    tables stay as they are.
    """
    source = check_path("input_path", input_path, schemes)
    output = check_path("output_path", output_path, schemes)
    if not report_date:
        raise ValueError("report_date is missing")
    clean_path, aggregated_path = f"{output}/clean", f"{output}/aggregated"
    rejected_path = f"{output}/rejected"
    check_apart(
        spark, input_path=source, clean_path=clean_path, aggregated_path=aggregated_path,
        rejected_path=rejected_path,
    )

    loaded = Observation()
    lines = read_csv_dir(spark, source, APPLICATIONS, rejected=REJECTED)
    applications = lines.observe(
        loaded, F.count(F.lit(1)).alias("rows"), F.count(REJECTED).alias("malformed")
    )
    clean = enrich_applications(applications.drop(REJECTED), report_date)

    def check() -> None:
        malformed = loaded.get["malformed"]
        if most_malformed is not None and malformed > most_malformed:
            raise MalformedInput(f"{malformed} lines of {source} do not parse, allowed are {most_malformed}")

    stats = refresh_table(
        clean, clean_path, clean_files, shuffle=False, metrics=figures(STAT_MEANS), check=check
    )
    malformed = loaded.get["malformed"]
    if malformed:
        bad = lines.where(F.col(REJECTED).isNotNull())
        refresh_table(bad.select(F.col(REJECTED).alias("line")), rejected_path)

    written = read_parquet_table(spark, clean_path, clean.schema)
    refresh_table(application_metrics(written, keys), aggregated_path, aggregated_files)
    return LoanBatchResult(
        loaded=loaded.get["rows"],
        total=stats["total"],
        approved=stats["approved"],
        avg_score=stats["avg_score"],
        clean_path=table_path(spark, clean_path),
        aggregated_path=table_path(spark, aggregated_path),
        malformed=malformed,
        rejected_path=table_path(spark, rejected_path) if malformed else None,
    )
