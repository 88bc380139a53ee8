"""Cleaning and enrichment of loan applications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions import bucketize, flag_equals
from lendmill.operators.rows import require_key

# Amount classes and the status that counts as approved.
AMOUNT_BOUNDS = (1000, 10000, 50000, 200000)
AMOUNT_LABELS = ("micro", "small", "medium", "large", "xlarge")
APPROVED = "approved"


def enrich_applications(
    df: DataFrame,
    report_date: str,
    *,
    bounds: Sequence[float] = AMOUNT_BOUNDS,
    labels: Sequence[str] = AMOUNT_LABELS,
    approved: str = APPROVED,
    null_label: str | None = None,
) -> DataFrame:
    """Drop applications without an id; add run date, approval flag and amount class.

    Narrow: one filter and one projection over the scan.
    """
    return require_key(df, "application_id").withColumns(
        {
            "report_date": F.lit(report_date),
            "is_approved": flag_equals("decision_status", approved),
            "amount_bucket": bucketize("requested_amount", bounds, labels, null_label),
        }
    )
