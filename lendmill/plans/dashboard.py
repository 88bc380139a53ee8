"""The four charts over the flat application table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.operators import share_by
from lendmill.plans.paths import check_apart, check_path
from lendmill.schemas import FLAT
from lendmill.sinks import refresh_table
from lendmill.sources import read_parquet_table, table_path

# Charts and the column that each counts by.
CHARTS = {
    "risk_share": "risk_level",
    "decision_count": "decision_status",
    "region_mean": "region",
    "score_histogram": "bin",
}


def chart_base(flat: DataFrame, score_width: int = 1) -> DataFrame:
    """All the charts need, in one pass: a row for each chart and value of its column.

    The rows are grouped by each column alone, as grouping sets, so what a task hands
    to the shuffle is bounded by the values of the columns, not by their combinations. Scores are
    binned by ``score_width`` before; every chart sees all rows.
    """
    score = F.col("score").cast("long")
    binned = flat.select(
        "risk_level", "decision_status", "region", "loan_amount",
        (score - F.pmod(score, F.lit(score_width).cast("long"))).alias("bin"),
    )
    keys = list(CHARTS.values())
    sums = binned.groupingSets([[key] for key in keys], *keys).agg(
        F.grouping_id().alias("grouped"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("loan_amount").alias("amount"),
        F.count("loan_amount").alias("amounts"),
    )
    # The grouping number has a bit for each column that is not grouped by, the first highest.
    every = 2 ** len(keys) - 1
    numbers = {every - 2 ** (len(keys) - 1 - i): chart for i, chart in enumerate(CHARTS)}
    chart = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return sums.select(F.element_at(chart, F.col("grouped").cast("int")).alias("chart"), *keys, "rows", "amount", "amounts")


def dashboard_charts(base: DataFrame) -> dict[str, DataFrame]:
    """Share per risk level, rows per decision, mean amount per region, rows per score.

    Rows are flat rows: an application with two documents counts twice.
    """

    def of(chart: str) -> DataFrame:
        return base.where(F.col("chart") == chart)

    # A region without any amount has the sum null, which makes the mean null.
    mean = of("region_mean").select("region", F.try_divide("amount", "amounts").alias("mean_amount"))
    decisions = of("decision_count").select("decision_status", F.col("rows").alias("cnt"))
    return {
        "risk_share": share_by(of("risk_share"), "risk_level", weight="rows"),
        "decision_count": decisions.orderBy(F.desc("cnt"), "decision_status"),
        "region_mean": mean,
        "score_histogram": of("score_histogram").select("bin", F.col("rows").alias("cnt")),
    }


def run_dashboard(
    spark: SparkSession, flat_path: str, output_path: str, score_width: int = 1
) -> dict[str, str]:
    """Write each chart's figures as Parquet below ``output_path``.

    The flat table is scanned once, five columns wide; the charts are computed
    from the small table of sums that this leaves behind.
    """
    flat_path = check_path("flat_path", flat_path)
    output_path = check_path("output_path", output_path)
    base_path = f"{output_path}/base"
    base = chart_base(read_parquet_table(spark, flat_path, FLAT), score_width)
    written = {name: f"{output_path}/{name}" for name in dashboard_charts(base)}
    check_apart(spark, flat_path=flat_path, base_path=base_path, **written)
    refresh_table(base, base_path)
    grouped = read_parquet_table(spark, base_path, base.schema)
    for name, chart in dashboard_charts(grouped).items():
        refresh_table(chart, written[name])
    return {name: table_path(spark, path) for name, path in written.items()}
