"""Time the jobs at the published volumes, or at a multiple of them.

``python bench_volumes.py [FACTOR]`` prints one JSON line per job: 100,000 messages,
450,000 loan applications (the orders of sf0.1 three times) and 200,000 calls, each
times FACTOR.
"""

from __future__ import annotations

import json
import sys
import time

import bench
from lendmill.catalogue import REPORT_DATE, applications
from lendmill.operators import synth_applications
from lendmill.plans import (
    run_call_snapshot,
    run_call_upsert,
    run_dashboard,
    run_flatten_batch,
    run_flatten_stream,
    run_loan_batch,
    run_publish,
)
from lendmill.sinks import snapshot_table
from lendmill.sources import MessageDir
from lendmill.workspace import scratch_path
from pyspark.sql import functions as F


def main(factor: int) -> None:
    spark = bench.session()
    messages, loans, calls = 100_000 * factor, 3 * factor, 200_000 * factor

    def place(label):
        return scratch_path(spark, label)

    copies = F.explode(F.sequence(F.lit(1), F.lit(loans)))
    loan_rows = applications(spark, bench.SF_DIR).withColumn("copy", copies).drop("copy")
    loan_csv = place("loans_csv")
    snapshot_table(loan_rows.repartition(8), loan_csv)
    call_rows = synth_applications(spark.range(calls)).selectExpr(
        "application_id AS call_id", "submitted_at AS call_time", "customer_id AS client_id",
        "region AS region_code", "doc_type AS campaign_type", "decision_status AS call_status",
        "risk_level AS client_response", "term_months AS duration_sec", "'true' AS follow_up_required",
    )

    def run(name, rows, job, runs=3):
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        seconds = sorted(times[1:])[runs // 2]
        line = {"job": name, "rows": rows, "sec": round(seconds, 3), "rows_per_sec": int(rows / seconds)}
        print(json.dumps(line), flush=True)

    topic, flat, table = MessageDir(place("topic")), place("flat"), place("calls")
    run("publish", messages, lambda: run_publish(spark, MessageDir(place("topic")), messages))
    run_publish(spark, topic, messages)
    run("flatten_batch", messages, lambda: run_flatten_batch(spark, topic, flat))
    run("flatten_batch_extract", messages, lambda: run_flatten_batch(spark, topic, flat, place("csv")))
    run(
        "flatten_stream",
        messages,
        lambda: run_flatten_stream(spark, topic, place("flat"), place("checkpoint")),
    )
    run("dashboard", messages, lambda: run_dashboard(spark, flat, place("charts")))
    run(
        "loan_batch",
        150_000 * loans,
        lambda: run_loan_batch(spark, loan_csv, place("out"), REPORT_DATE),
    )
    run_call_upsert(spark, table, call_rows)
    run("call_load", calls, lambda: run_call_upsert(spark, place("calls"), call_rows))
    run(
        "call_upsert",
        calls,
        lambda: run_call_upsert(spark, table, call_rows.where("call_status = 'approved'")),
    )
    run("call_snapshot", calls, lambda: run_call_snapshot(spark, table, place("csv")))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 1)
