from lendmill.plans.call_table import call_report, run_call_snapshot, run_call_upsert, run_keyed_upsert
from lendmill.plans.dashboard import dashboard_charts, run_dashboard
from lendmill.plans.increments import read_increments, run_flatten_incremental
from lendmill.plans.loan_batch import LoanBatchResult, run_loan_batch
from lendmill.plans.message_flow import (
    FlattenResult,
    run_flatten_batch,
    run_flatten_stream,
    run_publish,
)

__all__ = [
    "FlattenResult",
    "LoanBatchResult",
    "call_report",
    "dashboard_charts",
    "read_increments",
    "run_call_snapshot",
    "run_call_upsert",
    "run_dashboard",
    "run_flatten_batch",
    "run_flatten_incremental",
    "run_flatten_stream",
    "run_keyed_upsert",
    "run_loan_batch",
    "run_publish",
]
