"""Table schemas and the layout of the nested application message."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from lendmill.functions.layout import layout_schema

TEXT, INT, DOUBLE, FLAG, TIME = (
    StringType(),
    IntegerType(),
    DoubleType(),
    BooleanType(),
    TimestampType(),
)


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the exchanged tables.
CALLS = table(
    call_id=TEXT,
    call_time=TEXT,
    client_id=TEXT,
    region_code=TEXT,
    campaign_type=TEXT,
    call_status=TEXT,
    client_response=TEXT,
    duration_sec=INT,
    follow_up_required=TEXT,
)
CALLS_KEY = ("call_id",)

APPLICATIONS = table(
    application_id=TEXT,
    event_time=TIME,
    customer_id=TEXT,
    region_code=TEXT,
    product_type=TEXT,
    requested_amount=DOUBLE,
    term_months=INT,
    credit_score=INT,
    risk_level=TEXT,
    decision_status=TEXT,
    approved_amount=DOUBLE,
    channel=TEXT,
    employee_review_flag=FLAG,
    processing_time_sec=INT,
)

FLAT = table(
    application_id=TEXT,
    customer_id=TEXT,
    region=TEXT,
    loan_amount=INT,
    term_months=INT,
    score=INT,
    risk_level=TEXT,
    doc_type=TEXT,
    doc_status=TEXT,
    decision_status=TEXT,
    submitted_at=TEXT,
)

# Message field -> flat column. The list marks the array that is exploded.
MESSAGE_LAYOUT = {
    "application_id": "application_id",
    "customer": {"customer_id": "customer_id", "region": "region"},
    "loan": {"amount": "loan_amount", "term_months": "term_months"},
    "scoring": {"score": "score", "risk_level": "risk_level"},
    "documents": [{"type": "doc_type", "status": "doc_status"}],
    "decision_status": "decision_status",
    "submitted_at": "submitted_at",
}

MESSAGE = layout_schema(MESSAGE_LAYOUT, FLAT)
