"""The checked queries: each runs library operators over whole tables of a test
set and has an SQL text that must give the same rows.

Inputs that the tables lack (applications, messages, calls) are derived from them
by the SQL texts below, which both engines run. They set null keys, null amounts,
mixed-case and blank-prefixed statuses by value, so that every rule fires.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from lendmill.functions import bucketize, flag_equals
from lendmill.operators import (
    application_metrics,
    count_by,
    enrich_applications,
    flatten_messages,
    histogram,
    mean_by,
    ordered_range,
    overall_stats,
    pack_messages,
    require_key,
    share_by,
    stamp,
    stored_head,
    synth_messages,
    upsert_by_key,
)
from lendmill.operators.applications import AMOUNT_BOUNDS, AMOUNT_LABELS
from lendmill.plans import (
    LoanBatchResult,
    call_report,
    dashboard_charts,
    read_increments,
    run_call_snapshot,
    run_call_upsert,
    run_dashboard,
    run_flatten_batch,
    run_flatten_incremental,
    run_flatten_stream,
    run_loan_batch,
    run_publish,
)
from lendmill.plans.dashboard import chart_base
from lendmill.schemas import CALLS, FLAT, MESSAGE_LAYOUT, table
from lendmill.sinks import (
    export_csv,
    read_keyed_table,
    refresh_table,
    snapshot_table,
    upsert_keyed_table,
    write_keyed_table,
    write_messages,
)
from lendmill.sources import (
    MessageDir,
    read_csv_dir,
    read_messages,
    read_parquet_table,
    register_table,
)
from lendmill.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def checked(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query together with its SQL, by default under its function name."""

    def register(run: Query) -> Query:
        QUERIES[name or run.__name__] = run
        ORACLE[name or run.__name__] = sql
        return run

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- derived inputs ---------------------------------------------------------

APPLICATIONS_SQL = """
SELECT
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
       ELSE 'app_' || o_orderkey END AS application_id,
  CAST(o_orderdate AS TIMESTAMP) AS event_time,
  'cust_' || o_custkey AS customer_id,
  o_orderpriority AS region_code,
  CASE quarter(o_orderdate) WHEN 1 THEN 'cash_loan' WHEN 2 THEN 'mortgage'
       WHEN 3 THEN 'car_loan' ELSE 'credit_card' END AS product_type,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN NULL
       WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 1000
       WHEN o_orderpriority = '2-HIGH' THEN o_totalprice / 100
       ELSE o_totalprice END AS requested_amount,
  CAST(quarter(o_orderdate) * 12 AS INT) AS term_months,
  CAST(floor(o_totalprice / 1000) AS INT) + 350 AS credit_score,
  CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 250000 THEN 'medium'
       WHEN o_totalprice < 400000 THEN 'high' ELSE 'very_high' END AS risk_level,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
       WHEN o_orderstatus = 'P' THEN 'pending'
       WHEN o_orderstatus = 'O' THEN 'rejected'
       WHEN o_orderpriority = '1-URGENT' THEN 'APPROVED'
       WHEN o_orderpriority = '2-HIGH' THEN 'Approved'
       WHEN o_orderpriority = '3-MEDIUM' THEN ' approved'
       ELSE 'approved' END AS decision_status,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE CAST(0 AS DOUBLE) END AS approved_amount,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'mobile' ELSE 'web' END AS channel,
  o_orderstatus = 'P' AS employee_review_flag,
  CAST(floor(o_totalprice / 100) AS INT) AS processing_time_sec
FROM {orders}
"""

FLAT_SQL = """
SELECT
  'loan_' || o_orderkey AS application_id,
  'cust_' || o_custkey AS customer_id,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS region,
  CAST(floor(o_totalprice) AS INT) AS loan_amount,
  CAST(quarter(o_orderdate) * 12 AS INT) AS term_months,
  CAST(floor(o_totalprice / 1000) AS INT) + 350 AS score,
  CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 250000 THEN 'medium'
       ELSE 'high' END AS risk_level,
  o_orderstatus AS decision_status,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS submitted_at
FROM {orders}
"""

CALLS_SQL = """
SELECT
  'call_' || o_orderkey AS call_id,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS call_time,
  'client_' || o_custkey AS client_id,
  o_orderpriority AS region_code,
  CASE quarter(o_orderdate) WHEN 1 THEN 'loan_offer' WHEN 2 THEN 'insurance'
       WHEN 3 THEN 'mortgage' ELSE 'investment' END AS campaign_type,
  CASE o_orderstatus WHEN 'F' THEN 'answered' WHEN 'O' THEN 'busy' ELSE 'callback' END AS call_status,
  CASE o_orderstatus WHEN 'F' THEN 'interested' ELSE 'declined' END AS client_response,
  CAST(floor(o_totalprice / 1000) AS INT) AS duration_sec,
  CASE o_orderstatus WHEN 'P' THEN 'true' ELSE 'false' END AS follow_up_required
FROM {orders}
"""

APP = f"WITH app AS ({APPLICATIONS_SQL.format(orders='orders')})"

CLEAN = f"""{APP}, clean AS (
SELECT *, '2026-06-16' AS report_date,
  coalesce(lower(decision_status) = 'approved', false) AS is_approved,
  CASE WHEN requested_amount < 1000 THEN 'micro' WHEN requested_amount < 10000 THEN 'small'
       WHEN requested_amount < 50000 THEN 'medium' WHEN requested_amount < 200000 THEN 'large'
       ELSE 'xlarge' END AS amount_bucket
FROM app WHERE application_id IS NOT NULL)
"""

# Documents by status: F one, O two, P none.
FLATTENED = f"""WITH docs(decision, doc_type, doc_status) AS (
  VALUES ('F', 'passport', 'verified'), ('O', 'passport', 'verified'), ('O', 'income', 'pending')),
flat AS (
SELECT application_id, customer_id, region, loan_amount, term_months, score, risk_level,
  doc_type, doc_status, decision_status, submitted_at
FROM ({FLAT_SQL.format(orders='orders')}) LEFT JOIN docs ON decision = decision_status)
"""

REPORT_DATE = "2026-06-16"


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(APPLICATIONS_SQL, orders=load(spark, sf_dir, "orders"))


def clean_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_applications(applications(spark, sf_dir), REPORT_DATE)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CALLS_SQL, orders=load(spark, sf_dir, "orders"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per order, with no, one or two documents."""

    def document(kind: str, status: str) -> F.Column:
        return F.struct(F.lit(kind).alias("type"), F.lit(status).alias("status"))

    passport, income = document("passport", "verified"), document("income", "pending")
    status = F.col("decision_status")
    documents = F.when(status == "F", F.array(passport)).when(
        status == "O", F.array(passport, income)
    )
    layout = MESSAGE_LAYOUT | {"documents": F.coalesce(documents, F.array().cast(documents_type()))}
    flat = spark.sql(FLAT_SQL, orders=load(spark, sf_dir, "orders"))
    return pack_messages(flat, layout)


def documents_type() -> str:
    return "array<struct<type:string,status:string>>"


def order_message_dir(spark: SparkSession, sf_dir: str) -> MessageDir:
    source = MessageDir(scratch_path(spark, "messages"))
    write_messages(order_messages(spark, sf_dir), source)
    return source


# --- tables and SQL by name -------------------------------------------------


@checked("SELECT count(*) AS total_rows FROM orders")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_table(load(spark, sf_dir, "orders"), "order_table")
    return spark.sql("SELECT count(*) AS total_rows FROM order_table")


@checked("SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_head(load(spark, sf_dir, "orders"), 10, ["o_orderkey"])


@checked(
    "SELECT o_orderpriority, count(*) AS cnt FROM orders GROUP BY 1 ORDER BY cnt DESC, o_orderpriority"
)
def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(load(spark, sf_dir, "orders"), "o_orderpriority")


@checked(
    f"""SELECT region_code, call_status, count(*) AS cnt, sum(duration_sec)::BIGINT AS seconds
    FROM ({CALLS_SQL.format(orders='orders')}) GROUP BY ALL"""
)
def calls_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_table(calls(spark, sf_dir), "call_table")
    return spark.sql(
        "SELECT region_code, call_status, count(*) AS cnt, sum(duration_sec) AS seconds "
        "FROM call_table GROUP BY region_code, call_status"
    )


@checked(
    f"SELECT region_code, count(*) AS cnt FROM ({CALLS_SQL.format(orders='orders')}) GROUP BY 1"
)
def call_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return call_report(calls(spark, sf_dir))["calls_by_region"]


# --- filters and projections ------------------------------------------------


@checked(
    f"{APP} SELECT application_id, decision_status, requested_amount FROM app "
    "WHERE application_id IS NOT NULL"
)
def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = require_key(applications(spark, sf_dir), "application_id")
    return kept.select("application_id", "decision_status", "requested_amount")


@checked("SELECT *, '2026-06-16' AS report_date FROM orders")
def report_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(load(spark, sf_dir, "orders"), "report_date", REPORT_DATE)


@checked(
    f"{APP} SELECT application_id, decision_status, "
    "coalesce(lower(decision_status) = 'approved', false) AS is_approved FROM app"
)
def status_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applications(spark, sf_dir).select(
        "application_id",
        "decision_status",
        flag_equals("decision_status", "approved").alias("is_approved"),
    )


@checked(
    f"""{APP} SELECT application_id, requested_amount,
    CASE WHEN requested_amount < 1000 THEN 'micro' WHEN requested_amount < 10000 THEN 'small'
         WHEN requested_amount < 50000 THEN 'medium' WHEN requested_amount < 200000 THEN 'large'
         ELSE 'xlarge' END AS amount_bucket,
    CASE WHEN requested_amount IS NULL THEN 'unknown' WHEN requested_amount < 25000 THEN 'below'
         ELSE 'above' END AS side
    FROM app"""
)
def amount_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applications(spark, sf_dir).select(
        "application_id",
        "requested_amount",
        bucketize("requested_amount", AMOUNT_BOUNDS, AMOUNT_LABELS).alias("amount_bucket"),
        bucketize("requested_amount", [25000], ["below", "above"], "unknown").alias("side"),
    )


@checked(
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events"
)
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


# --- aggregates -------------------------------------------------------------


def mean_sql(value: str) -> str:
    """The mean from sums of whole numbers, so that both engines give the same bits."""
    whole, part = f"trunc({value})::HUGEINT", f"trunc(({value} - trunc({value})) * 2^48)::HUGEINT"
    return f"(sum({whole})::DOUBLE + sum({part})::DOUBLE / 2^48) / nullif(count({value}), 0)"


METRICS_SQL = f"""count(*) AS total,
  CAST(sum(is_approved::INT) AS BIGINT) AS approved,
  {mean_sql('requested_amount')} AS avg_requested,
  {mean_sql('credit_score')} AS avg_score,
  round(sum(is_approved::INT) / count(*) * 100, 2) AS approval_rate"""


@checked(
    f"{CLEAN} SELECT region_code, amount_bucket, decision_status, {METRICS_SQL} "
    "FROM clean GROUP BY ALL"
)
def grouped_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["region_code", "amount_bucket", "decision_status"]
    return application_metrics(clean_applications(spark, sf_dir), keys)


@checked(f"{CLEAN} SELECT region_code, product_type, {METRICS_SQL} FROM clean GROUP BY ALL")
def approval_by_region_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return application_metrics(clean_applications(spark, sf_dir), ["region_code", "product_type"])


STATS_SQL = f"""SELECT count(*) AS total, CAST(sum(is_approved::INT) AS BIGINT) AS approved,
  {mean_sql('credit_score')} AS avg_score FROM clean"""


@checked(f"{CLEAN} {STATS_SQL}")
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall_stats(clean_applications(spark, sf_dir))


@checked(
    "SELECT event_type, count(*) AS cnt, round(count(*) / sum(count(*)) OVER () * 100, 2) AS share "
    "FROM events GROUP BY event_type"
)
def share_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_by(load(spark, sf_dir, "events"), "event_type")


@checked("SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def count_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(load(spark, sf_dir, "events"), "event_type")


@checked(f"SELECT event_type, {mean_sql('value')} AS mean FROM events GROUP BY event_type")
def mean_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_by(load(spark, sf_dir, "events"), "event_type", "value")


@checked(
    "SELECT CAST(floor(value) AS BIGINT) AS bin, count(*) AS cnt FROM events GROUP BY 1",
    name="histogram",
)
def histogram_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(load(spark, sf_dir, "events"), "value", width=1)


@checked(
    "SELECT CAST(floor(o_totalprice / 5000) * 5000 AS BIGINT) AS bin, count(*) AS cnt "
    "FROM orders GROUP BY 1"
)
def histogram_by_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(load(spark, sf_dir, "orders"), "o_totalprice", width=5000)


# --- file sources and sinks -------------------------------------------------


@checked("SELECT * FROM events")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = load(spark, sf_dir, "events"), scratch_path(spark, "events_csv")
    snapshot_table(events, path)
    return read_csv_dir(spark, path, events.schema)


@checked("SELECT * FROM orders")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = load(spark, sf_dir, "orders"), scratch_path(spark, "orders_csv")
    export_csv(orders, path)
    return read_csv_dir(spark, path, orders.schema)


@checked("SELECT * FROM documents")
def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, path = load(spark, sf_dir, "documents"), scratch_path(spark, "documents_csv")
    snapshot_table(documents, path, lossless=True)
    return read_csv_dir(spark, path, documents.schema, lossless=True)


@checked(
    """SELECT o_orderkey AS order_id,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority,
      CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW'
        THEN o_orderkey || ',' || CASE o_orderstatus WHEN 'P' THEN o_custkey || ' ' || o_custkey ELSE o_custkey::VARCHAR END
          || CASE o_orderpriority WHEN '5-LOW' THEN '' ELSE ',' || o_orderpriority END END AS line
    FROM orders"""
)
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders get two numbers in one field, low ones lack their last field."""
    orders, path = load(spark, sf_dir, "orders"), scratch_path(spark, "orders_csv")
    customer = F.when(F.col("o_orderstatus") == "P", F.concat_ws(" ", "o_custkey", "o_custkey"))
    low = F.col("o_orderpriority") == "5-LOW"
    line = F.concat_ws(
        ",", "o_orderkey", customer.otherwise(F.col("o_custkey").cast("string")), F.when(~low, F.col("o_orderpriority"))
    )
    orders.select(line.alias("order_id,customer,priority")).write.option("header", True).option(
        "quote", "\u0000"
    ).option("sep", "\u0001").csv(path)
    schema = table(order_id=LongType(), customer=LongType(), priority=StringType())
    return read_csv_dir(spark, path, schema, rejected="line")


@checked(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
      CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders"""
)
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_csv")
    orders = load(spark, sf_dir, "orders")
    snapshot_table(orders, path)
    inferred = read_csv_dir(spark, path)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "timestamp_ntz"}
    return inferred.select([F.col(c).cast(types.get(c, inferred.schema[c].dataType)) for c in orders.columns])


@checked(f"{FLATTENED} SELECT * FROM flat ORDER BY application_id, doc_type LIMIT 1000")
def csv_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "extract_csv")
    flat = flatten_messages(order_messages(spark, sf_dir))
    export_csv(flat, path, limit=1000, order_by=["application_id", "doc_type"])
    return read_csv_dir(spark, path, FLAT)


@checked(
    """SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
      l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
    LIMIT (SELECT count(*) // 2 FROM lineitem)"""
)
def csv_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier half of all line items, sorted by ranges and written as files in order."""
    lineitem, path = load(spark, sf_dir, "lineitem"), scratch_path(spark, "half_csv")
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    order += [name for name in lineitem.columns if name not in order]
    half = ordered_range(lineitem, lineitem.count() // 2, order)
    export_csv(half, path)
    return read_csv_dir(spark, path, lineitem.schema)


@checked("SELECT * FROM lineitem")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, path = load(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem")
    refresh_table(lineitem, path)
    return read_parquet_table(spark, path, lineitem.schema)


# --- keyed table ------------------------------------------------------------


@checked(
    "SELECT o_orderkey, o_orderstatus, o_orderpriority, "
    "CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE CAST(0 AS DOUBLE) END AS o_totalprice "
    "FROM orders"
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders F and O hold; O and P come in: F is kept, O replaced, P inserted."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    held = orders.where(F.col("o_orderstatus") != "P")
    incoming = orders.where(F.col("o_orderstatus") != "F")
    return upsert_by_key(held, incoming.withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey"])


@checked(
    """WITH latest AS (
      SELECT user_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT c_custkey AS account, c_mktsegment AS state, c_acctbal AS amount FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM latest)
    UNION ALL SELECT user_id, event_type, value FROM latest"""
)
def upsert_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event replaces or adds an account."""
    accounts = load(spark, sf_dir, "customer")
    events = load(spark, sf_dir, "events")
    return upsert_by_key(
        accounts.selectExpr("c_custkey AS account", "c_mktsegment AS state", "c_acctbal AS amount"),
        events.selectExpr(
            "user_id AS account", "event_type AS state", "value AS amount", "ts", "event_id"
        ),
        ["account"],
        order_by=["ts", "event_id"],
    )


@checked(
    """SELECT o_orderkey AS account, CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE 'billed' END AS state,
      CASE WHEN l_orderkey IS NULL THEN 0 ELSE lines END AS lines
    FROM orders FULL JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey"""
)
def upsert_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a keyed table; each order that has line items is replaced by their number."""
    path, keys = scratch_path(spark, "accounts"), ["account"]
    orders = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS account", "o_orderstatus AS state", "CAST(0 AS BIGINT) AS lines"
    )
    billed = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("account")).agg(
        F.lit("billed").alias("state"), F.count(F.lit(1)).alias("lines")
    )
    write_keyed_table(orders, path, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
    upsert_keyed_table(spark, path, billed)
    return read_keyed_table(spark, path)


@checked(
    """SELECT o_orderkey AS account, o_orderpriority AS state, CASE o_orderpriority
      WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 0 END AS version
    FROM orders WHERE o_orderstatus != 'P' OR o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""
)
def upsert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into one keyed table, the later ones over the first one's rows and new ones."""
    orders = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS account", "o_orderpriority AS state", "0 AS version", "o_orderstatus AS status"
    )
    path, keys = scratch_path(spark, "accounts"), ["account"]
    held = orders.where("status != 'P'").withColumn("state", F.coalesce("state", F.lit("none")))
    write_keyed_table(held.drop("status"), path, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for version, priority in enumerate(["1-URGENT", "2-HIGH", "3-MEDIUM"], 1):
        batch = orders.where(F.col("state") == priority).withColumn("version", F.lit(version))
        older = batch.withColumns({"version": F.lit(0), "state": F.lit("older")})
        upsert_keyed_table(spark, path, batch.unionByName(older), order_by=["version"])
    return read_keyed_table(spark, path)


@checked(CALLS_SQL.format(orders="orders"))
def call_upsert_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load without the pending calls, then all calls, then the CSV snapshot."""
    table_calls = calls(spark, sf_dir)
    table_path, snapshot = scratch_path(spark, "calls"), scratch_path(spark, "calls_csv")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run_call_upsert(spark, table_path, table_calls.where("call_status != 'callback'"), buckets=buckets)
    run_call_upsert(spark, table_path, table_calls.where("call_status != 'answered'"))
    run_call_snapshot(spark, table_path, snapshot)
    return read_csv_dir(spark, snapshot, CALLS)


# --- messages ---------------------------------------------------------------

SYNTH_SQL = """to_json({
  'application_id': 'loan_' || id,
  'customer': {'customer_id': 'cust_' || (id % 9999), 'region':
    ['DE-HE', 'DE-BY', 'DE-BE', 'US-CA', 'US-NY', 'RU-MOW', 'RU-SPE', 'FR-IDF'][id % 8 + 1]},
  'loan': {'amount': id % 49000 + 1000, 'term_months': id % 58 + 6},
  'scoring': {'score': id % 650 + 350, 'risk_level': ['low', 'medium', 'high'][id % 3 + 1]},
  'documents': [{'type': 'passport', 'status': ['verified', 'pending', 'rejected'][id % 3 + 1]}],
  'decision_status': ['approved', 'rejected', 'manual_review', 'pending'][id % 4 + 1],
  'submitted_at': '2026-05-01T10:15:11Z'})::VARCHAR AS value"""


@checked(
    f"SELECT {SYNTH_SQL} FROM (SELECT o_orderkey AS id FROM orders)", name="synth_messages"
)
def synth_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic message of every order number."""
    return synth_messages(load(spark, sf_dir, "orders"), "o_orderkey")


@checked(
    f"""SELECT json_merge_patch('{{}}', to_json({{
      'application_id': application_id,
      'customer': {{'customer_id': customer_id, 'region': region}},
      'loan': {{'amount': loan_amount, 'term_months': term_months}},
      'scoring': {{'score': score, 'risk_level': risk_level}},
      'documents': [{{'type': 'statement', 'status': decision_status}}],
      'decision_status': decision_status, 'submitted_at': submitted_at}}))::VARCHAR AS value
    FROM ({FLAT_SQL.format(orders='orders')})"""
)
def publish_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for every order, published and read back."""
    flat = spark.sql(FLAT_SQL, orders=load(spark, sf_dir, "orders")).withColumns(
        {"doc_type": F.lit("statement"), "doc_status": F.col("decision_status")}
    )
    sink = MessageDir(scratch_path(spark, "published"))
    run_publish(spark, sink, flat)
    return read_messages(spark, sink)


@checked(
    f"""SELECT json_merge_patch('{{}}', to_json({{
      'application_id': application_id,
      'submitted_at': submitted_at,
      'customer': {{'customer_id': customer_id, 'region': region, 'risk': risk_level}},
      'loan': {{'amount': loan_amount, 'term_months': term_months, 'score': score}},
      'documents': [{{'type': 'statement', 'status': decision_status}}]}}))::VARCHAR AS value
    FROM ({FLAT_SQL.format(orders='orders')})""",
    name="pack_messages",
)
def pack_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = {
        "application_id": "application_id",
        "submitted_at": "submitted_at",
        "customer": {"customer_id": "customer_id", "region": "region", "risk": "risk_level"},
        "loan": {"amount": "loan_amount", "term_months": "term_months", "score": "score"},
        "documents": [{"type": F.lit("statement"), "status": "decision_status"}],
    }
    return pack_messages(spark.sql(FLAT_SQL, orders=load(spark, sf_dir, "orders")), layout)


@checked(f"{FLATTENED} SELECT * FROM flat")
def flatten_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_messages(order_messages(spark, sf_dir))


@checked(f"{FLATTENED} SELECT region, score FROM flat")
def flatten_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns only: the rest of each message is skipped by the parser."""
    source = order_message_dir(spark, sf_dir)
    return flatten_messages(read_messages(spark, source), columns=["region", "score"])


@checked(
    "SELECT CASE WHEN event_type != 'error' THEN CAST(json_extract(props, '$.k') AS INT) END AS k, "
    "CASE WHEN event_type = 'error' THEN '{' || props END AS raw FROM events"
)
def flatten_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events get a body that does not parse: an all-null row with the raw text."""
    bodies = load(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props"))
        .otherwise(F.col("props"))
        .alias("value")
    )
    return flatten_messages(bodies, {"k": "k"}, table(k=FLAT["score"].dataType), corrupt_column="raw")


ODD_BODY_SQL = """
SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(floor(o_totalprice) AS INT) AS amount,
  '{{"application_id":"loan_' || o_orderkey || '","loan":{{"amount":'
  || CASE WHEN o_orderpriority = '2-HIGH' THEN '"many"' ELSE CAST(CAST(floor(o_totalprice) AS INT) AS STRING) END
  || ',"term_months":12}},"documents":['
  || CASE o_orderstatus WHEN 'F' THEN '{{"type":"passport","status":{{"code":7}}}}'
     WHEN 'O' THEN '{{"type":"passport","status":"verified"}},{{"type":"income","note":"x"}}' ELSE '' END
  || ']' || CASE WHEN o_orderpriority = '5-LOW' THEN ',"channel":"web"}}'
     WHEN o_orderpriority = '1-URGENT' THEN '' ELSE '}}' END AS value
FROM {orders}
"""


@checked(
    f"""WITH odd AS ({ODD_BODY_SQL.format(orders='orders')}),
    docs(status, doc_type, doc_status, rest) AS (VALUES
      ('F', 'passport', NULL, 'documents[].status={{"code":7}}'), ('O', 'passport', 'verified', NULL),
      ('O', 'income', NULL, 'documents[].note="x"')),
    kept AS (SELECT * FROM odd LEFT JOIN docs ON status = o_orderstatus AND o_orderpriority != '1-URGENT')
    SELECT CASE WHEN o_orderpriority != '1-URGENT' THEN 'loan_' || o_orderkey END AS application_id,
      CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN amount END AS loan_amount,
      CASE WHEN o_orderpriority != '1-URGENT' THEN 12 END AS term_months, doc_type, doc_status,
      CASE WHEN o_orderpriority = '1-URGENT' THEN '$=' || value ELSE nullif(concat_ws(';',
        CASE WHEN o_orderpriority = '5-LOW' THEN 'channel="web"' END, rest,
        CASE WHEN o_orderpriority = '2-HIGH' THEN 'loan.amount="many"' END), '') END AS rescued
    FROM kept"""
)
def flatten_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with values of a wrong type, fields without a column, and some cut off."""
    bodies = spark.sql(ODD_BODY_SQL, orders=load(spark, sf_dir, "orders")).select("value")
    columns = ["application_id", "loan_amount", "term_months", "doc_type", "doc_status"]
    flat = flatten_messages(bodies, columns=columns, rescued_column="rescued")
    entries = F.transform(F.map_entries("rescued"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return flat.withColumn("rescued", F.array_join(F.array_sort(entries), ";"))


TEXT_LAYOUT = {
    "id": "doc_id",
    "origin": {"lang": "lang", "source": "source"},
    "content": {"text": "text", "length": "n_chars"},
}
TEXT_TYPES = table(
    doc_id=LongType(), lang=StringType(), source=StringType(), text=StringType(), n_chars=LongType()
)


@checked("SELECT doc_id, lang, source, text, n_chars FROM documents")
def flatten_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through a message directory, with a layout of their own."""
    source = MessageDir(scratch_path(spark, "texts"))
    write_messages(pack_messages(load(spark, sf_dir, "documents"), TEXT_LAYOUT), source)
    return flatten_messages(read_messages(spark, source), TEXT_LAYOUT, TEXT_TYPES)


@checked(f"{FLATTENED} SELECT * FROM flat")
def flatten_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = order_message_dir(spark, sf_dir), scratch_path(spark, "flat")
    run_flatten_batch(spark, source, path, scratch_path(spark, "extract"))
    return read_parquet_table(spark, path, FLAT)


@checked(f"{FLATTENED} SELECT * FROM flat ORDER BY ALL NULLS FIRST LIMIT 1000")
def flatten_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered extract that the batch job leaves beside the flat table."""
    source, extract = order_message_dir(spark, sf_dir), scratch_path(spark, "extract")
    run_flatten_batch(spark, source, scratch_path(spark, "flat"), extract)
    return read_csv_dir(spark, extract, FLAT)


@checked(f"{FLATTENED} SELECT * FROM flat")
def flatten_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = order_message_dir(spark, sf_dir), scratch_path(spark, "flat")
    run_flatten_stream(spark, source, path, scratch_path(spark, "checkpoint"))
    return spark.sql("SELECT * FROM flat_messages")


@checked(f"{FLATTENED} SELECT * FROM flat")
def flatten_stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with one checkpoint: the second adds only what came in between."""
    bodies = order_messages(spark, sf_dir)
    undocumented = F.col("value").contains('"documents":[]')
    source = MessageDir(scratch_path(spark, "messages"))
    path, checkpoint = scratch_path(spark, "flat"), scratch_path(spark, "checkpoint")
    write_messages(bodies.where(undocumented), source)
    run_flatten_stream(spark, source, path, checkpoint)
    write_messages(bodies.where(~undocumented), source)
    return run_flatten_stream(spark, source, path, checkpoint)


@checked(f"{FLATTENED} SELECT * FROM flat")
def flatten_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batch runs over one growing source, the second cut off and made again."""
    bodies = order_messages(spark, sf_dir)
    source, path = MessageDir(scratch_path(spark, "messages")), scratch_path(spark, "flat")

    def cut_off(messages: DataFrame) -> DataFrame:
        flat = flatten_messages(messages)
        lost = F.raise_error(F.lit("run cut off")).cast("string")
        return flat.withColumn("region", F.when(F.col("doc_type").isNotNull(), lost).otherwise(F.col("region")))

    for part in ('"documents":[]', '"decision_status":"F"', '"decision_status":"O"'):
        write_messages(bodies.where(F.col("value").contains(part)), source)
        try:
            run_flatten_incremental(spark, source, path, cut_off)
        except Exception as error:
            if "run cut off" not in str(error):
                raise
            run_flatten_incremental(spark, source, path)
    return read_increments(spark, path)


# --- jobs -------------------------------------------------------------------


def loan_batch(spark: SparkSession, sf_dir: str) -> LoanBatchResult:
    source, output = scratch_path(spark, "applications"), scratch_path(spark, "loans")
    snapshot_table(applications(spark, sf_dir), source)
    return run_loan_batch(spark, source, output, REPORT_DATE)


@checked(f"{CLEAN} SELECT * FROM clean")
def loan_batch_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = read_parquet_table(spark, loan_batch(spark, sf_dir).clean_path)
    return clean.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@checked(
    f"{CLEAN} SELECT region_code, product_type, decision_status, {METRICS_SQL} FROM clean GROUP BY ALL"
)
def loan_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet_table(spark, loan_batch(spark, sf_dir).aggregated_path)


@checked(f"{CLEAN} SELECT *, (SELECT count(*) FROM orders) AS loaded FROM ({STATS_SQL})")
def loan_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures observed while the job wrote."""
    run = loan_batch(spark, sf_dir)
    return spark.range(1).select(
        F.lit(run.total).cast("bigint").alias("total"),
        F.lit(run.approved).cast("bigint").alias("approved"),
        F.lit(run.avg_score).alias("avg_score"),
        F.lit(run.loaded).cast("bigint").alias("loaded"),
    )


def order_charts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dashboard_charts(chart_base(flatten_messages(order_messages(spark, sf_dir))))


@checked(
    f"{FLATTENED} SELECT risk_level, count(*) AS cnt, "
    "round(count(*) / sum(count(*)) OVER () * 100, 2) AS share FROM flat GROUP BY risk_level"
)
def chart_risk_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_charts(spark, sf_dir)["risk_share"]


@checked(f"{FLATTENED} SELECT decision_status, count(*) AS cnt FROM flat GROUP BY decision_status")
def chart_decision_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_charts(spark, sf_dir)["decision_count"]


@checked(
    f"{FLATTENED} SELECT region, sum(loan_amount) / count(loan_amount) AS mean_amount FROM flat GROUP BY region"
)
def chart_region_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_charts(spark, sf_dir)["region_mean"]


@checked(f"{FLATTENED} SELECT score AS bin, count(*) AS cnt FROM flat GROUP BY score")
def chart_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_charts(spark, sf_dir)["score_histogram"]


@checked(
    f"""{FLATTENED}
    SELECT 'risk_share' AS chart, risk_level AS label, CAST(count(*) AS DOUBLE) AS figure
      FROM flat GROUP BY risk_level
    UNION ALL SELECT 'decision_count', decision_status, count(*) FROM flat GROUP BY decision_status
    UNION ALL SELECT 'region_mean', region, round(avg(loan_amount), 4) FROM flat GROUP BY region
    UNION ALL SELECT 'score_histogram', CAST(score AS VARCHAR), count(*) FROM flat GROUP BY score"""
)
def dashboard_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to flat table to chart tables, all written; the four in one result."""
    source, flat = order_message_dir(spark, sf_dir), scratch_path(spark, "flat")
    run_flatten_batch(spark, source, flat)
    paths = run_dashboard(spark, flat, scratch_path(spark, "dashboard"))
    labels = {
        "risk_share": ("risk_level", "cnt"),
        "decision_count": ("decision_status", "cnt"),
        "region_mean": ("region", "mean_amount"),
        "score_histogram": ("bin", "cnt"),
    }
    result = None
    for chart, (label, figure) in labels.items():
        rows = read_parquet_table(spark, paths[chart]).select(
            F.lit(chart).alias("chart"),
            F.col(label).cast("string").alias("label"),
            F.round(F.col(figure).cast("double"), 4).alias("figure"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result
