"""Table schemas, keys and the fixed values the results depend on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with
# the behaviour being rebuilt (labels, defaults, thresholds, windows).
# ---------------------------------------------------------------------------
SRC_BILLING = "src_billing_transactions"
SRC_SESSIONS = "src_network_sessions"
SRC_CUSTOMERS = "src_customers"

# quarantine labels drop the "src_" prefix used by the counts
Q_BILLING = "billing_transactions"
Q_SESSIONS = "network_sessions"
Q_CUSTOMERS = "customers"

NULL_IDENTIFIER = "null_identifier"
NULL_TRANSACTION_DATE = "null_transaction_date"
NULL_CREATED_AT = "null_created_at"
NULL_START_OR_END_TIME = "null_start_or_end_time"
DUPLICATE_IDENTIFIER = "duplicate_identifier"
ORPHANED_CUSTOMER_ID = "orphaned_customer_id"
INVALID_AMOUNT = "invalid_amount"
UNPARSEABLE_DATE = "unparseable_date"
INVALID_SESSION_TIMES = "invalid_session_times"
UNPARSEABLE_TIMESTAMP = "unparseable_timestamp"
MALFORMED_RECORD = "malformed_record"  # extra check type: a source line that does not fit the schema
MALFORMED_COLUMN = "_malformed"  # holds such a line
NULL_CUSTOMER_ID = "null_customer_id"  # extra check type (only counted-out in the original)

DEFAULT_COUNTRY = "Nigeria"
CURRENCY = "NGN"
CURRENCY_ALIASES = ("NGN", "NAIRA")
SHORT_SESSION_SEC = 60
MEDIUM_SESSION_SEC = 300
BUCKET_SHORT, BUCKET_MEDIUM, BUCKET_LONG = "short", "medium", "long"
LOOKBACK = dt.timedelta(days=3)
INITIAL_WATERMARK = dt.datetime(1970, 1, 1)
FULL_LOAD_WEEKDAY = 6  # Sunday, Monday = 0
CHURN_MAX_SESSIONS = 5
CHURN_MAX_REVENUE = 1000
CHURN_MIN_TENURE = dt.timedelta(days=30)
# ---------------------------------------------------------------------------

AMOUNT_T = T.DecimalType(18, 2)
DURATION_T = T.DecimalType(18, 6)
TS_T = T.TimestampNTZType()


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


L, S, D, DT = T.LongType(), T.StringType(), T.DateType(), T.DoubleType()

SRC_CUSTOMERS_SCHEMA = _s(
    ("customer_id", L, True), ("name", S, True), ("email", S, True),
    ("country", S, True), ("created_at", S, True))
SRC_BILLING_SCHEMA = _s(
    ("transaction_id", L, True), ("customer_id", L, True), ("amount", AMOUNT_T, True),
    ("currency", S, True), ("transaction_date", S, True))
SRC_SESSIONS_SCHEMA = _s(
    ("session_id", L, True), ("customer_id", L, True), ("start_time", S, True),
    ("end_time", S, True), ("data_used_mb", AMOUNT_T, True))

STG_BILLINGS = _s(
    ("transaction_id", L, False), ("customer_id", L, False), ("amount", AMOUNT_T, False),
    ("currency", S, True), ("transaction_date", TS_T, False), ("loaded_at", TS_T, False))
STG_SESSIONS = _s(
    ("session_id", L, False), ("customer_id", L, False), ("start_time", TS_T, False),
    ("end_time", TS_T, True), ("data_used_mb", AMOUNT_T, False),
    ("session_duration_sec", DURATION_T, False), ("loaded_at", TS_T, False))
STG_CUSTOMERS = _s(
    ("customer_id", L, False), ("name", S, True), ("email", S, True), ("country", S, True),
    ("created_at", TS_T, True), ("row_hash", S, False), ("loaded_at", TS_T, False))
SESSION_BUCKETS = _s(
    ("session_id", L, False), ("customer_id", L, False), ("bucket", S, False),
    ("last_updated_at", TS_T, False))
AGG_USER_REVENUE = _s(
    ("customer_id", L, False), ("total_revenue", T.DecimalType(28, 2), False),
    ("total_transactions", L, False), ("last_updated_at", TS_T, False))
AGG_USER_USAGE = _s(
    ("customer_id", L, False), ("total_data_used_mb", T.DecimalType(28, 2), False),
    ("total_session_duration", T.DecimalType(28, 6), False), ("total_sessions", L, False),
    ("last_updated_at", TS_T, False))
AGG_MONTHLY_REVENUE = _s(
    ("customer_id", L, False), ("month", D, False),
    ("total_revenue", T.DecimalType(28, 2), False), ("last_updated_at", TS_T, False))
AGG_ARPU = _s(("customer_id", L, False), ("arpu", DT, False), ("last_updated_at", TS_T, False))
AGG_SESSION_DISTRIBUTION = _s(
    ("customer_id", L, False), ("short_sessions", L, False), ("medium_sessions", L, False),
    ("long_sessions", L, False), ("last_updated_at", TS_T, False))
PIPELINE_WATERMARKS = _s(
    ("source_table", S, False), ("last_processed", TS_T, False), ("updated_at", TS_T, False))
QUARANTINE_RECORDS = _s(
    ("record", S, False), ("source", S, False), ("check_type", S, False),
    ("record_hash", S, False), ("detected_at", TS_T, True))
USER_ANALYTICS = _s(
    ("customer_id", L, True), ("customer_name", S, True), ("email", S, True),
    ("country", S, True), ("customer_since", D, True), ("total_revenue", DT, True),
    ("total_transactions", L, True), ("total_data_used_mb", DT, True),
    ("total_sessions", L, True), ("avg_session_duration_sec", DT, True), ("arpu", DT, True),
    ("short_sessions", L, True), ("medium_sessions", L, True), ("long_sessions", L, True),
    ("avg_data_per_session_mb", DT, True), ("row_hash", S, True), ("last_updated_at", TS_T, True))
# running totals over all history per customer id, known or not (recompute mode)
ACC_BILLING = _s(
    ("customer_id", L, False), ("total_revenue", T.DecimalType(28, 2), False),
    ("total_transactions", L, False), ("last_updated_at", TS_T, False))
ACC_MONTHLY = _s(
    ("customer_id", L, False), ("month", D, False), ("total_revenue", T.DecimalType(28, 2), False),
    ("n_rows", L, False), ("last_updated_at", TS_T, False))
ACC_USAGE = _s(
    ("customer_id", L, False), ("total_data_used_mb", T.DecimalType(28, 2), False),
    ("total_session_duration", T.DecimalType(28, 6), False), ("total_sessions", L, False),
    ("short_sessions", L, False), ("medium_sessions", L, False), ("long_sessions", L, False),
    ("last_updated_at", TS_T, False))
DQ_REPORT = _s(("source_table", S, False), ("check_type", S, False), ("faulty_rows", L, False))
DQ_HISTORY = _s(("source_table", S, False), ("check_type", S, False), ("faulty_rows", L, False),
                ("run_date", D, False))
LATE_BILLINGS = _s(*[(f.name, f.dataType, True) for f in SRC_BILLING_SCHEMA.fields], ("run_date", D, False))

LATE_SESSIONS = _s(*[(f.name, f.dataType, True) for f in SRC_SESSIONS_SCHEMA.fields], ("run_date", D, False))

# partitions of landed sources: the day a row arrived, the day (or month) it is about
ARRIVED, EVENT_DATE, EVENT_MONTH = "arrived_on", "event_date", "event_month"
LANDED = (ARRIVED, EVENT_DATE, EVENT_MONTH)
IDS = _s(("id", L, False), ("n", L, False), ("event_date", D, True), ("run_date", D, False))
ORPHAN_COUNTS = _s(("source_table", S, False), ("customer_id", L, False), ("n", L, False))
ARRIVALS = _s(("source_table", S, False), (ARRIVED, D, False))
RUN_LOG = _s(("run_id", S, False), ("step", S, False), ("tables", T.ArrayType(S), True), ("emptied", T.ArrayType(S), True),
             ("logged_at", TS_T, True))

# name -> (schema, key columns, transient?)  transient tables are emptied after a run
TABLES: dict[str, tuple[T.StructType, tuple[str, ...], bool]] = {
    "stg_billings": (STG_BILLINGS, ("transaction_id",), True),
    "stg_sessions": (STG_SESSIONS, ("session_id",), True),
    "stg_customers": (STG_CUSTOMERS, ("customer_id",), True),
    "session_buckets": (SESSION_BUCKETS, ("session_id",), True),
    "agg_user_revenue": (AGG_USER_REVENUE, ("customer_id",), False),
    "agg_user_usage": (AGG_USER_USAGE, ("customer_id",), False),
    "agg_monthly_revenue": (AGG_MONTHLY_REVENUE, ("customer_id", "month"), False),
    "agg_arpu": (AGG_ARPU, ("customer_id",), False),
    "agg_session_distribution": (AGG_SESSION_DISTRIBUTION, ("customer_id",), False),
    "pipeline_watermarks": (PIPELINE_WATERMARKS, ("source_table",), False),
    "quarantine_records": (QUARANTINE_RECORDS, ("record_hash",), False),
    "stg_user_analytics": (USER_ANALYTICS, (), False),
    "dw_user_analytics": (USER_ANALYTICS, ("customer_id",), False),
    # persistent history the recompute mode needs (not in the original design)
    "dim_customers": (STG_CUSTOMERS, ("customer_id",), False),
    "hist_billings": (STG_BILLINGS, ("transaction_id",), False),
    "hist_sessions": (STG_SESSIONS, ("session_id",), False),
    "acc_billing": (ACC_BILLING, ("customer_id",), False),
    "acc_monthly": (ACC_MONTHLY, ("customer_id", "month"), False),
    "acc_usage": (ACC_USAGE, ("customer_id",), False),
    # append-only run reports
    "dq_report": (DQ_HISTORY, (), False),
    "late_billings": (LATE_BILLINGS, (), False),
    "late_sessions": (LATE_SESSIONS, (), False),
    # what incremental quality counts start from
    "ids_billing": (IDS, (), False),
    "ids_sessions": (IDS, (), False),
    "ids_customers": (IDS, (), False),
    "orphan_counts": (ORPHAN_COUNTS, ("source_table", "customer_id"), False),
    "arrivals": (ARRIVALS, ("source_table",), False),
    "run_log": (RUN_LOG, (), False),
}

TRANSIENT = tuple(n for n, (_, _, t) in TABLES.items() if t)

# table -> its partition column (a text column besides the schema's, if it is not one of them)
MONTH = "month_part"
PARTITIONS = {"hist_billings": MONTH, "hist_sessions": MONTH, "quarantine_records": "detected_on",
              "dq_report": "run_date", "late_billings": "run_date", "late_sessions": "run_date",
              "ids_billing": "run_date", "ids_sessions": "run_date", "ids_customers": "run_date"}
# tables of customer grain are bucketed and sorted by the customer, id counts by the id
BUCKETED = {t: "customer_id" for t in ("agg_user_revenue", "agg_user_usage", "agg_monthly_revenue", "agg_arpu",
                                       "agg_session_distribution", "dim_customers", "acc_billing", "acc_monthly",
                                       "acc_usage", "dw_user_analytics")}
BUCKETED |= {t: "id" for t in ("ids_billing", "ids_sessions", "ids_customers")}

# The column defaults of the tables as originally declared.
NOW = "localtimestamp()"
DEFAULTS: dict[str, dict[str, str]] = {
    "stg_billings": {"amount": "0", "loaded_at": NOW},
    "stg_sessions": {"data_used_mb": "0", "session_duration_sec": "0", "loaded_at": NOW},
    "stg_customers": {"loaded_at": NOW},
    "session_buckets": {"last_updated_at": NOW},
    "agg_user_revenue": {"total_revenue": "0", "total_transactions": "0", "last_updated_at": NOW},
    "agg_user_usage": {"total_data_used_mb": "0", "total_session_duration": "0", "total_sessions": "0", "last_updated_at": NOW},
    "agg_monthly_revenue": {"total_revenue": "0", "last_updated_at": NOW},
    "agg_arpu": {"arpu": "0", "last_updated_at": NOW},
    "agg_session_distribution": {"short_sessions": "0", "medium_sessions": "0", "long_sessions": "0", "last_updated_at": NOW},
    "pipeline_watermarks": {"updated_at": NOW},
    "quarantine_records": {"detected_at": NOW},
    "run_log": {"logged_at": NOW},  # this store's own
}
