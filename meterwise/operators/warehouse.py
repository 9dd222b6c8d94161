"""One wide row per customer (H1-H2) and the reports on it (H4-H5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import ntz

CONTENT_COLUMNS = [f.name for f in S.USER_ANALYTICS.fields
                   if f.name not in ("customer_id", "last_updated_at")]  # row_hash too: it covers raw values


def _per_session(total: Column, sessions: Column) -> Column:
    # ANSI mode raises on x/0, so guard before dividing
    return F.when(sessions == 0, F.lit(0.0)).otherwise(total.cast("double") / sessions.cast("double"))


def user_analytics(customers: DataFrame, revenue: DataFrame, usage: DataFrame,
                   arpu: DataFrame, distribution: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Customers LEFT JOIN the four customer-keyed aggregates.

    Every input is keyed (and, after its own aggregation, hash-partitioned) on
    customer_id, so the four joins share one partitioning; Catalyst broadcasts
    any side that its statistics prove small."""
    r = revenue.select("customer_id", "total_revenue", "total_transactions")
    u = usage.select("customer_id", "total_data_used_mb", "total_session_duration", "total_sessions")
    a = arpu.select("customer_id", "arpu")
    d = distribution.select("customer_id", "short_sessions", "medium_sessions", "long_sessions")
    j = (customers.join(r, "customer_id", "left").join(u, "customer_id", "left")
                  .join(a, "customer_id", "left").join(d, "customer_id", "left"))
    sessions = F.coalesce(F.col("total_sessions"), F.lit(0).cast("bigint"))
    zero_l = F.lit(0).cast("bigint")
    return j.select(
        F.col("customer_id"),
        F.col("name").alias("customer_name"),
        F.col("email"),
        F.col("country"),
        F.to_date("created_at").alias("customer_since"),
        F.coalesce(F.col("total_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("total_transactions"), zero_l).alias("total_transactions"),
        F.coalesce(F.col("total_data_used_mb").cast("double"), F.lit(0.0)).alias("total_data_used_mb"),
        sessions.alias("total_sessions"),
        _per_session(F.col("total_session_duration"), sessions).alias("avg_session_duration_sec"),
        F.coalesce(F.col("arpu"), F.lit(0.0)).alias("arpu"),
        F.coalesce(F.col("short_sessions"), zero_l).alias("short_sessions"),
        F.coalesce(F.col("medium_sessions"), zero_l).alias("medium_sessions"),
        F.coalesce(F.col("long_sessions"), zero_l).alias("long_sessions"),
        _per_session(F.col("total_data_used_mb"), sessions).alias("avg_data_per_session_mb"),
        F.col("row_hash"),
        ntz(run_ts).alias("last_updated_at"))


def churn_candidates(wide: DataFrame, as_of: dt.date) -> DataFrame:
    """Few sessions, little revenue, and a customer for at least 30 days."""
    cutoff = F.lit(as_of) - F.lit(S.CHURN_MIN_TENURE)
    return wide.where((F.col("total_sessions") < S.CHURN_MAX_SESSIONS)
                      & (F.col("total_revenue") < S.CHURN_MAX_REVENUE)
                      & (F.col("customer_since") <= F.to_date(cutoff)))


def inactive_customers(wide: DataFrame) -> DataFrame:
    """Customers kept in the wide table with no billing and no sessions."""
    return wide.where((F.col("total_transactions") == 0) & (F.col("total_sessions") == 0))
