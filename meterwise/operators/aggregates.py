"""Per-customer aggregates (A1-A6).

The original joins staging to the customer table and then groups. Here the
group-by runs first (partial + final HashAggregate, so a customer holding a third
of all rows collapses map-side), and the already customer-partitioned result is
semi-joined to the customer keys. Because customer keys are unique this equals
the inner join, without shuffling raw rows by a possibly skewed customer id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import month_start, ntz, session_bucket


def _known(df: DataFrame, customers: DataFrame | None) -> DataFrame:
    """Keep known customers. ``None`` skips the filter, for consumers that join
    to the customer table themselves (the wide table's LEFT JOIN drops the rest)."""
    if customers is None:
        return df
    return df.join(customers.select("customer_id"), "customer_id", "left_semi")


def user_revenue(billings: DataFrame, customers: DataFrame | None, run_ts: dt.datetime) -> DataFrame:
    per = billings.groupBy("customer_id").agg(
        F.sum("amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_transactions"))
    return _known(per, customers).withColumn("last_updated_at", ntz(run_ts))


def user_usage(sessions: DataFrame, customers: DataFrame | None, run_ts: dt.datetime) -> DataFrame:
    per = sessions.groupBy("customer_id").agg(
        F.sum("data_used_mb").alias("total_data_used_mb"),
        F.sum("session_duration_sec").alias("total_session_duration"),
        F.count(F.lit(1)).alias("total_sessions"))
    return _known(per, customers).withColumn("last_updated_at", ntz(run_ts))


def monthly_revenue(billings: DataFrame, customers: DataFrame | None, run_ts: dt.datetime) -> DataFrame:
    per = (billings.where(F.col("transaction_date").isNotNull())
                   .groupBy("customer_id", month_start("transaction_date").alias("month"))
                   .agg(F.sum("amount").alias("total_revenue")))
    return _known(per, customers).withColumn("last_updated_at", ntz(run_ts))


def arpu(monthly: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Revenue per active month. (customer_id, month) is unique in ``monthly``,
    so ``count(month)`` equals ``count(DISTINCT month)`` without the Expand a
    distinct aggregate would add. Division is in double precision."""
    per = monthly.groupBy("customer_id").agg(
        F.sum("total_revenue").alias("_rev"), F.count("month").alias("_months"))
    value = (F.when(F.col("_months") == 0, F.lit(0.0))
              .otherwise(F.col("_rev").cast("double") / F.col("_months").cast("double")))
    return per.select("customer_id", value.alias("arpu"), ntz(run_ts).alias("last_updated_at"))


def session_buckets(sessions: DataFrame, customers: DataFrame | None, run_ts: dt.datetime) -> DataFrame:
    return _known(sessions, customers).select(
        "session_id", "customer_id", session_bucket("session_duration_sec").alias("bucket"),
        ntz(run_ts).alias("last_updated_at"))


def session_distribution(buckets: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return buckets.groupBy("customer_id").agg(
        F.count_if(F.col("bucket") == S.BUCKET_SHORT).alias("short_sessions"),
        F.count_if(F.col("bucket") == S.BUCKET_MEDIUM).alias("medium_sessions"),
        F.count_if(F.col("bucket") == S.BUCKET_LONG).alias("long_sessions"),
    ).withColumn("last_updated_at", ntz(run_ts))


def session_distribution_direct(sessions: DataFrame, customers: DataFrame | None,
                                run_ts: dt.datetime) -> DataFrame:
    """Same counts straight from sessions: aggregate first, then keep known customers."""
    b = session_bucket("session_duration_sec")
    per = sessions.groupBy("customer_id").agg(
        F.count_if(b == S.BUCKET_SHORT).alias("short_sessions"),
        F.count_if(b == S.BUCKET_MEDIUM).alias("medium_sessions"),
        F.count_if(b == S.BUCKET_LONG).alias("long_sessions"))
    return _known(per, customers).withColumn("last_updated_at", ntz(run_ts))


def all_aggregates(billings: DataFrame, sessions: DataFrame, customers: DataFrame | None,
                   run_ts: dt.datetime) -> dict[str, DataFrame]:
    """A1-A6; with ``customers=None`` the per-customer results keep unknown ids."""
    monthly = monthly_revenue(billings, customers, run_ts)
    buckets = session_buckets(sessions, customers, run_ts)
    return {
        "agg_user_revenue": user_revenue(billings, customers, run_ts),
        "agg_user_usage": user_usage(sessions, customers, run_ts),
        "agg_monthly_revenue": monthly,
        "agg_arpu": arpu(monthly, run_ts),
        "session_buckets": buckets,
        "agg_session_distribution": session_distribution_direct(sessions, customers, run_ts),
    }


# ---- signed deltas (incremental maintenance without double counting) ---------

def signed(replaced: DataFrame, winners: DataFrame) -> DataFrame:
    """For the ids in today's delta: the row each id had before (sign -1) and the
    row it has now (sign +1). An id whose winning row did not change cancels out
    exactly; a corrected row moves its contribution; a new row only adds."""
    return (replaced.withColumn("_sign", F.lit(-1))
            .unionByName(winners.withColumn("_sign", F.lit(1))))


def _sgn(c: str) -> F.Column:
    return F.col("_sign") * F.col(c)


def billing_delta(rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return rows.groupBy("customer_id").agg(
        F.sum(_sgn("amount")).cast("decimal(28,2)").alias("total_revenue"),
        F.sum("_sign").cast("bigint").alias("total_transactions"),
    ).withColumn("last_updated_at", ntz(run_ts))


def monthly_delta(rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return rows.groupBy("customer_id", month_start("transaction_date").alias("month")).agg(
        F.sum(_sgn("amount")).cast("decimal(28,2)").alias("total_revenue"),
        F.sum("_sign").cast("bigint").alias("n_rows"),
    ).withColumn("last_updated_at", ntz(run_ts))


def usage_delta(rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    b = session_bucket("session_duration_sec")
    return rows.groupBy("customer_id").agg(
        F.sum(_sgn("data_used_mb")).cast("decimal(28,2)").alias("total_data_used_mb"),
        F.sum(_sgn("session_duration_sec")).cast("decimal(28,6)").alias("total_session_duration"),
        F.sum("_sign").cast("bigint").alias("total_sessions"),
        F.sum(F.when(b == S.BUCKET_SHORT, F.col("_sign")).otherwise(0)).cast("bigint").alias("short_sessions"),
        F.sum(F.when(b == S.BUCKET_MEDIUM, F.col("_sign")).otherwise(0)).cast("bigint").alias("medium_sessions"),
        F.sum(F.when(b == S.BUCKET_LONG, F.col("_sign")).otherwise(0)).cast("bigint").alias("long_sessions"),
    ).withColumn("last_updated_at", ntz(run_ts))
