"""Incremental staging of the three sources (G1-G4).

Billing and sessions: keep rows with both ids, newer than ``watermark - lookback``,
and the latest version per id. The top-1-per-id is a ``row_number`` window, which
Catalyst turns into WindowGroupLimit partial (before the shuffle, so a hot id
collapses map-side) + final. Ties are broken on every remaining column so the
chosen row never depends on task scheduling.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import duration_sec, ntz, parse_ts, pg_initcap, row_hash


def _as_ts(value: dt.datetime | Column) -> Column:
    return value if isinstance(value, Column) else ntz(value)


def _latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def lower_bound(watermark: dt.datetime | Column, lookback: dt.timedelta = S.LOOKBACK) -> Column:
    """Strict lower bound for a load: rows must be later than this."""
    return _as_ts(watermark) - F.lit(lookback)


def currency_code(raw: Column, keep_unknown: bool = False) -> Column:
    """Naira spellings become the code. As written, every other value becomes
    it too (both branches of the original CASE); ``keep_unknown`` keeps other
    codes, trimmed and upper-cased (NULL stays NULL)."""
    code = F.upper(F.trim(raw))
    other = code if keep_unknown else F.lit(S.CURRENCY)
    return F.when(code.isin(*S.CURRENCY_ALIASES), F.lit(S.CURRENCY)).otherwise(other)


def _prune(src: DataFrame, watermark: dt.datetime | Column, lookback: dt.timedelta) -> DataFrame:
    """On a landed source (partitioned by event date or month), add the date bound the
    exact timestamp filter implies, so whole partitions are skipped: at planning for a
    literal watermark, before the scan for one that is a scalar subquery."""
    first = F.to_date(lower_bound(watermark, lookback))
    if S.EVENT_DATE in src.columns:
        src = src.where(F.col(S.EVENT_DATE) >= first)
    elif S.EVENT_MONTH in src.columns:
        src = src.where(F.col(S.EVENT_MONTH) >= F.trunc(first, "month"))
    return src.drop(*S.LANDED)


def stage_billings(src: DataFrame, watermark: dt.datetime | Column, run_ts: dt.datetime,
                   lookback: dt.timedelta = S.LOOKBACK, keep_unknown_currency: bool = False) -> DataFrame:
    src = _prune(src, watermark, lookback)
    cand = (src.where(F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull())
               .withColumn("_ts", parse_ts("transaction_date"))
               .where(F.col("_ts") > lower_bound(watermark, lookback)))
    latest = _latest(cand, "transaction_id",
                     [F.col("_ts").desc(), F.col("amount").desc_nulls_last(), F.col("customer_id").asc()])
    return latest.select(
        "transaction_id", "customer_id",
        F.coalesce(F.col("amount"), F.lit(0).cast(S.AMOUNT_T)).alias("amount"),
        currency_code(F.col("currency"), keep_unknown_currency).alias("currency"),
        F.col("_ts").alias("transaction_date"),
        ntz(run_ts).alias("loaded_at"))


def stage_sessions(src: DataFrame, watermark: dt.datetime | Column, run_ts: dt.datetime,
                   lookback: dt.timedelta = S.LOOKBACK) -> DataFrame:
    src = _prune(src, watermark, lookback)
    cand = (src.where(F.col("session_id").isNotNull() & F.col("customer_id").isNotNull())
               .withColumn("_start", parse_ts("start_time"))
               .withColumn("_end", parse_ts("end_time"))
               .where(F.col("_start") > lower_bound(watermark, lookback)))
    latest = _latest(cand, "session_id",
                     [F.col("_start").desc(), F.col("_end").desc_nulls_last(),
                      F.col("data_used_mb").desc_nulls_last(), F.col("customer_id").asc()])
    return latest.select(
        "session_id", "customer_id",
        F.col("_start").alias("start_time"), F.col("_end").alias("end_time"),
        F.coalesce(F.col("data_used_mb"), F.lit(0).cast(S.AMOUNT_T)).alias("data_used_mb"),
        duration_sec("_start", "_end").alias("session_duration_sec"),
        ntz(run_ts).alias("loaded_at"))


def _customer_rows(src: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return src.select(
        "customer_id",
        pg_initcap("name").alias("name"),
        F.lower("email").alias("email"),
        F.coalesce(F.col("country"), F.lit(S.DEFAULT_COUNTRY)).alias("country"),
        parse_ts("created_at").alias("created_at"),
        # attribute hash over the raw, un-normalised values, no separator
        row_hash("customer_id", "name", "email", "country", "created_at").alias("row_hash"),
        ntz(run_ts).alias("loaded_at"),
        F.col("name").alias("_raw_name"), F.col("email").alias("_raw_email"),
        F.col("country").alias("_raw_country"))


def _dedup_customers(rows: DataFrame) -> DataFrame:
    latest = _latest(rows, "customer_id",
                     [F.col("created_at").desc_nulls_last(), F.col("_raw_name").asc_nulls_last(),
                      F.col("_raw_email").asc_nulls_last(), F.col("_raw_country").asc_nulls_last()])
    return latest.drop("_raw_name", "_raw_email", "_raw_country")


def stage_customers_full(src: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _dedup_customers(_customer_rows(src.where(F.col("customer_id").isNotNull()), run_ts))


def stage_customers_incremental(src: DataFrame, watermark: dt.datetime | Column,
                                run_ts: dt.datetime) -> DataFrame:
    """Only customers created strictly after the watermark; no lookback, and a
    NULL created_at never loads."""
    rows = _customer_rows(src.where(F.col("customer_id").isNotNull()), run_ts)
    return _dedup_customers(rows.where(F.col("created_at") > _as_ts(watermark)))


def stage_customers(src: DataFrame, run_date: dt.date, watermark: dt.datetime | Column,
                    run_ts: dt.datetime) -> DataFrame:
    if customer_load_mode(run_date) == "full":
        return stage_customers_full(src, run_ts)
    return stage_customers_incremental(src, watermark, run_ts)


def billing_order() -> list[Column]:
    """Latest-wins order of staged billing rows (same tie-break as staging)."""
    return [F.col("transaction_date").desc(), F.col("amount").desc(), F.col("customer_id").asc()]


def session_order() -> list[Column]:
    return [F.col("start_time").desc(), F.col("end_time").desc_nulls_last(),
            F.col("data_used_mb").desc(), F.col("customer_id").asc()]


def customer_load_mode(run_date: dt.date) -> str:
    return "full" if run_date.weekday() == S.FULL_LOAD_WEEKDAY else "incremental"


def customer_load_mode_col(run_date: Column) -> Column:
    # Spark's weekday() is Monday = 0 like Python's
    return F.when(F.weekday(run_date) == S.FULL_LOAD_WEEKDAY, F.lit("full")).otherwise(F.lit("incremental"))
