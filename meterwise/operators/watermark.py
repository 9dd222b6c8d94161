"""Watermarks per source (W1-W6) and rows that arrive too late (E3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import ntz, parse_ts
from meterwise.operators.staging import lower_bound
from meterwise.operators.upsert import INSERT_ONLY, upsert

SOURCES = (S.SRC_BILLING, S.SRC_SESSIONS, S.SRC_CUSTOMERS)
# source -> (staging table, its time column)
STAGED_TIME = {
    S.SRC_BILLING: ("stg_billings", "transaction_date"),
    S.SRC_SESSIONS: ("stg_sessions", "start_time"),
    S.SRC_CUSTOMERS: ("stg_customers", "created_at"),
}


def seed_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(s, S.INITIAL_WATERMARK, S.INITIAL_WATERMARK) for s in SOURCES], S.PIPELINE_WATERMARKS)


def seed(spark: SparkSession, existing: DataFrame) -> DataFrame:
    """Add the 1970 watermark for sources that have none; keep existing ones."""
    # the seed is a three-row in-memory relation: counting it needs no materialization
    return upsert(existing, seed_rows(spark), ["source_table"], INSERT_ONLY, materialized=True, unique=True)


def value(watermarks: DataFrame, source: str) -> Column:
    """The watermark of one source as a scalar subquery (no driver round trip)."""
    row = watermarks.where(F.col("source_table") == source).select("last_processed")
    return row.scalar()


def current(watermarks: DataFrame) -> dict[str, dt.datetime]:
    """The (at most three) watermark values on the driver, for literal filters."""
    got = {r.source_table: r.last_processed for r in watermarks.collect()}
    return {s: got.get(s, S.INITIAL_WATERMARK) for s in SOURCES}


def advance(watermarks: DataFrame, staged: dict[str, DataFrame], run_ts: dt.datetime) -> DataFrame:
    """Move each source's watermark to the latest staged time. An empty staging
    table keeps the old value, and a watermark never moves back."""
    parts = []
    for source, df in staged.items():
        col = STAGED_TIME[source][1]
        parts.append(df.agg(F.max(col).alias("_new")).select(
            F.lit(source).alias("source_table"), "_new", F.lit(True).alias("_ran")))
    new = parts[0]
    for p in parts[1:]:
        new = new.unionByName(p)
    j = watermarks.join(new, "source_table", "full_outer")
    return j.select(
        "source_table",
        F.greatest(F.col("last_processed"), F.col("_new")).alias("last_processed"),
        F.when(F.col("_ran"), ntz(run_ts)).otherwise(F.col("updated_at")).alias("updated_at"),
    ).where(F.col("last_processed").isNotNull())


def late_rows(src: DataFrame, key: str, ts_col: str, watermark: dt.datetime,
              loaded_keys: DataFrame, lookback: dt.timedelta = S.LOOKBACK) -> DataFrame:
    """Rows too old for the lookback window whose key was never loaded: the
    original drops them without a trace. ``loaded_keys`` is the persisted
    key-only list of everything ever staged."""
    ts = parse_ts(ts_col)
    old = src.where(F.col(key).isNotNull() & ts.isNotNull() & (ts <= lower_bound(watermark, lookback)))
    return old.join(loaded_keys.select(key), key, "left_anti")
