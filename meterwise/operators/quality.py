"""Freshness gate (F1-F3) and the 15 data-quality counts (Q1-Q16).

Output rows are ``(source_table, check_type, faulty_rows)``; zero counts stay.
Predicate counts share one aggregate per source (one scan each). Duplicate
keys and orphans are counted from pre-aggregated keys, so neither a hot key
nor a hot customer funnels raw rows into one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import parse_ts


class StaleSourceError(RuntimeError):
    pass


# ---- freshness -------------------------------------------------------------

def fresh_rows(src: DataFrame, ts_col: str, run_date: dt.date) -> DataFrame:
    """Rows whose timestamp text falls on ``run_date`` (unparseable text never does).
    On a landed source only that day's (or month's) partition is read."""
    if S.EVENT_DATE in src.columns:
        src = src.where(F.col(S.EVENT_DATE) == F.lit(run_date))
    elif S.EVENT_MONTH in src.columns:
        src = src.where(F.col(S.EVENT_MONTH) == F.lit(run_date.replace(day=1)))
    return src.where(F.to_date(parse_ts(ts_col)) == F.lit(run_date))


def freshness_count(src: DataFrame, source_table: str, ts_col: str, run_date: dt.date) -> DataFrame:
    return fresh_rows(src, ts_col, run_date).agg(F.count(F.lit(1)).alias("fresh_rows")).select(
        F.lit(source_table).alias("source_table"), F.lit(run_date).alias("run_date"), "fresh_rows")


def check_freshness(src: DataFrame, source_table: str, ts_col: str, run_date: dt.date) -> None:
    """Raise when the source has no row on ``run_date``; stops at the first row found."""
    if fresh_rows(src, ts_col, run_date).limit(1).isEmpty():
        raise StaleSourceError(f"No {source_table} data found for run date {run_date}")


def source_date_range(src: DataFrame, ts_col: str) -> DataFrame:
    ts = parse_ts(ts_col)
    return src.agg(F.min(ts).alias(f"min_{ts_col}"), F.max(ts).alias(f"max_{ts_col}"))


# ---- counts ----------------------------------------------------------------

def _report(src_label: str, df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One aggregate computing every predicate count of a source, unpivoted."""
    wide = df.agg(*[F.count_if(pred).alias(name) for name, pred in checks.items()])
    return (wide.withColumn("source_table", F.lit(src_label))
                .unpivot("source_table", list(checks), "check_type", "faulty_rows"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once, with their row count; the NULL key is one group.
    Partial aggregation collapses a hot key map-side."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphan_ids(activity: DataFrame, customers: DataFrame) -> DataFrame:
    """Non-NULL customer ids no customer row has, with their row count. Rows are
    pre-aggregated per id before the anti join, so a hot id is one row."""
    per = (activity.where(F.col("customer_id").isNotNull())
                   .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")))
    return per.join(customers.select("customer_id"), "customer_id", "left_anti")


KEYS = {S.SRC_BILLING: "transaction_id", S.SRC_SESSIONS: "session_id", S.SRC_CUSTOMERS: "customer_id"}


@dataclass
class FaultKeys:
    """The key sets both the counts and the quarantine need, computed once."""
    repeated: dict[str, DataFrame]   # source label -> (key, n), n > 1
    orphans: dict[str, DataFrame]    # activity source label -> (customer_id, n)


def fault_keys(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
               keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
               run_all: Callable[..., dict] | None = None) -> FaultKeys:
    """``keep`` may materialize each set (e.g. write it to the run's store);
    ``run_all`` may run those independent materializations concurrently."""
    src = {S.SRC_BILLING: billing, S.SRC_SESSIONS: sessions, S.SRC_CUSTOMERS: customers}
    jobs = {f"repeated_{label}": (lambda label=label, df=df: keep(f"repeated_{label}", repeated_keys(df, KEYS[label])))
            for label, df in src.items()}
    jobs.update({f"orphans_{label}": (lambda label=label: keep(f"orphans_{label}", orphan_ids(src[label], customers)))
                 for label in (S.SRC_BILLING, S.SRC_SESSIONS)})
    done = run_all(**jobs) if run_all else {k: f() for k, f in jobs.items()}
    return FaultKeys(
        repeated={label: done[f"repeated_{label}"] for label in src},
        orphans={label: done[f"orphans_{label}"] for label in (S.SRC_BILLING, S.SRC_SESSIONS)})


def _count_rows(label: str, check: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("faulty_rows")).select(
        F.lit(label).alias("source_table"), F.lit(check).alias("check_type"), "faulty_rows")


def _orphan_count(label: str, orphans: DataFrame) -> DataFrame:
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("faulty_rows")).select(
        F.lit(label).alias("source_table"), F.lit(S.ORPHANED_CUSTOMER_ID).alias("check_type"), "faulty_rows")


def completeness_checks(billing: DataFrame, sessions: DataFrame, customers: DataFrame) -> dict:
    return {
        S.SRC_BILLING: (billing, {
            S.NULL_IDENTIFIER: F.col("transaction_id").isNull(),
            S.NULL_TRANSACTION_DATE: F.col("transaction_date").isNull()}),
        S.SRC_SESSIONS: (sessions, {
            S.NULL_IDENTIFIER: F.col("session_id").isNull(),
            S.NULL_START_OR_END_TIME: F.col("start_time").isNull() | F.col("end_time").isNull()}),
        S.SRC_CUSTOMERS: (customers, {
            S.NULL_IDENTIFIER: F.col("customer_id").isNull(),
            S.NULL_CREATED_AT: F.col("created_at").isNull()}),
    }


def invalid_session_times() -> Column:
    start, end = parse_ts("start_time"), parse_ts("end_time")
    return F.col("end_time").isNotNull() & F.col("start_time").isNotNull() & (end < start)


def validity_checks(billing: DataFrame, sessions: DataFrame) -> dict:
    return {
        S.SRC_BILLING: (billing, {
            S.INVALID_AMOUNT: F.col("amount").isNotNull() & (F.col("amount") < 0),
            S.UNPARSEABLE_DATE: F.col("transaction_date").isNotNull() & parse_ts("transaction_date").isNull()}),
        S.SRC_SESSIONS: (sessions, {
            S.INVALID_SESSION_TIMES: invalid_session_times(),
            S.UNPARSEABLE_TIMESTAMP: F.col("start_time").isNotNull() & parse_ts("start_time").isNull()}),
    }


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("source_table", "check_type", F.col("faulty_rows").cast("bigint").alias("faulty_rows"))


def completeness(billing: DataFrame, sessions: DataFrame, customers: DataFrame) -> DataFrame:
    checks = completeness_checks(billing, sessions, customers)
    return _union([_report(label, df, preds) for label, (df, preds) in checks.items()])


def validity(billing: DataFrame, sessions: DataFrame) -> DataFrame:
    checks = validity_checks(billing, sessions)
    return _union([_report(label, df, preds) for label, (df, preds) in checks.items()])


def uniqueness(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
               keys: FaultKeys | None = None) -> DataFrame:
    rep = keys.repeated if keys else {
        S.SRC_BILLING: repeated_keys(billing, "transaction_id"),
        S.SRC_SESSIONS: repeated_keys(sessions, "session_id"),
        S.SRC_CUSTOMERS: repeated_keys(customers, "customer_id")}
    return _union([_count_rows(label, S.DUPLICATE_IDENTIFIER, rep[label])
                   for label in (S.SRC_BILLING, S.SRC_SESSIONS, S.SRC_CUSTOMERS)])


def referential_integrity(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
                          keys: FaultKeys | None = None) -> DataFrame:
    orph = keys.orphans if keys else {S.SRC_BILLING: orphan_ids(billing, customers),
                                      S.SRC_SESSIONS: orphan_ids(sessions, customers)}
    return _union([_orphan_count(S.SRC_BILLING, orph[S.SRC_BILLING]),
                   _orphan_count(S.SRC_SESSIONS, orph[S.SRC_SESSIONS])])


def dq_report(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
              keys: FaultKeys | None = None) -> DataFrame:
    """All 15 counts. Predicate counts of both families share one scan per source;
    duplicate and orphan counts come from the shared key sets."""
    comp = completeness_checks(billing, sessions, customers)
    val = validity_checks(billing, sessions)
    parts = []
    for label, (df, preds) in comp.items():
        merged = dict(preds)
        if label in val:
            merged.update(val[label][1])
        parts.append(_report(label, df, merged))
    return _union(parts + [uniqueness(billing, sessions, customers, keys),
                           referential_integrity(billing, sessions, customers, keys)])
