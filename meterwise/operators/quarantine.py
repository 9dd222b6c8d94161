"""Quarantine: a copy of every faulty source row (N1-N12, E2).

A row is stored as JSON text with NULL fields kept, labelled with its source
and check type, and identified by ``md5(source || check_type || json)``, which
does not depend on the run. Appending only hashes not yet stored makes a rerun
add nothing. Quarantine is a copy: the rows still flow into staging.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import ntz, parse_ts, record_hash, row_json
from meterwise.operators import quality as Q
from meterwise.operators.joins import filter_by_keys, materialize
from meterwise.operators.quality import invalid_session_times


def capture(df: DataFrame, source: str, check_type: str, run_ts: dt.datetime) -> DataFrame:
    record = row_json(*df.columns)
    return df.select(record.alias("record")).select(
        "record", F.lit(source).alias("source"), F.lit(check_type).alias("check_type"),
        record_hash(source, check_type, F.col("record")).alias("record_hash"),
        ntz(run_ts).alias("detected_at"))


def rows_with_repeated_key(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once. NULL keys never match, as with IN.
    The key list is built with partial aggregation, materialized and counted; it
    is broadcast when small, so the rows are not shuffled, and skew-split by AQE
    otherwise."""
    repeated = df.groupBy(key).count().where(F.col("count") > 1).select(key)
    return filter_by_keys(df, repeated, key, "left_semi")


def orphans(activity: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows with a customer id that no customer row has. The distinct orphan ids
    are found on pre-aggregated ids first, then the rows are semi-joined to them."""
    ids = activity.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    orphan_ids = ids.join(customers.select("customer_id"), "customer_id", "left_anti")
    return filter_by_keys(activity, orphan_ids, "customer_id", "left_semi").select(*activity.columns)


def null_identifier(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
                    run_ts: dt.datetime) -> DataFrame:
    return (capture(billing.where(F.col("transaction_id").isNull()), S.Q_BILLING, S.NULL_IDENTIFIER, run_ts)
            .unionByName(capture(sessions.where(F.col("session_id").isNull()), S.Q_SESSIONS,
                                 S.NULL_IDENTIFIER, run_ts))
            .unionByName(capture(customers.where(F.col("customer_id").isNull()), S.Q_CUSTOMERS,
                                 S.NULL_IDENTIFIER, run_ts)))


def duplicate_identifier(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
                         run_ts: dt.datetime) -> DataFrame:
    return (capture(rows_with_repeated_key(billing, "transaction_id"), S.Q_BILLING, S.DUPLICATE_IDENTIFIER, run_ts)
            .unionByName(capture(rows_with_repeated_key(sessions, "session_id"), S.Q_SESSIONS,
                                 S.DUPLICATE_IDENTIFIER, run_ts))
            .unionByName(capture(rows_with_repeated_key(customers, "customer_id"), S.Q_CUSTOMERS,
                                 S.DUPLICATE_IDENTIFIER, run_ts)))


def orphaned_customer_id(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
                         run_ts: dt.datetime) -> DataFrame:
    return (capture(orphans(billing, customers), S.Q_BILLING, S.ORPHANED_CUSTOMER_ID, run_ts)
            .unionByName(capture(orphans(sessions, customers), S.Q_SESSIONS, S.ORPHANED_CUSTOMER_ID, run_ts)))


def invalid_sessions(sessions: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return capture(sessions.where(invalid_session_times()), S.Q_SESSIONS,
                   S.INVALID_SESSION_TIMES, run_ts)


def _extended_checks() -> dict[str, list[tuple[str, Column]]]:
    amount, day, start, cid = (F.col(c) for c in ("amount", "transaction_date", "start_time", "customer_id"))
    return {
        S.SRC_BILLING: [
            (S.INVALID_AMOUNT, amount.isNotNull() & (amount < 0)),
            (S.UNPARSEABLE_DATE, day.isNotNull() & parse_ts("transaction_date").isNull()),
            (S.NULL_TRANSACTION_DATE, day.isNull()), (S.NULL_CUSTOMER_ID, cid.isNull())],
        S.SRC_SESSIONS: [
            (S.UNPARSEABLE_TIMESTAMP, start.isNotNull() & parse_ts("start_time").isNull()),
            (S.NULL_START_OR_END_TIME, start.isNull() | F.col("end_time").isNull()), (S.NULL_CUSTOMER_ID, cid.isNull())],
        S.SRC_CUSTOMERS: [(S.NULL_CREATED_AT, F.col("created_at").isNull())],
    }


def extended(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
             run_ts: dt.datetime) -> DataFrame:
    """Check types that are only counted in the original, quarantined as well: one
    pass over each source."""
    checks = _extended_checks()
    return (capture_pass(billing, S.Q_BILLING, checks[S.SRC_BILLING], run_ts, billing.columns)
            .unionByName(capture_pass(sessions, S.Q_SESSIONS, checks[S.SRC_SESSIONS], run_ts, sessions.columns))
            .unionByName(capture_pass(customers, S.Q_CUSTOMERS, checks[S.SRC_CUSTOMERS], run_ts, customers.columns)))


def malformed(src: DataFrame, source: str, run_ts: dt.datetime) -> DataFrame:
    """Source lines that did not fit the schema: the line as read and what could be
    parsed of it."""
    return capture(src.where(F.col(S.MALFORMED_COLUMN).isNotNull()), source, S.MALFORMED_RECORD, run_ts)


def capture_pass(df: DataFrame, source: str, checks: list[tuple[str, Column]],
                 run_ts: dt.datetime, cols: list[str]) -> DataFrame:
    """One pass over a source: each row failing any check, once per failed check.
    The JSON of the row (over ``cols``, its original columns) is built only for
    failing rows."""
    failed = F.filter(F.array(*[F.when(pred, F.lit(name)) for name, pred in checks]), lambda x: x.isNotNull())
    bad = df.withColumn("_failed", failed).where(F.size("_failed") > 0)
    rows = bad.select(row_json(*cols).alias("record"), F.explode("_failed").alias("check_type"))
    return rows.select(
        "record", F.lit(source).alias("source"), "check_type",
        F.md5(F.concat(F.lit(source), F.col("check_type"), F.col("record"))).alias("record_hash"),
        ntz(run_ts).alias("detected_at"))


def row_checks(source: str, include_extended: bool = False) -> list[tuple[str, Column]]:
    """The captured checks that look at the row alone."""
    own = [(S.NULL_IDENTIFIER, F.col(Q.KEYS[source]).isNull())]
    if source == S.SRC_SESSIONS:
        own.append((S.INVALID_SESSION_TIMES, invalid_session_times()))
    return own + (_extended_checks()[source] if include_extended else [])


def capture_all(billing: DataFrame, sessions: DataFrame, customers: DataFrame,
                run_ts: dt.datetime, include_extended: bool = False,
                keys: Q.FaultKeys | None = None, keys_materialized: bool = False) -> DataFrame:
    """All quarantine captures. Checks on the row itself share one pass per source
    without a join. Rows of repeated and of orphaned ids are semi-joined to the key
    sets shared with the counts: within the broadcast bound nothing is shuffled,
    beyond it only the ids' side is small and a bloom filter may prune the rows."""
    if keys is None:
        keys = Q.fault_keys(billing, sessions, customers)
    m = not keys_materialized
    parts = []
    for df, label, name in ((billing, S.SRC_BILLING, S.Q_BILLING), (sessions, S.SRC_SESSIONS, S.Q_SESSIONS),
                            (customers, S.SRC_CUSTOMERS, S.Q_CUSTOMERS)):
        parts.append(capture_pass(df, name, row_checks(label, include_extended), run_ts, df.columns))
        repeated = filter_by_keys(df, keys.repeated[label], Q.KEYS[label], "left_semi", m).select(*df.columns)
        parts.append(capture(repeated, name, S.DUPLICATE_IDENTIFIER, run_ts))
        if label in keys.orphans:
            lost = filter_by_keys(df, keys.orphans[label], "customer_id", "left_semi", m).select(*df.columns)
            parts.append(capture(lost, name, S.ORPHANED_CUSTOMER_ID, run_ts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def as_variant(records: DataFrame) -> DataFrame:
    """The records with their JSON as a VARIANT in column ``row``: fields are read by path
    without a schema, and text that is no JSON is NULL. Hashes stay on the text form."""
    return records.withColumn("row", F.try_parse_json("record"))


def faulty_amounts(records: DataFrame) -> DataFrame:
    """Per source and check: the stored rows, how many hold a negative amount or none,
    and the sum of the amounts. Sources without the field have only its NULLs."""
    amount = F.try_variant_get("row", "$.amount", "decimal(18,2)")
    return as_variant(records).withColumn("amount", amount).groupBy("source", "check_type").agg(
        F.count("*").alias("n_records"), F.count_if(F.col("amount") < 0).alias("n_negative"),
        F.count_if(F.col("amount").isNull()).alias("n_without_amount"),
        F.sum("amount").cast("decimal(28,2)").alias("sum_amount"))


def first_per_hash(captured: DataFrame) -> DataFrame:
    """Identical rows (same source, check and content) collapse to one."""
    return captured.dropDuplicates(["record_hash"])


def new_records(existing: DataFrame, captured: DataFrame, deduplicated: bool = False) -> DataFrame:
    """Rows to append: one per hash (identical rows collapse), none already stored.
    The stored hashes are only probed for today's hashes (a checked-size key set),
    so the ever-growing table is scanned but not shuffled. ``deduplicated`` says
    ``captured`` is already one row per hash and read from storage."""
    first = captured if deduplicated else materialize(first_per_hash(captured), "captured")
    known = filter_by_keys(existing.select("record_hash"), first, "record_hash", "left_semi",
                           materialize=False)
    return first.join(known, "record_hash", "left_anti").select(*captured.columns)


def append(existing: DataFrame, captured: DataFrame) -> DataFrame:
    """The quarantine table after the append (first detection kept)."""
    return existing.unionByName(new_records(existing, captured))
