"""Independent DuckDB SQL for every registered query with a SQL form.

Only the base tables are registered with DuckDB, so each statement inlines
the raw sources (and whatever it derives from them) as CTEs. The SQL is
written from the semantics, not generated from the Spark plans.
"""

from __future__ import annotations

import datetime as dt

from meterwise.plans.params import (AS_OF, DAY_1, DAY_2, FRESH_BILLING, FRESH_SESSIONS, RUN_TS, RUN_TS_2, WM_BILLING,
                                    WM_CUSTOMERS, WM_SESSIONS)
from meterwise.schemas import TRANSIENT


def _ts(v: dt.datetime) -> str:
    return f"TIMESTAMP '{v.isoformat(sep=' ')}'"


def _d(v: dt.date) -> str:
    return f"DATE '{v.isoformat()}'"


RUN, RUN2 = _ts(RUN_TS), _ts(RUN_TS_2)
EPOCH = _ts(dt.datetime(1970, 1, 1))

_CURRENCY = "CASE {k} % 4 WHEN 0 THEN ' ngn ' WHEN 1 THEN 'Naira' WHEN 3 THEN 'USD' END"

SOURCES = {
    "billed_orders": """
  SELECT * REPLACE (CASE WHEN o_custkey % 17 = 3 THEN o_custkey - 1 ELSE o_custkey END AS o_custkey) FROM orders""",
    "src_customers": """
  SELECT CASE WHEN c_custkey % 101 = 7 THEN NULL ELSE c_custkey END AS customer_id,
         'o''neil ' || lower(c_mktsegment) || '-' || CAST(c_custkey AS VARCHAR) AS name,
         CASE WHEN c_custkey % 61 = 9 THEN NULL
              ELSE 'User' || CAST(c_custkey AS VARCHAR) || '@Example.COM' END AS email,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE n_name END AS country,
         CASE WHEN c_custkey % 53 = 5 THEN NULL
              ELSE CAST(1995 + c_custkey % 6 AS VARCHAR) || '-0' || CAST(1 + c_custkey % 9 AS VARCHAR)
                   || '-1' || CAST(c_custkey % 10 AS VARCHAR) || ' 00:00:00' END AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT c_custkey, lower(c_name), CAST(NULL AS VARCHAR), 'Ghana', '2001-01-01 00:00:00'
  FROM customer WHERE c_custkey % 211 = 3""",
    "src_billing_transactions": f"""
  SELECT CASE WHEN o_orderkey % 997 = 1 THEN NULL ELSE o_orderkey END AS transaction_id,
         CASE WHEN o_orderkey % 503 = 2 THEN NULL WHEN o_orderkey % 401 = 3 THEN o_custkey + 10000000
              ELSE o_custkey END AS customer_id,
         CAST(CASE WHEN o_orderkey % 307 = 4 THEN NULL WHEN o_orderkey % 211 = 5 THEN -o_totalprice
                   ELSE o_totalprice END AS DECIMAL(18,2)) AS amount,
         {_CURRENCY.format(k='o_orderkey')} AS currency,
         CASE WHEN o_orderkey % 601 = 6 THEN NULL WHEN o_orderkey % 701 = 7 THEN 'not-a-date'
              ELSE CAST(o_orderdate AS VARCHAR) END AS transaction_date
  FROM billed_orders
  UNION ALL
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), {_CURRENCY.format(k='o_orderkey')},
         CAST(o_orderdate AS VARCHAR)
  FROM billed_orders WHERE o_orderkey % 89 = 10
  UNION ALL
  SELECT o_orderkey, o_custkey, CAST(o_totalprice + 1 AS DECIMAL(18,2)), 'NGN',
         CAST(o_orderdate + INTERVAL 1 DAY AS VARCHAR)
  FROM billed_orders WHERE o_orderkey % 97 = 11""",
    "src_network_sessions": """
  SELECT CASE WHEN event_id % 499 = 1 THEN NULL ELSE event_id END AS session_id,
         CASE WHEN event_id % 401 = 2 THEN NULL WHEN event_id % 307 = 3 THEN user_id + 10000000
              ELSE user_id END AS customer_id,
         CASE WHEN event_id % 601 = 6 THEN NULL ELSE CAST(ts AS VARCHAR) END AS start_time,
         CASE WHEN event_id % 53 = 4 THEN NULL
              WHEN event_id % 71 = 5 THEN CAST(ts - INTERVAL 1 HOUR AS VARCHAR)
              ELSE CAST(ts + CAST(floor(value * 3) AS INTEGER) * INTERVAL 1 SECOND AS VARCHAR) END AS end_time,
         CAST(CASE WHEN event_id % 83 = 6 THEN NULL ELSE value END AS DECIMAL(18,2)) AS data_used_mb
  FROM events
  UNION ALL
  SELECT event_id, user_id, CAST(ts + INTERVAL 1 MINUTE AS VARCHAR), CAST(ts + INTERVAL 2 MINUTE AS VARCHAR),
         CAST(value AS DECIMAL(18,2))
  FROM events WHERE event_id % 89 = 10""",
}


def _initcap(col: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({col}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def stg_billings(src: str, wm: dt.datetime | str, run: str = RUN) -> str:
    return f"""
  SELECT transaction_id, customer_id, COALESCE(amount, CAST(0 AS DECIMAL(18,2))) AS amount, 'NGN' AS currency,
         ts AS transaction_date, {run} AS loaded_at
  FROM (SELECT *, TRY_CAST(transaction_date AS TIMESTAMP) AS ts,
               ROW_NUMBER() OVER (PARTITION BY transaction_id
                                  ORDER BY TRY_CAST(transaction_date AS TIMESTAMP) DESC NULLS LAST,
                                           amount DESC NULLS LAST, customer_id ASC) AS rn
        FROM {src}
        WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
          AND TRY_CAST(transaction_date AS TIMESTAMP) > {wm if isinstance(wm, str) else _ts(wm)} - INTERVAL 3 DAY) d
  WHERE rn = 1"""


def stg_sessions(src: str, wm: dt.datetime, run: str = RUN) -> str:
    return f"""
  SELECT session_id, customer_id, st AS start_time, et AS end_time,
         COALESCE(data_used_mb, CAST(0 AS DECIMAL(18,2))) AS data_used_mb,
         CASE WHEN et > st
              THEN CAST(CAST(date_diff('microsecond', st, et) AS DECIMAL(24,6)) * CAST(0.000001 AS DECIMAL(7,6))
                        AS DECIMAL(18,6))
              ELSE CAST(0 AS DECIMAL(18,6)) END AS session_duration_sec,
         {run} AS loaded_at
  FROM (SELECT *, TRY_CAST(start_time AS TIMESTAMP) AS st, TRY_CAST(end_time AS TIMESTAMP) AS et,
               ROW_NUMBER() OVER (PARTITION BY session_id
                                  ORDER BY TRY_CAST(start_time AS TIMESTAMP) DESC NULLS LAST,
                                           TRY_CAST(end_time AS TIMESTAMP) DESC NULLS LAST,
                                           data_used_mb DESC NULLS LAST, customer_id ASC) AS rn
        FROM {src}
        WHERE session_id IS NOT NULL AND customer_id IS NOT NULL
          AND TRY_CAST(start_time AS TIMESTAMP) > {_ts(wm)} - INTERVAL 3 DAY) d
  WHERE rn = 1"""


def stg_customers(src: str, wm: dt.datetime | None = None, run: str = RUN) -> str:
    after = "" if wm is None else f"AND TRY_CAST(created_at AS TIMESTAMP) > {_ts(wm)}"
    return f"""
  SELECT customer_id, {_initcap('name')} AS name, lower(email) AS email,
         COALESCE(country, 'Nigeria') AS country, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
         md5(COALESCE(CAST(customer_id AS VARCHAR), '') || COALESCE(name, '') || COALESCE(email, '')
             || COALESCE(country, '') || COALESCE(created_at, '')) AS row_hash,
         {run} AS loaded_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                     ORDER BY TRY_CAST(created_at AS TIMESTAMP) DESC NULLS LAST,
                                              name ASC NULLS LAST, email ASC NULLS LAST,
                                              country ASC NULLS LAST) AS rn
        FROM {src} WHERE customer_id IS NOT NULL {after}) d
  WHERE rn = 1"""


def agg_user_revenue(b: str, c: str, run: str = RUN) -> str:
    return f"""
  SELECT b.customer_id, CAST(SUM(b.amount) AS DECIMAL(28,2)) AS total_revenue, COUNT(*) AS total_transactions,
         {run} AS last_updated_at
  FROM {b} b JOIN {c} c ON b.customer_id = c.customer_id GROUP BY b.customer_id"""


def agg_user_usage(s: str, c: str, run: str = RUN) -> str:
    return f"""
  SELECT s.customer_id, CAST(SUM(s.data_used_mb) AS DECIMAL(28,2)) AS total_data_used_mb,
         CAST(SUM(s.session_duration_sec) AS DECIMAL(28,6)) AS total_session_duration, COUNT(*) AS total_sessions,
         {run} AS last_updated_at
  FROM {s} s JOIN {c} c ON s.customer_id = c.customer_id GROUP BY s.customer_id"""


def agg_monthly_revenue(b: str, c: str, run: str = RUN) -> str:
    return f"""
  SELECT b.customer_id, CAST(date_trunc('month', b.transaction_date) AS DATE) AS month,
         CAST(SUM(b.amount) AS DECIMAL(28,2)) AS total_revenue, {run} AS last_updated_at
  FROM {b} b JOIN {c} c ON b.customer_id = c.customer_id
  WHERE b.transaction_date IS NOT NULL
  GROUP BY b.customer_id, CAST(date_trunc('month', b.transaction_date) AS DATE)"""


def agg_arpu(m: str, run: str = RUN) -> str:
    return f"""
  SELECT customer_id,
         CASE WHEN COUNT(DISTINCT month) = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(SUM(total_revenue) AS DOUBLE) / CAST(COUNT(DISTINCT month) AS DOUBLE) END AS arpu,
         {run} AS last_updated_at
  FROM {m} GROUP BY customer_id"""


def session_buckets(s: str, c: str, run: str = RUN) -> str:
    return f"""
  SELECT s.session_id, s.customer_id,
         CASE WHEN s.session_duration_sec < 60 THEN 'short'
              WHEN s.session_duration_sec < 300 THEN 'medium' ELSE 'long' END AS bucket,
         {run} AS last_updated_at
  FROM {s} s JOIN {c} c ON s.customer_id = c.customer_id"""


def agg_session_distribution(bk: str, run: str = RUN) -> str:
    return f"""
  SELECT customer_id, COUNT(*) FILTER (WHERE bucket = 'short') AS short_sessions,
         COUNT(*) FILTER (WHERE bucket = 'medium') AS medium_sessions,
         COUNT(*) FILTER (WHERE bucket = 'long') AS long_sessions, {run} AS last_updated_at
  FROM {bk} GROUP BY customer_id"""


def wide(c: str, r: str, u: str, a: str, d: str, run: str = RUN) -> str:
    per = "CASE WHEN COALESCE(u.total_sessions, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({x} AS DOUBLE) / CAST(u.total_sessions AS DOUBLE) END"
    return f"""
  SELECT c.customer_id, c.name AS customer_name, c.email, c.country, CAST(c.created_at AS DATE) AS customer_since,
         COALESCE(CAST(r.total_revenue AS DOUBLE), 0) AS total_revenue,
         COALESCE(r.total_transactions, 0) AS total_transactions,
         COALESCE(CAST(u.total_data_used_mb AS DOUBLE), 0) AS total_data_used_mb,
         COALESCE(u.total_sessions, 0) AS total_sessions,
         {per.format(x='u.total_session_duration')} AS avg_session_duration_sec,
         COALESCE(a.arpu, 0) AS arpu,
         COALESCE(d.short_sessions, 0) AS short_sessions,
         COALESCE(d.medium_sessions, 0) AS medium_sessions,
         COALESCE(d.long_sessions, 0) AS long_sessions,
         {per.format(x='u.total_data_used_mb')} AS avg_data_per_session_mb,
         c.row_hash, {run} AS last_updated_at
  FROM {c} c
  LEFT JOIN {r} r ON c.customer_id = r.customer_id
  LEFT JOIN {u} u ON c.customer_id = u.customer_id
  LEFT JOIN {a} a ON c.customer_id = a.customer_id
  LEFT JOIN {d} d ON c.customer_id = d.customer_id"""


def _world(suffix: str, b: str, s: str, c: str, run: str = RUN) -> dict[str, str]:
    """Aggregates and the wide table over staging CTEs ``b``, ``s``, ``c``."""
    x = suffix
    return {
        f"rev{x}": agg_user_revenue(b, c, run),
        f"use{x}": agg_user_usage(s, c, run),
        f"mon{x}": agg_monthly_revenue(b, c, run),
        f"arpu{x}": agg_arpu(f"mon{x}", run),
        f"bk{x}": session_buckets(s, c, run),
        f"dist{x}": agg_session_distribution(f"bk{x}", run),
        f"wide{x}": wide(c, f"rev{x}", f"use{x}", f"arpu{x}", f"dist{x}", run),
    }


def _ctes() -> dict[str, str]:
    t = dict(SOURCES)
    t["stg_b"] = stg_billings("src_billing_transactions", dt.datetime(1970, 1, 1))
    t["stg_s"] = stg_sessions("src_network_sessions", dt.datetime(1970, 1, 1))
    t["stg_c"] = stg_customers("src_customers")
    t.update(_world("", "stg_b", "stg_s", "stg_c"))
    # run 1: sources as they stood at the watermark
    t["src_b1"] = f"SELECT * FROM src_billing_transactions WHERE TRY_CAST(transaction_date AS TIMESTAMP) <= {_ts(WM_BILLING)}"
    t["src_s1"] = f"SELECT * FROM src_network_sessions WHERE TRY_CAST(start_time AS TIMESTAMP) <= {_ts(WM_SESSIONS)}"
    t["src_c1"] = (f"SELECT * FROM src_customers WHERE TRY_CAST(created_at AS TIMESTAMP) IS NULL "
                   f"OR TRY_CAST(created_at AS TIMESTAMP) <= {_ts(WM_CUSTOMERS)}")
    t["stg_b1"] = stg_billings("src_b1", dt.datetime(1970, 1, 1))
    t["stg_s1"] = stg_sessions("src_s1", dt.datetime(1970, 1, 1))
    t["stg_c1"] = stg_customers("src_c1")
    # run 2: everything with the watermark and lookback
    t["stg_b2"] = stg_billings("src_billing_transactions", WM_BILLING, RUN2)
    t["stg_s2"] = stg_sessions("src_network_sessions", WM_SESSIONS, RUN2)
    t["stg_c2"] = stg_customers("src_customers", WM_CUSTOMERS, RUN2)
    t.update(_world("_1", "stg_b1", "stg_s1", "stg_c1"))       # run-1 world
    t.update(_world("_a1", "stg_b1", "stg_s1", "stg_c"))       # run 1 aggregates, all customers
    t.update(_world("_a2", "stg_b2", "stg_s2", "stg_c", RUN2))       # run 2 aggregates, all customers
    return t


CTES = _ctes()


def _deps(body: str, names: list[str]) -> list[str]:
    """CTE names used by ``body`` and, recursively, by those CTEs, in definition order."""
    import re
    need: set[str] = set()
    stack = [body]
    while stack:
        text = stack.pop()
        for n in names:
            if n not in need and re.search(rf"\b{re.escape(n)}\b", text):
                need.add(n)
                stack.append(CTES[n])
    return [n for n in names if n in need]


def sql(body: str) -> str:
    names = list(CTES)
    used = _deps(body, names)
    if not used:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in used) + "\n" + body


def _json_capture(src: str, label: str, check: str, where: str) -> str:
    return f"""
  SELECT CAST(to_json(t) AS VARCHAR) AS record, '{label}' AS source, '{check}' AS check_type,
         md5('{label}' || '{check}' || CAST(to_json(t) AS VARCHAR)) AS record_hash, {RUN} AS detected_at
  FROM {src} t WHERE {where}"""


_DUP = "{k} IN (SELECT {k} FROM {src} GROUP BY {k} HAVING COUNT(*) > 1)"
_ORPHAN = "t.customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM src_customers c WHERE c.customer_id = t.customer_id)"
_BAD_TIMES = ("end_time IS NOT NULL AND start_time IS NOT NULL "
              "AND TRY_CAST(end_time AS TIMESTAMP) < TRY_CAST(start_time AS TIMESTAMP)")

Q_NULL = " UNION ALL ".join([
    _json_capture("src_billing_transactions", "billing_transactions", "null_identifier", "transaction_id IS NULL"),
    _json_capture("src_network_sessions", "network_sessions", "null_identifier", "session_id IS NULL"),
    _json_capture("src_customers", "customers", "null_identifier", "customer_id IS NULL")])
Q_DUP = " UNION ALL ".join([
    _json_capture("src_billing_transactions", "billing_transactions", "duplicate_identifier",
                  _DUP.format(k="transaction_id", src="src_billing_transactions")),
    _json_capture("src_network_sessions", "network_sessions", "duplicate_identifier",
                  _DUP.format(k="session_id", src="src_network_sessions")),
    _json_capture("src_customers", "customers", "duplicate_identifier",
                  _DUP.format(k="customer_id", src="src_customers"))])
Q_ORPHAN = " UNION ALL ".join([
    _json_capture("src_billing_transactions", "billing_transactions", "orphaned_customer_id", _ORPHAN),
    _json_capture("src_network_sessions", "network_sessions", "orphaned_customer_id", _ORPHAN)])
Q_TIMES = _json_capture("src_network_sessions", "network_sessions", "invalid_session_times", _BAD_TIMES)
Q_ALL = f"""
  SELECT record, source, check_type, record_hash, detected_at FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY record_hash ORDER BY record) AS rn
    FROM ({Q_NULL} UNION ALL {Q_DUP} UNION ALL {Q_ORPHAN} UNION ALL {Q_TIMES}) x) y
  WHERE rn = 1"""
# run 1 sees the activity at or before the watermarks; what it found keeps its detection time
Q_RERUN = f"""
  SELECT record, source, check_type, record_hash,
         CASE WHEN record_hash IN (SELECT record_hash FROM found_1) THEN {RUN} ELSE {RUN2} END AS detected_at
  FROM ({Q_ALL}) q"""
Q_EXT = " UNION ALL ".join([
    _json_capture("src_billing_transactions", "billing_transactions", "invalid_amount",
                  "amount IS NOT NULL AND amount < 0"),
    _json_capture("src_billing_transactions", "billing_transactions", "unparseable_date",
                  "transaction_date IS NOT NULL AND TRY_CAST(transaction_date AS TIMESTAMP) IS NULL"),
    _json_capture("src_billing_transactions", "billing_transactions", "null_transaction_date",
                  "transaction_date IS NULL"),
    _json_capture("src_billing_transactions", "billing_transactions", "null_customer_id", "customer_id IS NULL"),
    _json_capture("src_network_sessions", "network_sessions", "unparseable_timestamp",
                  "start_time IS NOT NULL AND TRY_CAST(start_time AS TIMESTAMP) IS NULL"),
    _json_capture("src_network_sessions", "network_sessions", "null_start_or_end_time",
                  "start_time IS NULL OR end_time IS NULL"),
    _json_capture("src_network_sessions", "network_sessions", "null_customer_id", "customer_id IS NULL"),
    _json_capture("src_customers", "customers", "null_created_at", "created_at IS NULL")])


def _count(label: str, check: str, src: str, where: str) -> str:
    return f"SELECT '{label}' AS source_table, '{check}' AS check_type, COUNT(*) AS faulty_rows FROM {src} WHERE {where}"


def _dupcount(label: str, src: str, k: str) -> str:
    return (f"SELECT '{label}' AS source_table, 'duplicate_identifier' AS check_type, COUNT(*) AS faulty_rows "
            f"FROM (SELECT {k} FROM {src} GROUP BY {k} HAVING COUNT(*) > 1) d")


B, SS, C = "src_billing_transactions", "src_network_sessions", "src_customers"
DQ_COMPLETENESS = "\nUNION ALL\n".join([
    _count(B, "null_identifier", B, "transaction_id IS NULL"),
    _count(SS, "null_identifier", SS, "session_id IS NULL"),
    _count(C, "null_identifier", C, "customer_id IS NULL"),
    _count(B, "null_transaction_date", B, "transaction_date IS NULL"),
    _count(C, "null_created_at", C, "created_at IS NULL"),
    _count(SS, "null_start_or_end_time", SS, "start_time IS NULL OR end_time IS NULL")])
DQ_UNIQUENESS = "\nUNION ALL\n".join([
    _dupcount(B, B, "transaction_id"), _dupcount(SS, SS, "session_id"), _dupcount(C, C, "customer_id")])
DQ_REFERENTIAL = "\nUNION ALL\n".join([
    _count(B, "orphaned_customer_id", f"{B} t", _ORPHAN), _count(SS, "orphaned_customer_id", f"{SS} t", _ORPHAN)])
DQ_VALIDITY = "\nUNION ALL\n".join([
    _count(B, "invalid_amount", B, "amount IS NOT NULL AND amount < 0"),
    _count(B, "unparseable_date", B, "transaction_date IS NOT NULL AND TRY_CAST(transaction_date AS TIMESTAMP) IS NULL"),
    _count(SS, "invalid_session_times", SS, _BAD_TIMES),
    _count(SS, "unparseable_timestamp", SS, "start_time IS NOT NULL AND TRY_CAST(start_time AS TIMESTAMP) IS NULL")])


def _merge(t: str, s: str, take: str) -> str:
    cols = ["customer_id", "customer_name", "email", "country", "customer_since", "total_revenue",
            "total_transactions", "total_data_used_mb", "total_sessions", "avg_session_duration_sec", "arpu",
            "short_sessions", "medium_sessions", "long_sessions", "avg_data_per_session_mb", "row_hash",
            "last_updated_at"]
    sel = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"SELECT {sel} FROM {t} t FULL OUTER JOIN {s} s ON t.customer_id = s.customer_id"


_TAKE_ATTR = "t.customer_id IS NULL OR (s.customer_id IS NOT NULL AND t.row_hash <> s.row_hash)"
_CONTENT = ["customer_name", "email", "country", "customer_since", "total_revenue", "total_transactions",
            "total_data_used_mb", "total_sessions", "avg_session_duration_sec", "arpu", "short_sessions",
            "medium_sessions", "long_sessions", "avg_data_per_session_mb", "row_hash"]


def _additive(a1: str, a2: str, keys: list[str], sums: list[str], types: dict[str, str]) -> str:
    k = ", ".join(keys)
    s = ", ".join(f"CAST(SUM({c}) AS {types[c]}) AS {c}" for c in sums)
    cols = ", ".join(keys + sums + ["last_updated_at"])
    return (f"SELECT {k}, {s}, MAX(last_updated_at) AS last_updated_at FROM "
            f"(SELECT {cols} FROM {a1} UNION ALL SELECT {cols} FROM {a2}) u GROUP BY {k}")


ORACLE: dict[str, str] = {
    "src_customers": "SELECT * FROM src_customers",
    "src_billing": "SELECT * FROM src_billing_transactions",
    "src_sessions": "SELECT * FROM src_network_sessions",
    "csv_roundtrip": "SELECT * FROM wide",
    "freshness_billing": (f"SELECT '{B}' AS source_table, {_d(FRESH_BILLING)} AS run_date, COUNT(*) AS fresh_rows "
                          f"FROM {B} WHERE CAST(TRY_CAST(transaction_date AS TIMESTAMP) AS DATE) = {_d(FRESH_BILLING)}"),
    "freshness_sessions": (f"SELECT '{SS}' AS source_table, {_d(FRESH_SESSIONS)} AS run_date, COUNT(*) AS fresh_rows "
                           f"FROM {SS} WHERE CAST(TRY_CAST(start_time AS TIMESTAMP) AS DATE) = {_d(FRESH_SESSIONS)}"),
    "source_date_range": (f"SELECT MIN(TRY_CAST(transaction_date AS TIMESTAMP)) AS min_transaction_date, "
                          f"MAX(TRY_CAST(transaction_date AS TIMESTAMP)) AS max_transaction_date FROM {B}"),
    "customer_load_mode": (
        "SELECT DISTINCT CAST(TRY_CAST(transaction_date AS TIMESTAMP) AS DATE) AS run_date, "
        "CASE WHEN isodow(CAST(TRY_CAST(transaction_date AS TIMESTAMP) AS DATE)) = 7 THEN 'full' "
        f"ELSE 'incremental' END AS customer_load_mode FROM {B} "
        "WHERE TRY_CAST(transaction_date AS TIMESTAMP) IS NOT NULL"),
    "dq_completeness": DQ_COMPLETENESS,
    "dq_uniqueness": DQ_UNIQUENESS,
    "dq_referential_integrity": DQ_REFERENTIAL,
    "dq_validity": DQ_VALIDITY,
    "dq_report": "\nUNION ALL\n".join([DQ_COMPLETENESS, DQ_UNIQUENESS, DQ_REFERENTIAL, DQ_VALIDITY]),
    "quarantine_null_identifier": Q_NULL,
    "quarantine_duplicate_identifier": Q_DUP,
    "quarantine_orphaned_customer_id": Q_ORPHAN,
    "quarantine_invalid_session_times": Q_TIMES,
    "quarantine_all": Q_ALL,
    "quarantine_rerun": Q_RERUN,
    "quarantine_extended": Q_EXT,
    "stg_billings_initial": "SELECT * FROM stg_b",
    "stg_billings_incremental": "SELECT * FROM stg_b2",
    "stg_sessions_initial": "SELECT * FROM stg_s",
    "stg_sessions_incremental": "SELECT * FROM stg_s2",
    "stg_customers_full": "SELECT * FROM stg_c",
    "stg_customers_incremental": "SELECT * FROM stg_c2",
    "upsert_replace": ("SELECT * FROM stg_b1 WHERE transaction_id NOT IN (SELECT transaction_id FROM stg_b2) "
                       "UNION ALL SELECT * FROM stg_b2"),
    "upsert_insert_only": ("SELECT * FROM stg_c1 UNION ALL SELECT * FROM stg_c2 "
                           "WHERE customer_id NOT IN (SELECT customer_id FROM stg_c1)"),
    "watermark_update": (
        f"SELECT '{B}' AS source_table, MAX(transaction_date) AS last_processed, {RUN} AS updated_at FROM stg_b "
        f"UNION ALL SELECT '{SS}', MAX(start_time), {RUN} FROM stg_s "
        f"UNION ALL SELECT '{C}', MAX(created_at), {RUN} FROM stg_c"),
    "watermark_seed": (
        f"SELECT '{B}' AS source_table, MAX(transaction_date) AS last_processed, {RUN} AS updated_at FROM stg_b "
        f"UNION ALL SELECT '{SS}', {EPOCH}, {EPOCH} UNION ALL SELECT '{C}', {EPOCH}, {EPOCH}"),
    "agg_user_revenue": "SELECT * FROM rev",
    "agg_user_usage": "SELECT * FROM use",
    "agg_monthly_revenue": "SELECT * FROM mon",
    "agg_arpu": "SELECT * FROM arpu",
    "session_buckets": "SELECT * FROM bk",
    "agg_session_distribution": "SELECT * FROM dist",
    "agg_user_revenue_additive": _additive("rev_a1", "rev_a2", ["customer_id"], ["total_revenue", "total_transactions"],
                                           {"total_revenue": "DECIMAL(28,2)", "total_transactions": "BIGINT"}),
    "agg_user_usage_additive": _additive(
        "use_a1", "use_a2", ["customer_id"], ["total_data_used_mb", "total_session_duration", "total_sessions"],
        {"total_data_used_mb": "DECIMAL(28,2)", "total_session_duration": "DECIMAL(28,6)", "total_sessions": "BIGINT"}),
    "agg_monthly_revenue_additive": _additive("mon_a1", "mon_a2", ["customer_id", "month"], ["total_revenue"],
                                              {"total_revenue": "DECIMAL(28,2)"}),
    "agg_session_distribution_additive": _additive(
        "dist_a1", "dist_a2", ["customer_id"], ["short_sessions", "medium_sessions", "long_sessions"],
        {"short_sessions": "BIGINT", "medium_sessions": "BIGINT", "long_sessions": "BIGINT"}),
    "agg_user_revenue_recompute": (
        f"SELECT customer_id, total_revenue, total_transactions, CASE WHEN customer_id IN (SELECT customer_id FROM stg_bd "
        f"UNION SELECT customer_id FROM stg_b1 WHERE transaction_id IN (SELECT transaction_id FROM stg_bd)) "
        f"THEN {RUN2} ELSE {RUN} END AS last_updated_at FROM rev"),
    "agg_arpu_replace": (
        "SELECT * FROM arpu_a1 WHERE customer_id NOT IN (SELECT customer_id FROM m_arpu) UNION ALL SELECT * FROM m_arpu"),
    "session_buckets_replace": (
        "SELECT COALESCE(t.session_id, d.session_id) AS session_id, "
        "CASE WHEN t.session_id IS NOT NULL THEN t.customer_id ELSE d.customer_id END AS customer_id, "
        "CASE WHEN d.session_id IS NOT NULL THEN d.bucket ELSE t.bucket END AS bucket, "
        "CASE WHEN d.session_id IS NOT NULL THEN d.last_updated_at ELSE t.last_updated_at END AS last_updated_at "
        "FROM bk_a1 t FULL OUTER JOIN bk_a2 d ON t.session_id = d.session_id"),
    "dw_user_analytics": "SELECT * FROM wide",
    "churn_candidates": (f"SELECT * FROM wide WHERE total_sessions < 5 AND total_revenue < 1000 "
                         f"AND customer_since <= CAST({_d(AS_OF)} - INTERVAL 30 DAY AS DATE)"),
    "inactive_customers": "SELECT * FROM wide WHERE total_transactions = 0 AND total_sessions = 0",
    "dw_merge": _merge("wide_1", "wide_r2", _TAKE_ATTR),
    "dw_merge_row": _merge("wide_1h", "wide_h",
                           "t.customer_id IS NULL OR (s.customer_id IS NOT NULL AND t.h <> s.h)"),
    "dw_merge_unchanged": _merge("wide_1", "wide_r2", _TAKE_ATTR),  # the repeat adds nothing
    "daily_run_dw": _merge("wide_1h", "wide_h", "t.customer_id IS NULL OR (s.customer_id IS NOT NULL AND t.h <> s.h)"),
    "daily_run_usage": "SELECT * EXCLUDE (last_updated_at) FROM use",
    "daily_run_monthly": "SELECT * EXCLUDE (last_updated_at) FROM mon",
    "daily_run_arpu": "SELECT * EXCLUDE (last_updated_at) FROM arpu",
    "daily_run_distribution": "SELECT * EXCLUDE (last_updated_at) FROM dist",
    "daily_run_billing_history": "SELECT * EXCLUDE (loaded_at) FROM stg_b",
    "daily_run_watermarks": (
        f"SELECT '{B}' AS source_table, MAX(transaction_date) AS last_processed, {RUN2} AS updated_at FROM stg_b "
        f"UNION ALL SELECT '{SS}', MAX(start_time), {RUN2} FROM stg_s "
        f"UNION ALL SELECT '{C}', MAX(created_at), {RUN2} FROM stg_c"),
    "daily_run_truncated": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS n_rows FROM (SELECT COUNT(*) FROM src_customers)" for t in TRANSIENT),
    "stream_billings": "SELECT * FROM stg_b",
    "stream_sessions": "SELECT * FROM stg_s",
    "stream_user_revenue": "SELECT * FROM rev",
    "stream_monthly_revenue": "SELECT * FROM mon",
    "stream_user_usage": "SELECT * FROM use",
    "stream_session_distribution": "SELECT * FROM dist",
    "late_rows": f"""
SELECT '{B}' AS source_table, transaction_id AS row_id, customer_id, TRY_CAST(transaction_date AS TIMESTAMP) AS row_time
FROM {B} WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
  AND TRY_CAST(transaction_date AS TIMESTAMP) <= {_ts(WM_BILLING)} - INTERVAL 3 DAY
  AND (transaction_id NOT IN (SELECT transaction_id FROM stg_b)
       OR transaction_id IN (SELECT transaction_id FROM {B} WHERE currency IS NULL))
UNION ALL
SELECT '{SS}', session_id, customer_id, TRY_CAST(start_time AS TIMESTAMP)
FROM {SS} WHERE session_id IS NOT NULL AND customer_id IS NOT NULL
  AND TRY_CAST(start_time AS TIMESTAMP) <= {_ts(WM_SESSIONS)} - INTERVAL 3 DAY
  AND (session_id NOT IN (SELECT session_id FROM stg_s)
       OR session_id IN (SELECT session_id FROM {SS} WHERE data_used_mb IS NULL))""",
    "stream_first_copies": f"""
SELECT transaction_id, {_d(DAY_1)} AS arrived_on FROM stg_b1
UNION ALL
SELECT DISTINCT transaction_id, {_d(DAY_2)} FROM {B}
WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND TRY_CAST(transaction_date AS TIMESTAMP) > {_ts(WM_BILLING)}
  AND TRY_CAST(transaction_date AS TIMESTAMP) > (SELECT MAX(transaction_date) FROM stg_b1) - INTERVAL 3 DAY
  AND transaction_id NOT IN (SELECT transaction_id FROM stg_b1)""",
    "dq_report_arrivals": "\nUNION ALL\n".join([DQ_COMPLETENESS, DQ_UNIQUENESS, DQ_REFERENTIAL, DQ_VALIDITY]),
    "quarantine_arrivals": f"""
SELECT * FROM found_a1
UNION ALL
SELECT record, source, check_type, record_hash, {RUN2} AS detected_at FROM ({Q_ALL}) q
WHERE record_hash NOT IN (SELECT record_hash FROM found_a1)""",
    "late_arrivals": f"""
SELECT '{B}' AS source_table, transaction_id AS row_id, customer_id, transaction_date AS row_time FROM arr_b2
WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
  AND TRY_CAST(transaction_date AS TIMESTAMP) <= (SELECT MAX(transaction_date) FROM stg_ab1) - INTERVAL 3 DAY
  AND transaction_id NOT IN (SELECT transaction_id FROM stg_ab1)
UNION ALL
SELECT '{SS}', session_id, customer_id, start_time FROM arr_s2
WHERE session_id IS NOT NULL AND customer_id IS NOT NULL
  AND TRY_CAST(start_time AS TIMESTAMP) <= (SELECT MAX(start_time) FROM stg_as1) - INTERVAL 3 DAY
  AND session_id NOT IN (SELECT session_id FROM stg_as1)""",
    "daily_arrivals_dw": "SELECT * EXCLUDE (last_updated_at) FROM wide_ad",
    "stg_billings_defaults": "SELECT transaction_id, customer_id, amount, currency, transaction_date, true AS loaded_just_now FROM stg_b",
    "truncate_staging": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_left FROM {cte}"
        for t, cte in (("stg_billings", "stg_b"), ("stg_sessions", "stg_s"), ("stg_customers", "stg_c"), ("session_buckets", "bk"))),
    "dw_user_analytics_bucketed": "SELECT * FROM wide",
    "csv_source_malformed": f"""
SELECT transaction_id, customer_id, CASE WHEN transaction_id % 97 = 3 THEN NULL ELSE amount END AS amount, currency,
       transaction_date, false AS in_quarantine FROM {B}
UNION ALL
SELECT transaction_id, NULL, NULL, NULL, NULL, true FROM {B} WHERE transaction_id % 97 = 3""",
    "quarantine_faulty_amounts": f"""
SELECT source, check_type, COUNT(*) AS n_records, COUNT(*) FILTER (WHERE amount < 0) AS n_negative,
       COUNT(*) FILTER (WHERE amount IS NULL) AS n_without_amount, CAST(SUM(amount) AS DECIMAL(28,2)) AS sum_amount
FROM (SELECT DISTINCT ON (record_hash) source, check_type, record_hash,
             CAST(json_extract_string(record, '$.amount') AS DECIMAL(18,2)) AS amount
      FROM ({Q_NULL} UNION ALL {Q_DUP} UNION ALL {Q_ORPHAN} UNION ALL {Q_TIMES} UNION ALL {Q_EXT}) x)
GROUP BY source, check_type""",
}

# CTEs that only some oracles need
_hash = ("md5(concat_ws(chr(31), " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '\\N')" for c in _CONTENT) + "))")
CTES["m_arpu"] = agg_arpu(
    "(SELECT * FROM (" + _additive("mon_a1", "mon_a2", ["customer_id", "month"], ["total_revenue"],
                                   {"total_revenue": "DECIMAL(28,2)"})
    + ") WHERE customer_id IN (SELECT customer_id FROM mon_a2))", RUN2)
CTES["wide_1h"] = f"SELECT *, {_hash} AS h FROM wide_1"
CTES["wide_r2"] = f"SELECT * REPLACE ({RUN2} AS last_updated_at) FROM wide"
CTES["wide_h"] = f"SELECT *, {_hash} AS h FROM wide_r2"
# what the second day of the two-day run stages, and what its first day quarantines
CTES["stg_bd"] = stg_billings("src_billing_transactions", "(SELECT MAX(transaction_date) FROM stg_b1)")
# the two arrivals, what the first day stages of them, and what both days have staged
_A1 = {"b": f"COALESCE(TRY_CAST(transaction_date AS TIMESTAMP) <= {_ts(WM_BILLING)}, false) AND currency IS NOT NULL",
       "s": f"COALESCE(TRY_CAST(start_time AS TIMESTAMP) <= {_ts(WM_SESSIONS)}, false) AND data_used_mb IS NOT NULL",
       "c": f"COALESCE(TRY_CAST(created_at AS TIMESTAMP) <= {_ts(WM_CUSTOMERS)}, true)"}
for _x, _src in (("b", B), ("s", SS), ("c", C)):
    CTES[f"arr_{_x}1"] = f"SELECT * FROM {_src} WHERE {_A1[_x]}"
    CTES[f"arr_{_x}2"] = f"SELECT * FROM {_src} WHERE NOT ({_A1[_x]})"
CTES["stg_ab1"] = stg_billings("arr_b1", dt.datetime(1970, 1, 1))
CTES["stg_as1"] = stg_sessions("arr_s1", dt.datetime(1970, 1, 1))
CTES["seen_b"] = f"""SELECT * FROM arr_b1 UNION ALL SELECT * FROM {B}
  WHERE TRY_CAST(transaction_date AS TIMESTAMP) > (SELECT MAX(transaction_date) FROM stg_ab1) - INTERVAL 3 DAY"""
CTES["seen_s"] = f"""SELECT * FROM arr_s1 UNION ALL SELECT * FROM {SS}
  WHERE TRY_CAST(start_time AS TIMESTAMP) > (SELECT MAX(start_time) FROM stg_as1) - INTERVAL 3 DAY"""
CTES["stg_ab"] = stg_billings("seen_b", dt.datetime(1970, 1, 1))
CTES["stg_as"] = stg_sessions("seen_s", dt.datetime(1970, 1, 1))
CTES.update(_world("_ad", "stg_ab", "stg_as", "stg_c"))
CTES["found_a1"] = Q_ALL.replace(B, "arr_b1").replace(SS, "arr_s1").replace(C, "arr_c1")
CTES["found_1"] = Q_ALL.replace("src_billing_transactions t", "src_b1 t").replace("src_network_sessions t", "src_s1 t").replace(
    "FROM src_billing_transactions GROUP", "FROM src_b1 GROUP").replace("FROM src_network_sessions GROUP", "FROM src_s1 GROUP")


def oracle_sql() -> dict[str, str]:
    return {k: sql(v) for k, v in ORACLE.items()}
