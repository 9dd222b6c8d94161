"""The daily run: freshness -> quality + quarantine -> staging -> watermarks ->
aggregates -> wide table -> CSV hand-off -> guarded merge, all prepared aside and
then published, -> truncate.

``mode="recompute"`` (default) keeps a customer dimension, the deduplicated
billing / session history and running totals, and moves the totals by signed
deltas (minus an id's previous winning row, plus its new one); it is idempotent,
so a retried or repeated run never double counts and weekday runs keep existing
customers' activity.
``mode="additive"`` reproduces the original arithmetic (aggregates += today's
staging, wide table driven by today's staged customers).

Driver round trips: two freshness probes (first row only), the run log, the months
that lost their last row, and one uniqueness probe before the merge. Watermarks stay
in the plans as scalar subqueries.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.operators import aggregates as A
from meterwise.operators import quality as Q
from meterwise.operators import quarantine as N
from meterwise.operators import staging as G
from meterwise.operators import upsert as U
from meterwise.operators import warehouse as H
from meterwise.operators import watermark as W
from meterwise.operators.joins import filter_by_keys, is_small
from meterwise.plans import incremental
from meterwise.plans.tables import TableStore
from meterwise.sources.io import export_csv, import_csv

CUSTOMER_KEYED = ("agg_user_revenue", "agg_user_usage", "agg_monthly_revenue", "agg_arpu",
                  "agg_session_distribution")


@dataclass
class RunResult:
    run_id: str
    skipped: bool = False
    customer_load: str = ""
    tables: list[str] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)


class Run:
    """What one run prepares, published together by its commit."""

    def __init__(self, store: TableStore, run_id: str):
        self.store, self.run_id = store, run_id
        self.tables: list[str] = []
        self.emptied: list[str] = []
        self.seconds: dict[str, float] = {}

    @contextmanager
    def phase(self, name: str):
        t0 = time.perf_counter()
        yield
        self.seconds[name] = round(time.perf_counter() - t0, 3)

    def put(self, table: str, df: DataFrame) -> DataFrame:
        """Prepare the next content of ``table`` (of its partitions in ``df``) and continue from the copy."""
        self.tables.append(table)
        return self.store.prepare(table, df)

    def commit(self) -> None:
        self.store.commit(self.run_id, self.tables, self.emptied)


def together(**jobs: Callable[[], object]) -> dict[str, object]:
    """Run independent steps as concurrent Spark jobs (one session, several
    submitting threads) and return their results by name. Each step still
    writes and reads back its own output; only the waiting overlaps."""
    if len(jobs) == 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(4, len(jobs))) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def run_daily(spark: SparkSession, store: TableStore, sources: dict[str, DataFrame],
              run_date: dt.date, run_ts: dt.datetime, mode: str = "recompute",
              guard: str = "row", check_fresh: bool = True,
              quarantine_extended: bool = False, report_late: bool = True,
              export_root: str | None = None) -> RunResult:
    run_id = run_date.isoformat()
    load = G.customer_load_mode(run_date)
    store.recover()
    if store.is_committed(run_id):
        return RunResult(run_id, skipped=True)
    # landed sources carry partitions: staging prunes by event_date, and where the day
    # of arrival is known too, the checks read new arrivals only. The checks and the
    # quarantine see exactly the source's own columns
    staging_src = {k: v.drop(S.MALFORMED_COLUMN) for k, v in sources.items()}
    raw = {k: v.drop(*S.LANDED, S.MALFORMED_COLUMN) for k, v in sources.items()}
    landed, day = incremental.is_landed(sources), None
    b, s, c = raw["billing"], raw["sessions"], raw["customers"]
    run = Run(store, run_id)

    # 1. freshness gate (raises; nothing is written)
    if check_fresh:
        with run.phase("freshness"):
            Q.check_freshness(sources["billing"], S.SRC_BILLING, "transaction_date", run_date)
            Q.check_freshness(sources["sessions"], S.SRC_SESSIONS, "start_time", run_date)

    # 2. quality counts and quarantine (a copy; rows still flow on)
    with run.phase("quality"):
        if landed:
            day, bad = incremental.quality_day(run, sources, run_date, run_ts, quarantine_extended)
        else:
            # repeated ids and orphan ids feed both the counts and the quarantine
            keys = Q.fault_keys(b, s, c, keep=store.stage, run_all=together)
            run.put("dq_report", Q.dq_report(b, s, c, keys).withColumn("run_date", F.lit(run_date)))
            bad = N.capture_all(b, s, c, run_ts, include_extended=quarantine_extended, keys=keys, keys_materialized=True)
    with run.phase("quarantine"):
        for k, label in (("billing", S.Q_BILLING), ("sessions", S.Q_SESSIONS), ("customers", S.Q_CUSTOMERS)):
            if S.MALFORMED_COLUMN in sources[k].columns:
                bad = bad.unionByName(N.malformed(sources[k], label, run_ts))
        captured = store.stage("quarantine_captured", N.first_per_hash(bad))
        new = N.new_records(store.read("quarantine_records"), captured, deduplicated=True)
        run.put("quarantine_records", new.withColumn("detected_on", F.lit(run_id)))

    # 3. staging behind the watermarks, which stay in the plans as scalar subqueries
    with run.phase("staging"):
        wm_table = store.stage("watermarks", W.seed(spark, store.read("pipeline_watermarks")))
        wms = {name: W.value(wm_table, name) for name in W.SOURCES}
        staged = together(
            b=lambda: store.load("stg_billings", G.stage_billings(staging_src["billing"], wms[S.SRC_BILLING], run_ts)),
            s=lambda: store.load("stg_sessions", G.stage_sessions(staging_src["sessions"], wms[S.SRC_SESSIONS], run_ts)),
            c=lambda: store.load("stg_customers", G.stage_customers(c, run_date, wms[S.SRC_CUSTOMERS], run_ts)))
        stg_b, stg_s, stg_c = staged["b"], staged["s"], staged["c"]

    # 4. watermarks (never back, kept when nothing was staged)
    with run.phase("watermarks"):
        run.put("pipeline_watermarks", W.advance(
            wm_table, {S.SRC_BILLING: stg_b, S.SRC_SESSIONS: stg_s, S.SRC_CUSTOMERS: stg_c}, run_ts))

    # 5. aggregates
    with run.phase("aggregates"):
        if mode == "additive":
            customers = stg_c
            aggs = _additive(run, store, stg_b, stg_s, stg_c, run_ts)
        elif mode == "recompute":
            customers, aggs, changed = _recompute(run, store, stg_b, stg_s, stg_c, load, run_ts)
            if report_late:
                _report_late(run, {"billing": b, "sessions": s}, day, wms, run_date)
            # a wide row can only change for customers touched or (re)loaded today,
            # so only those rows are built, handed off and merged
            customers = filter_by_keys(customers, changed, "customer_id", "left_semi", materialize=False)
            aggs = {t: filter_by_keys(df, changed, "customer_id", "left_semi", materialize=False)
                    for t, df in aggs.items()}
        else:
            raise ValueError(f"unknown mode {mode!r}")

    # 6. wide row per customer -> CSV -> warehouse staging -> guarded merge
    with run.phase("warehouse"):
        wide = H.user_analytics(customers, aggs["agg_user_revenue"], aggs["agg_user_usage"],
                                aggs["agg_arpu"], aggs["agg_session_distribution"], run_ts)
        export_dir = f"{export_root or store.root + '/exports'}/dw_user_analytics_{run_id}"
        export_csv(wide, export_dir)
        arrived = run.put("stg_user_analytics", import_csv(spark, export_dir, S.USER_ANALYTICS))
        U.assert_unique(arrived, ["customer_id"], "warehouse staging")
        guard_col = "row_hash" if guard == "attributes" else U.content_hash(H.CONTENT_COLUMNS)
        run.put("dw_user_analytics", U.merge_guarded(store.read("dw_user_analytics"), arrived,
                                                     "customer_id", guard_col, materialized=True))

    # 7. publish, then truncate the transient tables
    with run.phase("commit"):
        run.commit()
    return RunResult(run_id, customer_load=load, tables=run.tables, seconds=run.seconds)


def _additive(run: Run, store: TableStore, stg_b: DataFrame, stg_s: DataFrame, stg_c: DataFrame,
              run_ts: dt.datetime) -> dict[str, DataFrame]:
    """As originally written: today's staging is added onto the running totals.
    Each day's delta is staged first, so splitting the target by its keys does not
    compute it twice."""
    new = A.all_aggregates(stg_b, stg_s, stg_c, run_ts)

    def add(table: str, delta: DataFrame, keys: list[str], policy: str, **kw) -> DataFrame:
        d = store.stage(f"{table}_delta", delta)
        return run.put(table, U.upsert(store.read(table), d, keys, policy, materialized=True, unique=True, **kw))

    out = {"agg_user_revenue": add("agg_user_revenue", new["agg_user_revenue"], ["customer_id"], U.ADDITIVE),
           "agg_user_usage": add("agg_user_usage", new["agg_user_usage"], ["customer_id"], U.ADDITIVE)}
    monthly = add("agg_monthly_revenue", new["agg_monthly_revenue"], ["customer_id", "month"], U.ADDITIVE)
    out["agg_arpu"] = add("agg_arpu", A.arpu(monthly, run_ts), ["customer_id"], U.REPLACE)
    buckets = store.load("session_buckets", new["session_buckets"])  # empty before: every run ends with its truncation
    out["agg_session_distribution"] = add("agg_session_distribution", A.session_distribution(buckets, run_ts),
                                          ["customer_id"], U.ADDITIVE)
    return out


def merge_history(run: Run, table: str, delta: DataFrame, key: str, ts_col: str, order: list) -> tuple[DataFrame, DataFrame]:
    """Latest-wins merge of today's staged rows into a history partitioned by month.
    Only months that receive a row, or hold a row the delta replaces, are rewritten
    (dynamic partition overwrite), so the daily write is O(touched months), not
    O(history). Returns (the rows the delta's ids had before, the rows they have now)."""
    store = run.store
    month = F.date_format(ts_col, "yyyy-MM")
    old = store.read(table, partition=True)
    # which months hold an older row of a delta id: only the id column and the
    # partition of history are read for this, not whole rows
    hit = filter_by_keys(old.select(key, S.MONTH), delta, key, "left_semi", materialize=False)
    touched = store.stage(f"{table}_months", delta.select(month.alias(S.MONTH)).union(hit.select(S.MONTH)).distinct())
    # one short row a calendar month: the other months are pruned when the join runs
    before = old.join(F.broadcast(touched), S.MONTH, "left_semi").drop(S.MONTH)
    few = is_small(delta, [key])
    if few:
        replaced = store.stage(f"{table}_replaced", filter_by_keys(before, delta, key, "left_semi", materialize=False))
        merged = U.upsert_latest(before, delta, [key], order, materialized=True)
    else:  # one shuffle tells the old rows, the new ones and the winners apart
        met = store.stage(f"{table}_met", U.ranked(before, delta.select(*before.columns), [key], order).drop(U.SIDE, U.ALONE))
        of_delta = met.where(F.col(key).isNotNull() & (F.col(U.HIT) == 1))
        replaced = of_delta.where(F.col(U.NEW) == 0).select(*before.columns)
        merged = met.where(U.WINS).select(*before.columns)
    # the rebalance hint sizes the write tasks by bytes: a hot month is split over several
    now = run.put(table, merged.withColumn(S.MONTH, month).hint("rebalance", S.MONTH))
    lost = touched.join(now.select(S.MONTH).distinct(), S.MONTH, "left_anti").collect()  # rare: months without rows left
    run.emptied += [f"{table}/{r[0]}" for r in lost]
    if not few:
        return replaced, of_delta.where(F.col(U.RANK) == 1).select(*before.columns)
    return replaced, filter_by_keys(now.drop(S.MONTH), delta, key, "left_semi", materialize=False)


def accumulate(run: Run, table: str, keys: list[str], delta: DataFrame, count: str) -> DataFrame:
    """Next version of running totals after a signed delta; ids with no rows left drop out."""
    d = run.store.stage(f"{table}_delta", delta)
    total = U.upsert(run.store.read(table), d, keys, U.ADDITIVE, materialized=True, unique=True)
    return run.put(table, total.where(F.col(count) > 0))


def _report_late(run: Run, raw: dict[str, DataFrame], day: incremental.Day | None, wms: dict, run_date: dt.date) -> None:
    """Rows dated before the lookback window whose id was never loaded are not staged;
    they are reported instead of being dropped without a trace. Where the day of arrival
    is known, only new arrivals are looked at; else all older rows of the source are
    compared with every loaded key (ids and dates only are shuffled)."""
    store = run.store
    for table, k, key, ts_col, label, history in (
            ("late_billings", "billing", "transaction_id", "transaction_date", S.SRC_BILLING, "hist_billings"),
            ("late_sessions", "sessions", "session_id", "start_time", S.SRC_SESSIONS, "hist_sessions")):
        loaded = store.read(history).select(key)
        if day is not None:
            late = incremental.late_arrivals(store, day.rows[k], label, ts_col, wms[label], loaded)
        else:
            late = W.late_rows(raw[k].where(F.col("customer_id").isNotNull()), key, ts_col, wms[label], loaded)
        run.put(table, late.withColumn("run_date", F.lit(run_date)))


def _recompute(run: Run, store: TableStore, stg_b: DataFrame, stg_s: DataFrame, stg_c: DataFrame, load: str,
               run_ts: dt.datetime) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """Maintain the aggregates by signed deltas of what changed today.

    Running totals are kept per customer id over all history (``acc_*``, unknown
    ids included); a day adds, per id in the delta, minus its previous winning
    row plus its new one. The published aggregates are the totals of known
    customers, so a customer who arrives after their activity needs no history
    scan; nothing is counted twice. The shuffles carry the delta; the totals
    themselves are rewritten whole, as parquet has no update in place."""
    policy = U.REPLACE if load == "full" else U.INSERT_ONLY
    old_dim = store.read("dim_customers")
    dim = run.put("dim_customers", U.upsert(old_dim, stg_c, ["customer_id"], policy, materialized=True,
                                                   unique=True))
    merged = together(
        b=lambda: merge_history(run, "hist_billings", stg_b, "transaction_id", "transaction_date", G.billing_order()),
        s=lambda: merge_history(run, "hist_sessions", stg_s, "session_id", "start_time", G.session_order()))
    signed_b, signed_s = A.signed(*merged["b"]), A.signed(*merged["s"])

    acc = together(
        b=lambda: accumulate(run, "acc_billing", ["customer_id"], A.billing_delta(signed_b, run_ts), "total_transactions"),
        m=lambda: accumulate(run, "acc_monthly", ["customer_id", "month"], A.monthly_delta(signed_b, run_ts), "n_rows"),
        u=lambda: accumulate(run, "acc_usage", ["customer_id"], A.usage_delta(signed_s, run_ts), "total_sessions"))
    acc_b, acc_m, acc_u = acc["b"], acc["m"], acc["u"]

    def known(df: DataFrame) -> DataFrame:
        return df.join(dim.select("customer_id"), "customer_id", "left_semi")

    def monthly_and_arpu() -> tuple[DataFrame, DataFrame]:
        monthly = run.put("agg_monthly_revenue", known(acc_m).select(*S.AGG_MONTHLY_REVENUE.fieldNames()))
        return monthly, run.put("agg_arpu", A.arpu(monthly, run_ts))

    pub = together(
        rev=lambda: run.put("agg_user_revenue", known(acc_b).select(*S.AGG_USER_REVENUE.fieldNames())),
        mon=monthly_and_arpu,
        use=lambda: run.put("agg_user_usage", known(acc_u).select(*S.AGG_USER_USAGE.fieldNames())),
        dist=lambda: run.put("agg_session_distribution",
                             known(acc_u).select(*S.AGG_SESSION_DISTRIBUTION.fieldNames())),
        # today's sessions of known customers: the dimension is narrowed to today's
        # customer ids by a checked broadcast instead of being shuffled whole
        bk=lambda: store.load("session_buckets", A.session_buckets(
            stg_s, filter_by_keys(dim, stg_s, "customer_id", "left_semi", materialize=False), run_ts)))
    out = {"agg_user_revenue": pub["rev"], "agg_monthly_revenue": pub["mon"][0], "agg_arpu": pub["mon"][1],
           "agg_user_usage": pub["use"], "agg_session_distribution": pub["dist"]}
    # customers whose wide row may differ: totals moved today, or (re)loaded today
    changed = store.stage("changed_customers", (
        signed_b.select("customer_id").unionByName(signed_s.select("customer_id"))
        .unionByName(stg_c.select("customer_id")).distinct()))
    return dim, out, changed
