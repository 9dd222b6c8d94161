"""Multi-day sequences of the daily run on hand-written sources."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.operators.quality import StaleSourceError
from meterwise.plans.daily import run_daily
from meterwise.plans.tables import TableStore

RUN_TS = dt.datetime(2025, 1, 10)
SUN, MON, TUE = dt.date(2025, 1, 5), dt.date(2025, 1, 6), dt.date(2025, 1, 7)

CUSTOMERS = [
    (1, "o'neil mary-jane", "A@X.COM", "Ghana", "2024-12-01 00:00:00"),
    (2, "bob", None, None, "2024-12-15 00:00:00"),
]
BILLING_DAY1 = [
    (10, 1, Decimal("100.00"), " ngn ", "2025-01-04 10:00:00"),
    (11, 1, Decimal("50.00"), "Naira", "2025-01-05 09:00:00"),
    (12, 2, None, None, "2025-01-05 12:00:00"),
    (13, 99, Decimal("5.00"), "USD", "2025-01-05 13:00:00"),       # orphan
    (None, 1, Decimal("1.00"), "NGN", "2025-01-05 14:00:00"),      # null id
]
SESSIONS_DAY1 = [
    (100, 1, "2025-01-05 10:00:00", "2025-01-05 10:00:30", Decimal("1.50")),
    (101, 2, "2025-01-05 11:00:00", "2025-01-05 11:03:00", Decimal("2.00")),
    (102, 2, "2025-01-05 12:00:00", "2025-01-05 11:00:00", None),  # clock skew
]
SESSIONS_DAY2 = SESSIONS_DAY1 + [(103, 1, "2025-01-06 09:00:00", "2025-01-06 09:00:10", Decimal("0.50"))]


def _sources(spark, billing, sessions=SESSIONS_DAY1, customers=CUSTOMERS):
    return {"billing": spark.createDataFrame(billing, S.SRC_BILLING_SCHEMA),
            "sessions": spark.createDataFrame(sessions, S.SRC_SESSIONS_SCHEMA),
            "customers": spark.createDataFrame(customers, S.SRC_CUSTOMERS_SCHEMA)}


def _rev(store):
    return {r.customer_id: (r.total_revenue, r.total_transactions)
            for r in store.read("agg_user_revenue").collect()}


def _snapshot(store, tables):
    return {t: sorted(map(tuple, store.read(t).drop("last_updated_at", "loaded_at", "detected_at").collect()),
                      key=repr) for t in tables}


def test_first_run_builds_everything(spark, workdir):
    store = TableStore(spark, workdir)
    res = run_daily(spark, store, _sources(spark, BILLING_DAY1), SUN, RUN_TS)
    assert res.customer_load == "full"
    assert _rev(store) == {1: (Decimal("150.00"), 2), 2: (Decimal("0.00"), 1)}
    dw = {r.customer_id: r for r in store.read("dw_user_analytics").collect()}
    assert dw[1].customer_name == "O'Neil Mary-Jane" and dw[1].email == "a@x.com"
    assert dw[2].country == "Nigeria" and dw[2].short_sessions == 1 and dw[2].medium_sessions == 1
    assert dw[2].avg_session_duration_sec == 90.0
    wm = {r.source_table: r.last_processed for r in store.read("pipeline_watermarks").collect()}
    assert wm[S.SRC_BILLING] == dt.datetime(2025, 1, 5, 13)
    assert store.read("stg_billings").count() == 0  # truncated after success
    checks = {(r.source_table, r.check_type): r.faulty_rows for r in store.read("dq_report").collect()}
    assert len(checks) == 15 and checks[(S.SRC_BILLING, "orphaned_customer_id")] == 1
    q = store.read("quarantine_records")
    assert q.where(F.col("check_type") == "invalid_session_times").count() == 1


def test_same_run_twice_is_skipped_and_repeat_changes_nothing(spark, workdir):
    store = TableStore(spark, workdir)
    src = _sources(spark, BILLING_DAY1)
    run_daily(spark, store, src, SUN, RUN_TS)
    tables = ["agg_user_revenue", "agg_user_usage", "agg_monthly_revenue", "agg_arpu",
              "agg_session_distribution", "quarantine_records", "dw_user_analytics"]
    before = _snapshot(store, tables)
    assert run_daily(spark, store, src, SUN, RUN_TS).skipped
    run_daily(spark, store, src, MON, RUN_TS, check_fresh=False)  # same data, next day
    assert _snapshot(store, tables) == before


def test_additive_double_counts_inside_lookback_recompute_does_not(spark, workdir):
    day2 = BILLING_DAY1 + [(14, 1, Decimal("7.00"), "NGN", "2025-01-06 08:00:00")]
    results = {}
    for mode in ("additive", "recompute"):
        store = TableStore(spark, f"{workdir}/{mode}")
        run_daily(spark, store, _sources(spark, BILLING_DAY1), SUN, RUN_TS, mode=mode)
        # next Sunday (full customer load), so the as-written form sees every customer
        run_daily(spark, store, _sources(spark, day2), dt.date(2025, 1, 12), RUN_TS, mode=mode,
                  check_fresh=False)
        results[mode] = _rev(store)
    # the additive form re-reads the last 3 days and adds them again
    assert results["additive"][1] == (Decimal("307.00"), 5)
    assert results["recompute"][1] == (Decimal("157.00"), 3)


def test_late_rows_inside_and_outside_lookback(spark, workdir):
    store = TableStore(spark, workdir)
    run_daily(spark, store, _sources(spark, BILLING_DAY1), SUN, RUN_TS)
    late = BILLING_DAY1 + [(20, 1, Decimal("3.00"), "NGN", "2025-01-03 00:00:01"),   # inside 3 days
                           (21, 1, Decimal("4.00"), "NGN", "2025-01-02 00:00:00"),   # too late
                           (22, 2, Decimal("1.00"), "NGN", "2025-01-06 00:00:00")]
    old_session = (110, 1, "2025-01-01 00:00:00", "2025-01-01 00:01:00", Decimal("1.00"))
    run_daily(spark, store, _sources(spark, late, SESSIONS_DAY2 + [old_session]), MON, RUN_TS)
    assert _rev(store)[1] == (Decimal("153.00"), 3)
    assert [r.transaction_id for r in store.read("late_billings").collect()] == [21]
    assert [r.session_id for r in store.read("late_sessions").collect()] == [110]


def test_weekday_without_new_customers_keeps_watermark_and_activity(spark, workdir):
    results = {}
    day2 = BILLING_DAY1 + [(14, 1, Decimal("7.00"), "NGN", "2025-01-06 08:00:00")]
    for mode in ("additive", "recompute"):
        store = TableStore(spark, f"{workdir}/{mode}")
        run_daily(spark, store, _sources(spark, BILLING_DAY1), SUN, RUN_TS, mode=mode)
        wm1 = {r.source_table: r.last_processed for r in store.read("pipeline_watermarks").collect()}
        res = run_daily(spark, store, _sources(spark, day2, SESSIONS_DAY2), MON, RUN_TS, mode=mode)
        assert res.customer_load == "incremental"
        wm2 = {r.source_table: r.last_processed for r in store.read("pipeline_watermarks").collect()}
        assert wm2[S.SRC_CUSTOMERS] == wm1[S.SRC_CUSTOMERS] == dt.datetime(2024, 12, 15)
        assert wm2[S.SRC_BILLING] == dt.datetime(2025, 1, 6, 8)
        results[mode] = _rev(store)
    # as written, Monday's staging holds no customers, so Monday's activity is dropped
    assert results["additive"][1] == (Decimal("150.00"), 2)
    assert results["recompute"][1] == (Decimal("157.00"), 3)


def test_metric_only_change_updates_only_with_row_guard(spark, workdir):
    day2 = BILLING_DAY1 + [(14, 1, Decimal("7.00"), "NGN", "2025-01-06 08:00:00")]
    got = {}
    for guard in ("attributes", "row"):
        store = TableStore(spark, f"{workdir}/{guard}")
        run_daily(spark, store, _sources(spark, BILLING_DAY1), SUN, RUN_TS, guard=guard)
        run_daily(spark, store, _sources(spark, day2, SESSIONS_DAY2), MON, RUN_TS, guard=guard)
        got[guard] = {r.customer_id: r.total_revenue for r in store.read("dw_user_analytics").collect()}
    assert got["attributes"][1] == 150.0
    assert got["row"][1] == 157.0


def test_freshness_gate_raises_and_writes_nothing(spark, workdir):
    store = TableStore(spark, workdir)
    with pytest.raises(StaleSourceError):
        run_daily(spark, store, _sources(spark, BILLING_DAY1), TUE, RUN_TS)
    assert not store.is_committed(TUE.isoformat()) and store.read("dim_customers").count() == 0


def test_daily_run_on_fixture_tables(spark, workdir):
    from meterwise.sources import sources
    store = TableStore(spark, workdir)
    src = sources(spark, "/root/testdata/sf0.001")
    run_daily(spark, store, src, dt.date(2001, 7, 1), RUN_TS, check_fresh=False)
    n_customers = store.read("dim_customers").count()
    assert store.read("dw_user_analytics").count() == n_customers > 0
    assert store.read("quarantine_records").count() > 0
    # second run over the same data: aggregates unchanged, quarantine adds nothing
    before = _snapshot(store, ["agg_user_revenue", "quarantine_records"])
    run_daily(spark, store, src, dt.date(2001, 7, 2), RUN_TS, check_fresh=False)
    assert _snapshot(store, ["agg_user_revenue", "quarantine_records"]) == before


def _files(workdir, table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{workdir}/{table}") for f in names if f.endswith(".parquet")}


def test_history_rewrites_only_touched_months(spark, workdir):
    store = TableStore(spark, workdir)
    rows = [(30, 2, Decimal("9.00"), "NGN", "2024-06-01 00:00:00"), (31, 2, Decimal("1.00"), "NGN", "2025-01-03 00:00:00"),
            (32, 1, Decimal("2.00"), "NGN", "2024-12-31 00:00:00")]
    run_daily(spark, store, _sources(spark, BILLING_DAY1 + rows), SUN, RUN_TS)
    first = _files(workdir, "hist_billings")
    assert {f.split("month_part=")[1][:7] for f in first} == {"2024-06", "2024-12", "2025-01"}
    # corrections move 11 into February and 32, December's only row, into January; June is not touched
    day2 = [r for r in BILLING_DAY1 if r[0] != 11] + rows[:2] + [
        (11, 1, Decimal("55.00"), "NGN", "2025-02-01 00:00:00"), (32, 1, Decimal("2.00"), "NGN", "2025-01-04 00:00:00"),
        (14, 1, Decimal("7.00"), "NGN", "2025-01-06 08:00:00")]
    run_daily(spark, store, _sources(spark, day2, SESSIONS_DAY2), MON, RUN_TS)
    second = _files(workdir, "hist_billings")
    assert {f: t for f, t in second.items() if "2024-06" in f} == {f: t for f, t in first.items() if "2024-06" in f}
    assert not set(first) & {f for f in second if "2025-01" in f}
    hist = {r.transaction_id: (r.amount, r.transaction_date.month) for r in store.read("hist_billings").collect()}
    assert hist[11] == (Decimal("55.00"), 2) and hist[30] == (Decimal("9.00"), 6) and hist[32] == (Decimal("2.00"), 1) and len(hist) == 8
    assert _rev(store)[1] == (Decimal("164.00"), 4)
    assert TableStore(spark, workdir).read("hist_billings").count() == 8


def test_signed_deltas_equal_a_full_rebuild(spark, workdir):
    from meterwise.operators import aggregates as A
    store = TableStore(spark, workdir)
    day1 = BILLING_DAY1 + [(40, 3, Decimal("8.00"), "NGN", "2025-01-05 15:00:00")]   # customer 3 unknown yet
    run_daily(spark, store, _sources(spark, day1), SUN, RUN_TS)
    assert 3 not in _rev(store)
    customers2 = CUSTOMERS + [(3, "carol", "c@x.com", "Kenya", "2025-01-06 00:00:00")]
    day2 = [r for r in day1 if r[0] != 10] + [
        (10, 2, Decimal("101.00"), "NGN", "2025-01-06 09:00:00"),     # correction moves 10 from 1 to 2
        (14, 1, Decimal("7.00"), "NGN", "2025-01-06 08:00:00")]
    sessions2 = SESSIONS_DAY2 + [(101, 2, "2025-01-05 11:00:00", "2025-01-05 11:10:00", Decimal("2.00"))]
    run_daily(spark, store, _sources(spark, day2, sessions2, customers2), MON, RUN_TS)
    run_daily(spark, store, _sources(spark, day2, sessions2, customers2), TUE, RUN_TS, check_fresh=False)
    dim = store.read("dim_customers")
    fresh = A.all_aggregates(store.read("hist_billings"), store.read("hist_sessions"), dim, RUN_TS)
    for t in ("agg_user_revenue", "agg_user_usage", "agg_monthly_revenue", "agg_arpu", "agg_session_distribution"):
        got = store.read(t).drop("last_updated_at")
        want = fresh[t].drop("last_updated_at")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, t
    rev = _rev(store)
    assert rev[3] == (Decimal("8.00"), 1) and rev[2] == (Decimal("101.00"), 2) and rev[1] == (Decimal("57.00"), 2)


def test_daily_run_on_landed_sources_matches_plain_sources(spark, workdir):
    from meterwise.sources import land, read_landed
    plain, landed = TableStore(spark, f"{workdir}/plain"), TableStore(spark, f"{workdir}/landed")
    src = _sources(spark, BILLING_DAY1)
    names = {"billing": S.SRC_BILLING, "sessions": S.SRC_SESSIONS, "customers": S.SRC_CUSTOMERS}
    for k, df in src.items():
        land(df, names[k], f"{workdir}/land/{k}")
    lsrc = {k: read_landed(spark, names[k], f"{workdir}/land/{k}") for k in src}
    run_daily(spark, plain, src, SUN, RUN_TS)
    run_daily(spark, landed, lsrc, SUN, RUN_TS)
    tables = ["quarantine_records", "agg_user_revenue", "agg_user_usage", "dw_user_analytics", "dq_report"]
    assert _snapshot(plain, tables) == _snapshot(landed, tables)


def test_lookback_bound_is_strict_and_zero_amount_is_valid(spark):
    from meterwise.operators.quality import validity
    from meterwise.operators.staging import stage_billings
    wm = dt.datetime(2025, 1, 10)
    rows = [(1, 1, Decimal("0.00"), "NGN", "2025-01-07 00:00:00"),          # exactly wm - 3 days: out
            (2, 1, Decimal("-0.01"), "NGN", "2025-01-07 00:00:00.000001"),  # just after: in
            (3, 1, None, "NGN", "2025-01-10 00:00:00")]
    src = spark.createDataFrame(rows, S.SRC_BILLING_SCHEMA)
    got = {r.transaction_id: r.amount for r in stage_billings(src, wm, RUN_TS).collect()}
    assert got == {2: Decimal("-0.01"), 3: Decimal("0.00")}
    counts = {r.check_type: r.faulty_rows for r in validity(src, spark.createDataFrame([], S.SRC_SESSIONS_SCHEMA))
              .where(F.col("source_table") == S.SRC_BILLING).collect()}
    assert counts["invalid_amount"] == 1  # negative only; zero is valid


def test_watermark_as_scalar_subquery_equals_literal(spark):
    from meterwise.operators import watermark as W
    from meterwise.operators.staging import stage_billings
    wm_table = spark.createDataFrame([(S.SRC_BILLING, dt.datetime(2025, 1, 5), RUN_TS)], S.PIPELINE_WATERMARKS)
    src = spark.createDataFrame(BILLING_DAY1 + [(50, 1, Decimal("1.00"), "NGN", "2025-01-01 00:00:00")],
                                S.SRC_BILLING_SCHEMA)
    by_subquery = stage_billings(src, W.value(wm_table, S.SRC_BILLING), RUN_TS)
    by_literal = stage_billings(src, W.current(wm_table)[S.SRC_BILLING], RUN_TS)
    assert sorted(map(tuple, by_subquery.collect())) == sorted(map(tuple, by_literal.collect()))
    assert 50 not in {r.transaction_id for r in by_subquery.collect()}


def test_command_line_daily_run(spark, workdir):
    from meterwise.cli import main
    from meterwise.sources import sources
    src = sources(spark, "/root/testdata/sf0.001")
    for k, df in src.items():
        df.write.parquet(f"{workdir}/src/{k}")
    args = ["daily", "--state", f"{workdir}/state", "--billing", f"{workdir}/src/billing",
            "--sessions", f"{workdir}/src/sessions", "--customers", f"{workdir}/src/customers",
            "--run-date", "2001-07-01", "--run-ts", "2025-01-01T00:00:00", "--no-freshness"]
    out = main(args)
    assert out["customer_load"] == "full" and not out["skipped"]
    assert main(args)["skipped"]
    store = TableStore(spark, f"{workdir}/state")
    assert store.read("dw_user_analytics").count() == store.read("dim_customers").count() > 0


def test_timestamps_of_two_days(spark, workdir):
    """What a later run touches carries its time; the rest keeps the first one."""
    later = RUN_TS + dt.timedelta(days=7)
    store = TableStore(spark, workdir)
    day1 = BILLING_DAY1 + [(None, 2, Decimal("2.00"), "NGN", "2025-01-05 01:00:00")]
    run_daily(spark, store, _sources(spark, day1), SUN, RUN_TS)
    day2 = day1 + [(14, 1, Decimal("7.00"), "NGN", "2025-01-06 08:00:00"), (None, 1, Decimal("3.00"), "NGN", "2025-01-06 02:00:00")]
    run_daily(spark, store, _sources(spark, day2, SESSIONS_DAY2), MON, later)
    dw = {r.customer_id: r.last_updated_at for r in store.read("dw_user_analytics").collect()}
    assert dw == {1: later, 2: RUN_TS}
    found = store.read("quarantine_records").where("check_type = 'null_identifier' AND source = 'billing_transactions'").collect()
    assert sorted((r.detected_at, "2025-01-06" in r.record) for r in found) == [(RUN_TS, False)] * 2 + [(later, True)]


TABLES = ["agg_user_revenue", "agg_user_usage", "agg_monthly_revenue", "agg_arpu", "agg_session_distribution", "dim_customers",
          "acc_billing", "hist_billings", "hist_sessions", "quarantine_records", "dq_report", "dw_user_analytics", "pipeline_watermarks"]


@pytest.mark.parametrize("phase, table", [("prepare", "dw_user_analytics"), ("overwrite", "agg_arpu"), ("truncate", None)])
def test_a_run_that_died_is_finished_by_the_next_call(spark, workdir, monkeypatch, phase, table):
    """Whether it died while preparing, while publishing or after it: what the next
    call leaves is what an undisturbed run leaves."""
    day2 = [r for r in BILLING_DAY1 if r[0] != 10] + [(10, 2, Decimal("101.00"), "NGN", "2025-01-06 09:00:00")]
    calm, hit = TableStore(spark, f"{workdir}/calm"), TableStore(spark, f"{workdir}/hit")
    for store in (calm, hit):
        run_daily(spark, store, _sources(spark, BILLING_DAY1), SUN, RUN_TS)
    original = getattr(TableStore, phase)

    def dies(self, *args):
        if self.root.endswith("hit") and (table is None or args[0] == table):
            raise RuntimeError("the driver died")
        return original(self, *args)
    with monkeypatch.context() as m:
        m.setattr(TableStore, phase, dies)
        with pytest.raises(RuntimeError):
            run_daily(spark, hit, _sources(spark, day2, SESSIONS_DAY2), MON, RUN_TS)
    assert not hit.is_committed(MON.isoformat())
    again = TableStore(spark, f"{workdir}/hit")
    for store in (calm, again):
        run_daily(spark, store, _sources(spark, day2, SESSIONS_DAY2), MON, RUN_TS)
    assert again.is_committed(MON.isoformat()) and _snapshot(again, TABLES) == _snapshot(calm, TABLES)


def test_malformed_csv_lines_are_quarantined_and_the_run_completes(spark, workdir):
    from meterwise.sources import read_source
    for name, text in {
        "billing": "transaction_id,customer_id,amount,currency,transaction_date\n10,1,100.00,NGN,2025-01-04 10:00:00\n"
                   "11,1,abc,NGN,2025-01-05 09:00:00\n12,2,5.00,NGN,2025-01-05 12:00:00,extra\n",
        "sessions": "session_id,customer_id,start_time,end_time,data_used_mb\n100,1,2025-01-05 10:00:00,2025-01-05 10:00:30,1.50\n",
        "customers": 'customer_id,name,email,country,created_at\n1,"two\nlines",A@X.COM,Ghana,2024-12-01 00:00:00\n2,bob,,,2024-12-15 00:00:00\n',
    }.items():
        with open(f"{workdir}/{name}.csv", "w") as f:
            f.write(text)
    names = {"billing": S.SRC_BILLING, "sessions": S.SRC_SESSIONS, "customers": S.SRC_CUSTOMERS}
    src = {k: read_source(spark, n, f"{workdir}/{k}.csv", fmt="csv", multiLine=str(k == "customers").lower()) for k, n in names.items()}
    store = TableStore(spark, f"{workdir}/state")
    run_daily(spark, store, src, SUN, RUN_TS)
    bad = store.read("quarantine_records").where("check_type = 'malformed_record'").collect()
    assert sorted(r.record.count("abc") for r in bad) == [0, 1] and len(bad) == 2
    assert _rev(store) == {1: (Decimal("100.00"), 2), 2: (Decimal("5.00"), 1)}  # quarantine is a copy; the bad field is NULL
    assert {r.customer_name for r in store.read("dw_user_analytics").collect()} == {"Two\nLines", "Bob"}


def test_late_rows_of_new_arrivals(spark, workdir):
    """Where the day of arrival is known only new rows are looked at: an old row that
    is sent again is no late row, one whose id was never loaded is."""
    from meterwise.sources import land, read_landed
    names = {"billing": S.SRC_BILLING, "sessions": S.SRC_SESSIONS, "customers": S.SRC_CUSTOMERS}
    store = TableStore(spark, f"{workdir}/state")
    days = {SUN: (BILLING_DAY1, SESSIONS_DAY1, CUSTOMERS),
            MON: ([BILLING_DAY1[0], (21, 1, Decimal("4.00"), "NGN", "2025-01-02 00:00:00"), (22, 2, Decimal("1.00"), "NGN", "2025-01-06 00:00:00"),
                   (None, 1, Decimal("6.00"), "NGN", "2025-01-06 01:00:00"), (12, 2, Decimal("3.00"), "NGN", None)],
                  [SESSIONS_DAY2[-1]], [(99, "zoe", None, None, "2025-01-06 00:00:00")])}
    for day, rows in days.items():
        for (k, df) in _sources(spark, *rows).items():
            land(df, names[k], f"{workdir}/{k}", day)
        landed = {k: read_landed(spark, n, f"{workdir}/{k}", arrivals=True) for k, n in names.items()}
        run_daily(spark, store, landed, day, RUN_TS)
    assert [r.transaction_id for r in store.read("late_billings").collect()] == [21]
    last = {(r.source_table, r.check_type): r.faulty_rows for r in store.read("dq_report").where(F.col("run_date") == MON).collect()}
    assert last[S.SRC_BILLING, "duplicate_identifier"] == 3  # 10, 12, and the two rows without an id
    assert last[S.SRC_BILLING, "null_identifier"] == 2 and last[S.SRC_BILLING, "null_transaction_date"] == 1
    assert last[S.SRC_BILLING, "orphaned_customer_id"] == 0  # customer 99 has arrived
    found = store.read("quarantine_records").where("check_type = 'duplicate_identifier'").collect()
    assert len(found) == 3  # both rows of 12; the two equal rows of 10 are one record
