"""Quality counts, quarantine and late rows of a day from the day's arrivals alone.

Landed sources carry the day a row arrived and the date (or month) it is about as
partitions. A day reads the partitions that arrived since the last
run (their bound is a scalar subquery in the scan's partition filter) and keeps, per
source, a narrow table of ids with their row counts:

* Predicate counts add up: yesterday's report plus the counts of the new rows, which
  are observed (``DataFrame.observe``) while those rows are set aside, so counting and
  capturing share one scan of a source.
* An id becomes a duplicate when its count passes from one to two. Only then the
  earlier row is fetched, from the one event partition the id table names.
* Orphans are kept as (customer_id, rows); a day adds its own unknown ids and drops
  those whose customer has arrived.
* A late row is a new arrival dated before the lookback whose id was never loaded;
  only such rows' ids are looked up in the history.

The results equal a count over all rows of the sources (``dq_report_arrivals``,
``quarantine_arrivals``, ``late_arrivals`` check that).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import parse_ts
from meterwise.operators import quality as Q
from meterwise.operators import quarantine as N
from meterwise.operators.joins import filter_by_keys
from meterwise.plans.tables import TableStore

IDS = {S.SRC_BILLING: "ids_billing", S.SRC_SESSIONS: "ids_sessions", S.SRC_CUSTOMERS: "ids_customers"}
LABELS = {"billing": (S.SRC_BILLING, S.Q_BILLING), "sessions": (S.SRC_SESSIONS, S.Q_SESSIONS),
          "customers": (S.SRC_CUSTOMERS, S.Q_CUSTOMERS)}
BEFORE_ALL = dt.date(1900, 1, 1)


def is_landed(sources: dict[str, DataFrame]) -> bool:
    return all(S.ARRIVED in df.columns for df in sources.values())


def event_partition(src: DataFrame) -> str:
    return S.EVENT_DATE if S.EVENT_DATE in src.columns else S.EVENT_MONTH


def last_arrival(store: TableStore, label: str) -> Column:
    """The newest arrival day that a finished run has read, as a scalar subquery."""
    row = store.read("arrivals").where(F.col("source_table") == label).agg(F.max(S.ARRIVED))
    return F.coalesce(row.scalar(), F.lit(BEFORE_ALL))


def new_rows(store: TableStore, src: DataFrame, label: str) -> DataFrame:
    return src.where(F.col(S.ARRIVED) > last_arrival(store, label))


@dataclass
class Day:
    """What a day's arrivals hold, set aside."""
    rows: dict[str, DataFrame]          # source key -> new rows with their partitions
    counts: dict[tuple[str, str], int]  # (source, check) -> rows of the new ones that fail it


def _checks() -> dict[str, dict[str, Column]]:
    """Every check on a row itself, by source."""
    none: dict = {}
    both = [Q.completeness_checks(none, none, none), Q.validity_checks(none, none)]
    return {label: {k: p for part in both if label in part for k, p in part[label][1].items()} for label in IDS}


def set_aside(store: TableStore, sources: dict[str, DataFrame]) -> Day:
    """Copy the new rows of every source once, observing the counts on the way."""
    rows, counts = {}, {}
    for key, (label, _) in LABELS.items():
        seen = Observation(f"checks_{key}")
        checks = _checks()[label]
        new = new_rows(store, sources[key], label).observe(seen, *[F.count_if(p).alias(c) for c, p in checks.items()])
        rows[key] = store.stage(f"new_{key}", new)
        counts |= {(label, c): n for c, n in seen.get.items()}
    return Day(rows, counts)


def probe_ids(store: TableStore, new: DataFrame, label: str) -> DataFrame:
    """The new rows' ids: (id, n new rows, n_before, the earlier row's date, the new rows'
    least date). The stored ids are read narrow and bucketed by id: within the broadcast
    bound of the day's ids nothing of them is shuffled, beyond it they are not either."""
    key = Q.KEYS[label]
    day = store.stage(f"day_{IDS[label]}", new.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.count("*").alias("n"), F.min(event_partition(new)).alias("event_date")))
    before = filter_by_keys(store.read(IDS[label]), day, "id", "left_semi", materialize=False).groupBy("id").agg(
        F.sum("n").alias("n_before"), F.max("event_date").alias("earlier_date"))
    return store.stage(f"probe_{IDS[label]}", day.join(before, "id", "left").withColumn("n_before", F.coalesce("n_before", F.lit(0))))


def earlier_rows(store: TableStore, src: DataFrame, label: str, probed: DataFrame) -> DataFrame:
    """The one earlier row of each id that has just become a duplicate, from the event
    dates that the id table names (a few dates; rows without a date lie in one partition)."""
    crossing = store.stage(f"crossing_{IDS[label]}", probed.where("n_before = 1"))
    old = src.where(F.col(S.ARRIVED) <= last_arrival(store, label))
    part = event_partition(src)
    dates = crossing.select(F.col("earlier_date").alias(part)).where(F.col(part).isNotNull()).distinct()
    dated = old.join(F.broadcast(dates), part, "left_semi").select(*old.columns)  # at most one row a calendar day
    undated = old.where(F.col(part).isNull())
    key = Q.KEYS[label]
    return filter_by_keys(dated.unionByName(undated), crossing.select(F.col("id").alias(key)), key, "left_semi", materialize=False)


def orphans(store: TableStore, day: Day, customers: DataFrame) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per activity source: (all orphan ids with their rows now, those among the new rows).
    ``customers``: the ids that arrived today."""
    out = {}
    for key in ("billing", "sessions"):
        label = LABELS[key][0]
        mine = day.rows[key].where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count("*").alias("n"))
        mine = store.stage(f"day_customers_{key}", mine)
        stored = store.read("orphan_counts").where(F.col("source_table") == label).select("customer_id", "n")
        may = store.stage(f"may_be_orphans_{key}", stored.unionByName(mine).groupBy("customer_id").agg(F.sum("n").alias("n")))
        ids = store.read(IDS[S.SRC_CUSTOMERS]).select(F.col("id").alias("customer_id")).unionByName(customers)
        known = filter_by_keys(ids, may, "customer_id", "left_semi", materialize=False).distinct()
        now = store.stage(f"orphans_{key}", may.join(known, "customer_id", "left_anti"))
        out[key] = (now, filter_by_keys(mine, now, "customer_id", "left_semi", materialize=False))
    return out


def quality_day(run, sources: dict[str, DataFrame], run_date: dt.date, run_ts: dt.datetime,
                extended: bool = False) -> tuple[Day, DataFrame]:
    """Prepare the day's report and the id, orphan and arrival tables of ``run``.
    Returns the new rows and what of them (and of earlier rows) goes to quarantine."""
    store: TableStore = run.store
    day = set_aside(store, sources)
    probed = {key: probe_ids(store, day.rows[key], label) for key, (label, _) in LABELS.items()}
    arrived = probed["customers"].select(F.col("id").alias("customer_id"))
    lost = orphans(store, day, arrived)

    # the report: a few numbers, added up here
    before = {(r.source_table, r.check_type): r.faulty_rows for r in store.read("dq_report").where(
        F.col("run_date") == store.read("dq_report").agg(F.max("run_date")).scalar()).collect()}
    total = {k: before.get(k, 0) + n for k, n in day.counts.items()}
    for key, (label, _) in LABELS.items():
        fresh = probed[key].where("n_before <= 1 AND n + n_before > 1").count()
        null = (label, S.NULL_IDENTIFIER)  # rows without an id are one more repeated group, from the second on
        null_group = (total[null] > 1) - (before.get(null, 0) > 1)
        total[label, S.DUPLICATE_IDENTIFIER] = before.get((label, S.DUPLICATE_IDENTIFIER), 0) + fresh + null_group
    for key, (now, _) in lost.items():
        total[LABELS[key][0], S.ORPHANED_CUSTOMER_ID] = now.agg(F.sum("n")).first()[0] or 0
    report = store.spark.createDataFrame([(s, c, n, run_date) for (s, c), n in sorted(total.items())], S.DQ_HISTORY)
    run.put("dq_report", report)

    # what the next day starts from
    for key, (label, _) in LABELS.items():
        run.put(IDS[label], probed[key].select("id", "n", "event_date").withColumn("run_date", F.lit(run_date)))
    both = [now.withColumn("source_table", F.lit(LABELS[key][0])) for key, (now, _) in lost.items()]
    run.put("orphan_counts", both[0].unionByName(both[1]))
    newest = [rows.agg(F.max(S.ARRIVED).alias(S.ARRIVED)).select(F.lit(LABELS[key][0]).alias("source_table"), S.ARRIVED)
              for key, rows in day.rows.items()]
    seen = newest[0].unionByName(newest[1]).unionByName(newest[2]).unionByName(store.read("arrivals"))
    run.put("arrivals", seen.groupBy("source_table").agg(F.max(S.ARRIVED).alias(S.ARRIVED)).where(f"{S.ARRIVED} IS NOT NULL"))

    parts = []
    for key, (label, name) in LABELS.items():
        cols = [c for c in sources[key].columns if c not in (*S.LANDED, S.MALFORMED_COLUMN)]
        new, id_col = day.rows[key], Q.KEYS[label]
        parts.append(N.capture_pass(new, name, N.row_checks(label, extended), run_ts, cols))
        twice = probed[key].where("n + n_before > 1").select(F.col("id").alias(id_col))
        rows = filter_by_keys(new, twice, id_col, "left_semi", materialize=False).select(*cols)
        rows = rows.unionByName(earlier_rows(store, sources[key], label, probed[key]).select(*cols))
        parts.append(N.capture(rows, name, S.DUPLICATE_IDENTIFIER, run_ts))
        if key in lost:
            parts.append(N.capture(filter_by_keys(new, lost[key][1], "customer_id", "left_semi", materialize=False).select(*cols),
                                   name, S.ORPHANED_CUSTOMER_ID, run_ts))
    captured = parts[0]
    for p in parts[1:]:
        captured = captured.unionByName(p)
    return day, captured


def late_arrivals(store: TableStore, new: DataFrame, label: str, ts_col: str, watermark: Column, loaded: DataFrame,
                  lookback: dt.timedelta = S.LOOKBACK) -> DataFrame:
    """New rows dated at or before the lookback whose id was never loaded. Only their
    own ids are looked up among ``loaded``."""
    key = Q.KEYS[label]
    bound = watermark - F.lit(lookback)
    old = store.stage(f"late_{label}", new.where(
        F.col(key).isNotNull() & F.col("customer_id").isNotNull() & (F.col(event_partition(new)) <= F.to_date(bound)) & (parse_ts(ts_col) <= bound)))
    known = filter_by_keys(loaded.select(key), old, key, "left_semi", materialize=False)
    return old.join(known, key, "left_anti").select(*old.columns)
