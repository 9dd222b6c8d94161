"""Keyed writes whose keys are too many to broadcast: one shuffle, the same rows."""

import datetime as dt
from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterwise.operators import joins as J
from meterwise.operators import staging as G
from meterwise.operators import upsert as U
from meterwise.plans.daily import Run, merge_history
from meterwise.plans.inspect import plan_text
from meterwise.plans.tables import TableStore

TS = [dt.datetime(2025, 1, d) for d in range(1, 10)]


@contextmanager
def confs(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def both_ways(spark, fn):
    few = rows(fn())
    with confs(spark, **{J.MAX_BROADCAST_CONF: "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        many = rows(fn())
    return few, many


def tables(spark):
    schema = "k bigint, m bigint, v bigint, last_updated_at timestamp_ntz"
    t = [(1, 1, 10, TS[0]), (2, 1, 20, TS[1]), (2, 2, 21, TS[5]), (3, 1, 30, TS[2]), (3, 1, 31, TS[0]), (None, 1, 40, TS[0]), (None, 1, 41, TS[1])]
    d = [(2, 1, 200, TS[3]), (5, 1, 500, TS[0]), (1, 1, 100, TS[0]), (None, 1, 400, TS[4])]
    return spark.createDataFrame(t, schema), spark.createDataFrame(d, schema)


@pytest.mark.parametrize("policy", [U.INSERT_ONLY, U.REPLACE, U.ADDITIVE])
def test_policies(spark, policy):
    t, d = tables(spark)
    few, many = both_ways(spark, lambda: U.upsert(t, d, ["k", "m"], policy))
    assert few == many and len(few) > len(t.head(7)) - 1


def test_latest_and_guarded_merge(spark):
    t, d = tables(spark)
    few, many = both_ways(spark, lambda: U.upsert_latest(t, d, ["k"], [F.col("last_updated_at").desc(), F.col("v")]))
    assert few == many and sum(r[0] is None for r in few) == 3 and (2, 2, 21, TS[5]) in few and (3, 1, 31, TS[0]) in few
    few, many = both_ways(spark, lambda: U.merge_guarded(t, d.where("k <> 5"), "k", "v", materialized=True))
    assert few == many


def test_target_is_shuffled_once(spark):
    t, d = (J.materialize(df, "many") for df in tables(spark))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with confs(spark, **{J.MAX_BROADCAST_CONF: "1"} | off):
        for df in (U.upsert_latest(t, d, ["k"], [F.col("v")], materialized=True), U.upsert(t, d, ["k", "m"], U.ADDITIVE, materialized=True, unique=True)):
            assert plan_text(df).split("\n\n")[0].count("- Exchange (") == 1


def test_the_default_bound_keeps_key_sets_off_the_driver(spark):
    ids = J.materialize(spark.range(200_000), "ids")
    assert not J.is_small(ids, ["id"]) and J.is_small(J.materialize(spark.range(1000), "ids"), ["id"])


def test_history_merge(spark, workdir):
    def bill(k, amount, day):
        return (k, k % 3, amount, "USD", day, TS[0])
    schema = "transaction_id bigint, customer_id bigint, amount decimal(18,2), currency string, transaction_date timestamp_ntz, loaded_at timestamp_ntz"
    feb = dt.datetime(2025, 2, 3)
    days = [[bill(1, 1, TS[0]), bill(2, 2, TS[1]), bill(3, 3, feb)], [bill(2, 22, feb), bill(3, 30, TS[0]), bill(4, 4, TS[2]), bill(1, 11, TS[8])]]
    seen = []
    for n, bound in enumerate(("67108864", "1")):
        store = TableStore(spark, f"{workdir}/{n}")
        with confs(spark, **{J.MAX_BROADCAST_CONF: bound}):
            for day, new in enumerate(days):
                run = Run(store, f"day{day}")
                delta = store.stage("delta", spark.createDataFrame([(*r[:2], Decimal(r[2]), *r[3:]) for r in new], schema))
                replaced, winners = merge_history(run, "hist_billings", delta, "transaction_id", "transaction_date", G.billing_order())
                got = rows(replaced), rows(winners)
                run.commit()
            seen.append((*got, rows(store.read("hist_billings"))))
    assert seen[0] == seen[1] and len(seen[0][2]) == 4 and len(seen[0][0]) == 3
