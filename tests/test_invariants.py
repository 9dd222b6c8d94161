"""Invariants that must hold whatever the input."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from meterwise.operators import upsert as U
from meterwise.plans.catalog import World


@pytest.fixture(scope="module")
def world(spark):
    return World(spark, SF_SMALL)


def _dups(df, keys):
    return df.groupBy(*keys).count().where("count > 1").count()


def test_keys_are_unique(world):
    assert _dups(world.stg_billings(), ["transaction_id"]) == 0
    assert _dups(world.stg_sessions(), ["session_id"]) == 0
    assert _dups(world.stg_customers(), ["customer_id"]) == 0
    aggs = world.aggregates(world.stg_billings(), world.stg_sessions(), world.stg_customers())
    assert _dups(aggs["agg_monthly_revenue"], ["customer_id", "month"]) == 0
    for t in ("agg_user_revenue", "agg_user_usage", "agg_arpu", "agg_session_distribution"):
        assert _dups(aggs[t], ["customer_id"]) == 0


def test_monthly_sums_to_revenue_and_buckets_sum_to_sessions(world):
    aggs = world.aggregates(world.stg_billings(), world.stg_sessions(), world.stg_customers())
    monthly = aggs["agg_monthly_revenue"].groupBy("customer_id").agg(F.sum("total_revenue").alias("m"))
    diff = aggs["agg_user_revenue"].join(monthly, "customer_id", "full_outer").where(
        F.col("m").isNull() | F.col("total_revenue").isNull() | (F.col("m") != F.col("total_revenue")))
    assert diff.count() == 0
    parts = aggs["agg_session_distribution"].join(aggs["agg_user_usage"], "customer_id").where(
        F.col("short_sessions") + F.col("medium_sessions") + F.col("long_sessions") != F.col("total_sessions"))
    assert parts.count() == 0


def test_wide_table_has_one_row_per_customer(world):
    wide = world.wide_full()
    assert wide.count() == world.stg_customers().count() == wide.select("customer_id").distinct().count()


def test_merge_is_idempotent(world):
    t, s = world.wide_run1(), world.wide_full()
    once = U.merge_guarded(t, s, "customer_id")
    twice = U.merge_guarded(once, s, "customer_id")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


rows = st.lists(st.tuples(st.integers(0, 6), st.integers(-5, 5)), max_size=8, unique_by=lambda r: r[0])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, delta=rows)
def test_upsert_policies(spark, target, delta):
    schema = "k bigint, v bigint, last_updated_at timestamp_ntz"
    import datetime as dt
    ts = dt.datetime(2025, 1, 1)
    t = spark.createDataFrame([(k, v, ts) for k, v in target], schema)
    d = spark.createDataFrame([(k, v, ts) for k, v in delta], schema)
    tgt, dl = dict(target), dict(delta)
    ins = {r.k: r.v for r in U.upsert(t, d, ["k"], U.INSERT_ONLY).collect()}
    assert ins == {**dl, **tgt}  # existing rows never change
    rep = {r.k: r.v for r in U.upsert(t, d, ["k"], U.REPLACE).collect()}
    assert rep == {**tgt, **dl}
    add = {r.k: r.v for r in U.upsert(t, d, ["k"], U.ADDITIVE).collect()}
    assert add == {k: tgt.get(k, 0) + dl.get(k, 0) for k in {**tgt, **dl}}


def test_assert_unique_raises(spark):
    df = spark.createDataFrame([(1, Decimal("1.00")), (1, Decimal("2.00"))], "k bigint, v decimal(18,2)")
    with pytest.raises(U.DuplicateKeyError):
        U.assert_unique(df, ["k"])


@pytest.mark.parametrize("policy", [U.INSERT_ONLY, U.REPLACE, U.ADDITIVE])
def test_upsert_refuses_a_repeated_delta_key(spark, policy):
    schema = "k bigint, v bigint"
    t, d = spark.createDataFrame([(1, 1)], schema), spark.createDataFrame([(2, 1), (2, 5)], schema)
    with pytest.raises(U.DuplicateKeyError):
        U.upsert(t, d, ["k"], policy, latest=None)
