"""Physical-plan shape: no all-pairs joins, no Python in the hot path, and the
operators the design relies on are really chosen by Catalyst."""

import pytest

from conftest import SF_SMALL
from meterwise.plans.inspect import plan_problems, plan_text


def _q(spark, key):
    from __spark_entry__ import queries
    return queries()[key](spark, SF_SMALL)


@pytest.mark.parametrize("key", ["dw_user_analytics", "dq_report", "quarantine_all", "dw_merge_row",
                                 "agg_user_revenue_recompute", "upsert_insert_only", "session_buckets_replace"])
def test_no_cartesian_or_python_nodes(spark, key):
    assert plan_problems(_q(spark, key)) == []


def test_dedup_is_a_partial_top1_window(spark):
    text = plan_text(_q(spark, "stg_billings_initial"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_semi_and_anti_joins_are_used(spark):
    # the repeated-key and orphan-id sets are materialized, counted, and broadcast
    # (they are small), so the source rows are filtered without a shuffle
    assert "BroadcastHashJoin LeftSemi" in plan_text(_q(spark, "quarantine_duplicate_identifier"))
    assert "BroadcastHashJoin LeftSemi" in plan_text(_q(spark, "quarantine_orphaned_customer_id"))
    assert "LeftAnti" in plan_text(_q(spark, "dq_referential_integrity"))


def test_key_sets_over_the_bound_are_not_broadcast(spark):
    from meterwise.operators.joins import MAX_BROADCAST_CONF
    # with Catalyst's own size-based broadcast off too, the join must fall back
    # to a shuffled semi join rather than broadcast an unchecked key set
    confs = {MAX_BROADCAST_CONF: "1", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = _q(spark, "quarantine_duplicate_identifier")
        df.collect()
        text = plan_text(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "BroadcastHashJoin LeftSemi" not in text and "LeftSemi" in text


def test_aggregation_is_partial_before_the_shuffle(spark):
    text = plan_text(_q(spark, "agg_user_revenue"))
    assert "HashAggregate" in text and "partial_sum" in text


def test_scans_are_pruned_and_filtered(spark):
    text = plan_text(_q(spark, "freshness_sessions"))
    # only the columns the query needs are read from the events table
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    text = plan_text(_q(spark, "src_billing"))
    assert "PushedFilters" in text


def _scans(df):
    import re
    return len(re.findall(r"^\(\d+\) Scan parquet", plan_text(df), flags=re.M))


def test_predicate_counts_share_one_scan_per_source(spark):
    # all four validity predicates are one aggregate per source: no extra scans
    # beyond the ones that define the two sources themselves
    assert _scans(_q(spark, "dq_validity")) == _scans(_q(spark, "src_billing")) + _scans(_q(spark, "src_sessions"))


def test_quarantine_has_no_outer_join_and_extended_one_pass(spark):
    text = plan_text(_q(spark, "quarantine_all"))
    assert "LeftOuter" not in text and "LeftSemi" in text
    one_pass = sum(_scans(_q(spark, k)) for k in ("src_billing", "src_sessions", "src_customers"))
    assert _scans(_q(spark, "quarantine_extended")) == one_pass


def test_session_distribution_aggregates_before_it_joins(spark):
    text = plan_text(_q(spark, "agg_session_distribution"))
    assert text.index("partial_count") > 0 and "LeftSemi" in text
