"""The store's catalog tables: defaults, partitions, buckets, truncation, re-attachment."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from meterwise import schemas as S
from meterwise.plans.inspect import plan_text
from meterwise.plans.tables import BUCKETS_CONF, TableStore

TS = dt.datetime(2025, 1, 1)


def test_init_tables_creates_empty_tables_once(spark, workdir):
    store = TableStore(spark, workdir)
    store.init_tables()
    store.init_tables()
    TableStore(spark, workdir).init_tables()
    assert store.read("agg_user_revenue").count() == 0
    for table, (schema, _, _) in S.TABLES.items():
        assert store.read(table).columns == schema.fieldNames()


def test_every_declared_default_is_used(spark, workdir):
    store = TableStore(spark, workdir)
    for table, defaults in S.DEFAULTS.items():
        schema = S.TABLES[table][0]
        given = [f for f in schema.fields if f.name not in defaults]
        part = S.PARTITIONS.get(table)
        row = spark.sql("SELECT " + ", ".join(
            ["array('x')" + f" AS {f.name}" if f.dataType.simpleString().startswith("array") else f"CAST(1 AS {f.dataType.simpleString()}) AS {f.name}"
             if f.dataType.simpleString() not in ("date", "timestamp_ntz") else f"CAST('2025-01-01' AS {f.dataType.simpleString()}) AS {f.name}"
             for f in given] + ([f"'a' AS {part}"] if part and part not in schema.fieldNames() else [])))
        store.insert(table, row)
        got = store.read(table).first()
        for column, default in defaults.items():
            if default == "0":
                assert got[column] == 0, (table, column)
            else:
                assert abs(got[column] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(hours=1), (table, column)


def test_truncate_empties_and_dynamic_overwrite_keeps_other_partitions(spark, workdir):
    store = TableStore(spark, workdir)
    rows = spark.createDataFrame([(1, 1, Decimal("1.00"), "NGN", TS, TS), (2, 1, Decimal("2.00"), "NGN", TS, TS)], S.STG_BILLINGS)
    assert store.load("stg_billings", rows).count() == 2
    store.truncate("stg_billings")
    assert store.read("stg_billings").count() == 0
    part = rows.selectExpr("*", f"CASE transaction_id WHEN 1 THEN 'a' ELSE 'b' END AS {S.MONTH}")
    with store.dynamic_overwrite():
        store.overwrite("hist_billings", part)
        store.overwrite("hist_billings", part.where("transaction_id = 2").selectExpr(
            "transaction_id + 10 AS transaction_id", *part.columns[1:]))
    assert sorted(r.transaction_id for r in store.read("hist_billings").collect()) == [1, 12]


def test_another_session_attaches_with_the_same_buckets(spark, workdir):
    """A new store over old files knows their partitions and their number of buckets,
    whatever the session's setting says."""
    spark.conf.set(BUCKETS_CONF, "3")
    try:
        store = TableStore(spark, workdir)
        store.overwrite("agg_arpu", spark.range(50).selectExpr("id AS customer_id", "CAST(id AS double) AS arpu", "CAST('2025-01-01' AS timestamp_ntz) AS last_updated_at"))
        with store.dynamic_overwrite():
            store.overwrite("dq_report", spark.createDataFrame([("a", "b", 1, TS.date())], S.DQ_HISTORY))
    finally:
        spark.conf.unset(BUCKETS_CONF)
    spark.sql(f"DROP DATABASE {store.database} CASCADE")  # external tables: the files stay
    other = TableStore(spark, workdir)
    assert other.buckets == 3 and other.read("agg_arpu").count() == 50 and other.read("dq_report").count() == 1
    assert other.read("agg_arpu").where("customer_id = 7").first().arpu == 7.0


def test_an_unreadable_layout_is_not_a_new_store(spark, workdir):
    import os
    TableStore(spark, workdir).init_tables()
    part = next(f for f in os.listdir(f"{workdir}/_layout") if f.startswith("part-"))
    with open(f"{workdir}/_layout/{part}", "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):
        TableStore(spark, workdir).read("dim_customers").collect()


def test_bucketed_wide_row_has_no_exchange(spark):
    from meterwise.plans.catalog import World, bucketed_wide
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        text = plan_text(bucketed_wide(World(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("SortMergeJoin LeftOuter") >= 4 and "SortMergeJoin LeftSemi" in text
    assert "Exchange" not in text


def test_watermark_subquery_prunes_the_landed_partitions(spark, workdir):
    from meterwise.operators import watermark as W
    from meterwise.operators.staging import stage_billings
    from meterwise.sources import fixtures, land, read_landed
    for by in (S.EVENT_DATE, S.EVENT_MONTH):
        land(fixtures.src_billing(spark, SF_SMALL), S.SRC_BILLING, f"{workdir}/{by}", by=by)
        landed = read_landed(spark, S.SRC_BILLING, f"{workdir}/{by}", by=by)
        marks = spark.createDataFrame([(S.SRC_BILLING, dt.datetime(2001, 7, 1), TS)], S.PIPELINE_WATERMARKS)
        staged = stage_billings(landed, W.value(marks, S.SRC_BILLING), TS)
        literal = stage_billings(fixtures.src_billing(spark, SF_SMALL), dt.datetime(2001, 7, 1), TS)
        assert staged.exceptAll(literal).count() == 0 == literal.exceptAll(staged).count()
        filters = next(x for x in plan_text(staged).splitlines() if "PartitionFilters" in x)
        assert by in filters and "subquery" in filters.lower()


def test_new_arrivals_prune_by_arrival_day(spark, workdir):
    from meterwise.plans import incremental
    from meterwise.sources import fixtures, land, read_landed
    store = TableStore(spark, f"{workdir}/state")
    for n, day in enumerate((dt.date(2025, 1, 5), dt.date(2025, 1, 6))):
        land(fixtures.src_billing(spark, SF_SMALL).where(f"transaction_id % 2 = {n}"), S.SRC_BILLING, f"{workdir}/b", day, by=S.EVENT_MONTH)
    store.overwrite("arrivals", spark.createDataFrame([(S.SRC_BILLING, dt.date(2025, 1, 5))], S.ARRIVALS))
    landed = read_landed(spark, S.SRC_BILLING, f"{workdir}/b", arrivals=True, by=S.EVENT_MONTH)
    new = incremental.new_rows(store, landed, S.SRC_BILLING)
    assert {r[0] for r in new.selectExpr("transaction_id % 2").distinct().collect()} == {1}
    filters = next(x for x in plan_text(new).splitlines() if "PartitionFilters" in x)
    assert S.ARRIVED in filters and "subquery" in filters.lower()
