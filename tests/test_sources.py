"""Source readers and writers, and the streaming load."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from meterwise import schemas as S
from meterwise.plans.tables import TableStore
from meterwise.sources import fixtures, read_source
from meterwise.sources.io import export_csv, import_csv
from meterwise.streaming.activity_stream import BILLING, batch_writer, run_stream


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_source_roundtrip_keeps_nulls_spaces_and_decimals(spark, workdir):
    src = fixtures.src_billing(spark, SF_SMALL)
    export_csv(src, f"{workdir}/billing")
    back = read_source(spark, S.SRC_BILLING, f"{workdir}/billing", fmt="csv", nullValue="\\N")
    assert back.where("_malformed IS NOT NULL").collect() == []
    back = back.drop("_malformed")
    assert back.schema == S.SRC_BILLING_SCHEMA
    assert _same(src, back)
    assert back.where("currency = ' ngn '").count() > 0 and back.where("currency IS NULL").count() > 0


def test_csv_export_keeps_empty_string_apart_from_null_and_microseconds(spark, workdir):
    schema = "a string, t timestamp_ntz"
    df = spark.createDataFrame([("", dt.datetime(2024, 1, 1, 0, 0, 7, 179575)), (None, None)], schema)
    export_csv(df, f"{workdir}/x")
    back = import_csv(spark, f"{workdir}/x", df.schema)
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_parquet_source_reader_uses_declared_schema(spark, workdir):
    src = fixtures.src_sessions(spark, SF_SMALL)
    src.write.parquet(f"{workdir}/sessions")
    back = read_source(spark, S.SRC_SESSIONS, f"{workdir}/sessions")
    assert back.schema == S.SRC_SESSIONS_SCHEMA and _same(src, back)


def _batch(spark, *rows):
    return spark.createDataFrame(rows, S.SRC_BILLING_SCHEMA)


def test_stream_batch_replay_is_skipped_and_a_new_stream_is_not(spark, workdir):
    store = TableStore(spark, workdir)
    write = batch_writer(store, BILLING, "one", dt.datetime(2025, 1, 1))
    write(_batch(spark, (1, 7, Decimal("10.00"), "NGN", "2025-01-01 00:00:00"), (1, 7, Decimal("12.00"), "NGN", "2025-01-02 00:00:00")), 0)
    later = _batch(spark, (1, 7, Decimal("99.00"), "NGN", "2025-01-01 12:00:00"))
    write(later, 0)   # replay of batch 0 after a restart: ignored
    write(later, 1)   # an older version arriving later never wins
    assert [(r.transaction_id, r.amount) for r in store.read("hist_billings").collect()] == [(1, Decimal("12.00"))]
    wm = {r.source_table: r.last_processed for r in store.read("pipeline_watermarks").collect()}
    assert wm[S.SRC_BILLING] == dt.datetime(2025, 1, 2)
    # batch 0 of another stream is another batch
    batch_writer(store, BILLING, "two", dt.datetime(2025, 1, 1))(_batch(spark, (2, 8, Decimal("5.00"), "NGN", "2025-01-02 00:00:00")), 0)
    assert sorted(r.transaction_id for r in store.read("hist_billings").collect()) == [1, 2]
    assert {r.customer_id: r.total_revenue for r in store.read("acc_billing").collect()} == {7: Decimal("12.00"), 8: Decimal("5.00")}


def test_a_lost_checkpoint_loses_no_rows(spark, workdir):
    store, run_ts = TableStore(spark, f"{workdir}/state"), dt.datetime(2025, 1, 1)
    landing = f"{workdir}/landing"
    _batch(spark, (1, 7, Decimal("1.00"), "NGN", "2025-01-01 00:00:00")).write.mode("append").parquet(landing)
    run_stream(spark, BILLING, landing, store, f"{workdir}/checkpoint-1", run_ts)
    _batch(spark, (2, 7, Decimal("2.00"), "NGN", "2025-01-02 00:00:00")).write.mode("append").parquet(landing)
    run_stream(spark, BILLING, landing, store, f"{workdir}/checkpoint-2", run_ts)  # the first one was lost
    assert sorted(r.transaction_id for r in store.read("hist_billings").collect()) == [1, 2]
    assert [r.total_revenue for r in store.read("acc_billing").collect()] == [Decimal("3.00")]
    _batch(spark, (3, 7, Decimal("4.00"), "NGN", "2025-01-03 00:00:00")).write.mode("append").parquet(landing)
    run_stream(spark, BILLING, landing, store, f"{workdir}/checkpoint-2", run_ts)
    assert [r.total_revenue for r in store.read("acc_billing").collect()] == [Decimal("7.00")]


@pytest.mark.parametrize("text", ["two\nlines", "cr\rlf\r\n", "\\N", "\\", "\\n is no break", 'a "quoted" one', "a,b", "", None, " spaces ",
                                  "\\\\n", "end\\", '"', "\\\n", "é\u2028x"])
def test_csv_keeps_any_text(spark, workdir, text):
    df = spark.createDataFrame([(1, text, text), (2, "x", None)], "k long, a string, b string")
    export_csv(df, f"{workdir}/x")
    assert sorted(import_csv(spark, f"{workdir}/x", df.schema).collect()) == sorted(df.collect())


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from meterwise import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_freshness_prunes_a_landed_source(spark, workdir):
    from meterwise.operators.quality import fresh_rows
    from meterwise.plans.inspect import plan_text
    from meterwise.sources import land, read_landed
    land(fixtures.src_billing(spark, SF_SMALL), S.SRC_BILLING, f"{workdir}/landed")
    text = plan_text(fresh_rows(read_landed(spark, S.SRC_BILLING, f"{workdir}/landed"), "transaction_date", dt.date(2001, 7, 1)))
    assert "PartitionFilters: [isnotnull(event_date" in text and "= 2001-07-01" in text


def test_landed_source_prunes_partitions_and_stages_the_same(spark, workdir):
    import datetime as dt
    from meterwise.operators.staging import stage_billings
    from meterwise.plans.inspect import plan_text
    from meterwise.sources import land, read_landed
    src = fixtures.src_billing(spark, SF_SMALL)
    land(src, S.SRC_BILLING, f"{workdir}/landed")
    landed = read_landed(spark, S.SRC_BILLING, f"{workdir}/landed")
    assert _same(landed.drop("event_date"), src)
    wm, ts = dt.datetime(2001, 7, 1), dt.datetime(2025, 1, 1)
    a, b = stage_billings(landed, wm, ts), stage_billings(src, wm, ts)
    assert _same(a, b) and a.count() > 0
    text = plan_text(a)
    # the exact timestamp filter implies a date bound that prunes whole partitions
    assert "PartitionFilters: [isnotnull(event_date" in text and ">= 2001-06-28)]" in text


def test_a_csv_file_is_read_in_splits(spark, workdir):
    src = fixtures.src_billing(spark, SF_SMALL)
    src.coalesce(1).write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false").csv(f"{workdir}/billing")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        back = read_source(spark, S.SRC_BILLING, f"{workdir}/billing", fmt="csv")
        from pyspark.sql import functions as F
        assert back.select(F.spark_partition_id()).distinct().count() > 2
        assert _same(src, back.drop("_malformed"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_first_copies_survive_a_restart_and_drop_late_rows(spark, workdir):
    from meterwise.sources import land
    from meterwise.streaming.activity_stream import STATE_STORE_CONF, first_copies
    args = (spark, BILLING, f"{workdir}/landed", f"{workdir}/first", f"{workdir}/checkpoint")

    def arrive(day, *rows):
        land(_batch(spark, *rows), S.SRC_BILLING, f"{workdir}/landed", dt.date(2025, 1, day))
        first_copies(*args)
        return sorted((r.transaction_id, r.arrived_on.day) for r in spark.read.parquet(f"{workdir}/first").collect())
    one = Decimal("1.00")
    assert arrive(1, (1, 7, one, "NGN", "2025-01-10 00:00:00"), (1, 7, one, "NGN", "2025-01-10 00:00:00"), (2, 7, one, "NGN", "2025-01-08 00:00:00"),
                  (3, None, one, "NGN", "2025-01-10 00:00:00"), (4, 7, one, "NGN", "no date")) == [(1, 1), (2, 1)]
    # a new query from the checkpoint: 1 is known, 5 lies on the bound of three days, 6 just inside
    assert arrive(2, (1, 7, one, "NGN", "2025-01-11 00:00:00"), (5, 7, one, "NGN", "2025-01-07 00:00:00"),
                  (6, 7, one, "NGN", "2025-01-07 00:00:00.000001")) == [(1, 1), (2, 1), (6, 2)]
    assert spark.conf.get(STATE_STORE_CONF, "").endswith("RocksDBStateStoreProvider") is False


def test_records_are_read_as_variants(spark):
    from meterwise.operators.quarantine import faulty_amounts
    rows = [('{"transaction_id":1,"amount":-2.50}', "b", "x"), ('{"transaction_id":2,"amount":null}', "b", "x"), ('{"name":"n"}', "c", "y"),
            ("no json", "c", "y"), (None, "c", "z")]
    got = {(r.source, r.check_type): tuple(r)[2:] for r in faulty_amounts(spark.createDataFrame(rows, "record string, source string, check_type string")).collect()}
    assert got == {("b", "x"): (2, 1, 1, Decimal("-2.50")), ("c", "y"): (2, 0, 2, None), ("c", "z"): (1, 0, 1, None)}
