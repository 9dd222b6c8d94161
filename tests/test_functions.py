import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from meterwise import schemas as S
from meterwise.functions import (duration_sec, month_start, parse_ts, pg_initcap, record_hash, row_hash,
                                 row_json, session_bucket)


def test_initcap_starts_words_after_any_non_alphanumeric(spark):
    rows = spark.createDataFrame(
        [("o'neil mary-jane",), ("3RD école d'été",), ("",), (None,), ("ALL CAPS  two-spaces",)], "s string")
    got = [r[0] for r in rows.select(pg_initcap("s")).collect()]
    assert got == ["O'Neil Mary-Jane", "3rd École D'Été", "", None, "All Caps  Two-Spaces"]


def test_parse_ts_is_lenient_and_never_raises(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:07.1795",), ("not-a-date",), (None,), ("2001-07-01",), ("2024-13-40 00:00:00",)],
        "s string")
    got = [r[0] for r in df.select(parse_ts("s")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 7, 179500), None, None, dt.datetime(2001, 7, 1), None]


def test_duration_boundaries_and_buckets(spark):
    base = "2024-01-01 00:00:00"
    ends = ["2024-01-01 00:00:59.999999", "2024-01-01 00:01:00", "2024-01-01 00:05:00",
            base, "2023-12-31 23:00:00", None]
    df = spark.createDataFrame([(base, e) for e in ends], "s string, e string")
    out = df.select(duration_sec(parse_ts("s"), parse_ts("e")).alias("d")).select(
        "d", session_bucket("d").alias("b")).collect()
    assert [r.d for r in out] == [Decimal("59.999999"), Decimal("60"), Decimal("300"), 0, 0, 0]
    assert [r.b for r in out] == ["short", "medium", "long", "short", "short", "short"]


def test_row_json_keeps_nulls_and_decimal_scale(spark):
    df = spark.createDataFrame([(1, None, Decimal("12.50"))], "a bigint, b string, c decimal(18,2)")
    text = df.select(row_json(*df.columns).alias("j")).first().j
    assert text == '{"a":1,"b":null,"c":12.50}'
    assert json.loads(text) == {"a": 1, "b": None, "c": 12.5}


def test_record_hash_is_md5_of_source_check_and_json(spark):
    import hashlib
    df = spark.createDataFrame([('{"a":1}',)], "j string")
    got = df.select(record_hash("customers", "null_identifier", F.col("j"))).first()[0]
    assert got == hashlib.md5(b'customers' b'null_identifier' b'{"a":1}').hexdigest()


def test_row_hash_treats_null_as_empty_without_separator(spark):
    import hashlib
    df = spark.createDataFrame([(7, None, "x")], "a bigint, b string, c string")
    got = df.select(row_hash("a", "b", "c")).first()[0]
    assert got == hashlib.md5(b"7x").hexdigest()


def test_month_start(spark):
    df = spark.createDataFrame([("2001-07-31 23:59:59",)], "s string")
    assert df.select(month_start(parse_ts("s"))).first()[0] == dt.date(2001, 7, 1)


def test_fixed_values():
    assert (S.SHORT_SESSION_SEC, S.MEDIUM_SESSION_SEC) == (60, 300)
    assert S.LOOKBACK == dt.timedelta(days=3)
    assert S.FULL_LOAD_WEEKDAY == dt.date(2025, 1, 5).weekday()  # a Sunday


def test_currency_as_written_and_keeping_unknown_codes(spark):
    from meterwise.operators.staging import currency_code
    df = spark.createDataFrame([(" ngn ",), ("Naira",), ("usd",), (None,)], "c string")
    as_written = [r[0] for r in df.select(currency_code(F.col("c"))).collect()]
    kept = [r[0] for r in df.select(currency_code(F.col("c"), keep_unknown=True)).collect()]
    assert as_written == ["NGN", "NGN", "NGN", "NGN"]
    assert kept == ["NGN", "NGN", "USD", None]
