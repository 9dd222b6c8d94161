"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ("customer", "nation", "orders", "events")


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v != 0 else decimal.Decimal(0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _keys():
    from meterwise.plans.catalog import QUERIES
    return sorted(QUERIES)


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql
    assert set(_keys()) <= set(oracle_sql())


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _bag(srows, scols) == _bag(orows, ocols)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_id" and len(df.columns) == 17


@pytest.mark.parametrize("key", ["src_sessions", "stg_sessions_initial", "agg_monthly_revenue", "csv_roundtrip"])
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, key):
    from __spark_entry__ import oracle_sql, queries
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = queries()[key](spark, SF_SMALL)
        srows, scols = [tuple(r) for r in df.collect()], df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(oracle_sql()[key])
    assert _bag(srows, scols) == _bag(res.fetchall(), [d[0] for d in res.description])
