"""The three raw sources, derived from the driver's tables by fixed rules.

The rules inject every defect the quality checks look for (NULL keys, duplicate
keys, orphans, negative amounts, unparseable dates, clock-skewed sessions), so
the sources grow with the input tables. Each source is a plain projection /
union of one scan; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.schemas import AMOUNT_T

# Fixed fixture rules (moduli / residues / offsets), kept as plain values.
ORPHAN_OFFSET = 10_000_000
CUSTOMER_NAME_PREFIX = "o'neil "
EMAIL_PREFIX, EMAIL_DOMAIN = "User", "@Example.COM"
DUP_COUNTRY, DUP_CREATED_AT = "Ghana", "2001-01-01 00:00:00"
CURRENCY_BY_MOD4 = {0: " ngn ", 1: "Naira", 3: "USD"}  # 2 -> NULL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _txt(c: Column) -> Column:
    return c.cast("string")


def src_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    created = F.concat(_txt(1995 + k % 6), F.lit("-0"), _txt(1 + k % 9), F.lit("-1"),
                       _txt(k % 10), F.lit(" 00:00:00"))
    main = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        _null_when(k % 101 == 7, k).cast("bigint").alias("customer_id"),
        F.concat(F.lit(CUSTOMER_NAME_PREFIX), F.lower("c_mktsegment"), F.lit("-"), _txt(k)).alias("name"),
        _null_when(k % 61 == 9, F.concat(F.lit(EMAIL_PREFIX), _txt(k), F.lit(EMAIL_DOMAIN))).alias("email"),
        _null_when(k % 10 == 0, F.col("n_name")).cast("string").alias("country"),
        _null_when(k % 53 == 5, created).cast("string").alias("created_at"))
    dups = cust.where(k % 211 == 3).select(
        k.alias("customer_id"), F.lower("c_name").alias("name"),
        F.lit(None).cast("string").alias("email"), F.lit(DUP_COUNTRY).alias("country"),
        F.lit(DUP_CREATED_AT).alias("created_at"))
    return main.unionByName(dups)


def src_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every order stays; those of some customers go to a neighbour, so that some
    # customers have no billing at all
    o = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 17 == 3, F.col("o_custkey") - 1).otherwise(F.col("o_custkey")))
    k, cust, price, odate = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"), F.col("o_orderdate")
    m4 = k % 4
    currency = F.when(m4 == 0, CURRENCY_BY_MOD4[0]).when(m4 == 1, CURRENCY_BY_MOD4[1]).when(m4 == 3, CURRENCY_BY_MOD4[3])
    main = o.select(
        _null_when(k % 997 == 1, k).cast("bigint").alias("transaction_id"),
        F.when(k % 503 == 2, F.lit(None)).when(k % 401 == 3, cust + ORPHAN_OFFSET)
         .otherwise(cust).cast("bigint").alias("customer_id"),
        F.when(k % 307 == 4, F.lit(None)).when(k % 211 == 5, -price)
         .otherwise(price).cast(AMOUNT_T).alias("amount"),
        currency.alias("currency"),
        F.when(k % 601 == 6, F.lit(None)).when(k % 701 == 7, F.lit("not-a-date"))
         .otherwise(_txt(odate)).alias("transaction_date"))
    copies = o.where(k % 89 == 10).select(
        k.alias("transaction_id"), cust.alias("customer_id"), price.cast(AMOUNT_T).alias("amount"),
        currency.alias("currency"), _txt(odate).alias("transaction_date"))
    later = o.where(k % 97 == 11).select(
        k.alias("transaction_id"), cust.alias("customer_id"), (price + 1).cast(AMOUNT_T).alias("amount"),
        F.lit("NGN").alias("currency"), _txt(odate + F.expr("INTERVAL 1 DAY")).alias("transaction_date"))
    return main.unionByName(copies).unionByName(later)


def src_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k, user, ts, value = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("value")
    end = (F.when(k % 53 == 4, F.lit(None))
           .when(k % 71 == 5, _txt(ts - F.expr("INTERVAL 1 HOUR")))
           .otherwise(_txt(ts + F.make_dt_interval(secs=F.floor(value * 3).cast("int")))))
    main = e.select(
        _null_when(k % 499 == 1, k).cast("bigint").alias("session_id"),
        F.when(k % 401 == 2, F.lit(None)).when(k % 307 == 3, user + ORPHAN_OFFSET)
         .otherwise(user).cast("bigint").alias("customer_id"),
        _null_when(k % 601 == 6, _txt(ts)).cast("string").alias("start_time"),
        end.cast("string").alias("end_time"),
        _null_when(k % 83 == 6, value).cast(AMOUNT_T).alias("data_used_mb"))
    later = e.where(k % 89 == 10).select(
        k.alias("session_id"), user.alias("customer_id"),
        _txt(ts + F.expr("INTERVAL 1 MINUTE")).alias("start_time"),
        _txt(ts + F.expr("INTERVAL 2 MINUTES")).alias("end_time"),
        value.cast(AMOUNT_T).alias("data_used_mb"))
    return main.unionByName(later)


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"customers": src_customers(spark, sf_dir),
            "billing": src_billing(spark, sf_dir),
            "sessions": src_sessions(spark, sf_dir)}
