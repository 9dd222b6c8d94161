"""Readers and writers for the raw sources and the warehouse hand-off.

Sources always get an explicit schema (no inference). JDBC reads are split on
a numeric key so a large source table is read by many tasks in parallel.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise import schemas as S
from meterwise.functions import parse_ts

SOURCE_SCHEMAS = {
    S.SRC_CUSTOMERS: S.SRC_CUSTOMERS_SCHEMA,
    S.SRC_BILLING: S.SRC_BILLING_SCHEMA,
    S.SRC_SESSIONS: S.SRC_SESSIONS_SCHEMA,
}
SOURCE_TIME = {S.SRC_CUSTOMERS: "created_at", S.SRC_BILLING: "transaction_date",
               S.SRC_SESSIONS: "start_time"}
MALFORMED = S.MALFORMED_COLUMN
SOURCE_KEYS = {S.SRC_CUSTOMERS: "customer_id", S.SRC_BILLING: "transaction_id",
               S.SRC_SESSIONS: "session_id"}


def read_source(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """Read one raw source (``parquet``, ``csv`` or ``orc``) with its declared schema.

    A CSV line that does not fit the schema does not stop the run: its unreadable
    fields are NULL and ``MALFORMED`` holds the line, which the quarantine takes
    (``quarantine.malformed``). A line is a record, so large files are read in splits;
    ``multiLine="true"`` lets quoted fields hold line breaks and makes each file one task."""
    schema = SOURCE_SCHEMAS[name]
    reader = spark.read.schema(schema)
    if fmt == "csv":
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])
        reader = (spark.read.schema(schema).option("header", "true").option("nullValue", "").option("emptyValue", "")
                  .option("escape", '"')
                  .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED))
    return reader.options(**options).format(fmt).load(path)


def read_source_jdbc(spark: SparkSession, name: str, url: str, num_partitions: int,
                     lower: int, upper: int, **options: str) -> DataFrame:
    """Parallel JDBC read of a source table, range-split on its id column, with
    its declared types."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SOURCE_SCHEMAS[name].fields)
    return (spark.read.format("jdbc").option("customSchema", types)
            .option("url", url).option("dbtable", name)
            .option("partitionColumn", SOURCE_KEYS[name])
            .option("numPartitions", str(num_partitions))
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .options(**options).load())


TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
NULL_MARK = "\\N"  # never in the data: a backslash of the data is doubled


def _escaped(c: Column) -> Column:
    """One line per row: a backslash is doubled, line breaks become ``\\n`` / ``\\r``."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(c: Column) -> Column:
    # between doubled backslashes, a single one only starts a line break
    parts = F.split(c, r"\\\\")
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def _text_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def export_csv(df: DataFrame, path: str) -> None:
    """Uncompressed CSV with a header, replacing whatever was at ``path``.
    NULL is written as ``\\N`` and the empty string as ``""``, so the two stay
    apart when read back; line breaks and backslashes are escaped, so that every
    row is one line and the files stay splittable; quotes are doubled. Surrounding
    spaces are kept and timestamps keep their microseconds (the writer's defaults
    would drop both)."""
    texts = set(_text_columns(df.schema))
    (df.select(*[_escaped(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])
       .write.mode("overwrite")
       .option("header", "true").option("compression", "none").option("escape", '"')
       .option("nullValue", NULL_MARK).option("emptyValue", '""')
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
       .csv(path))


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back with its schema, skipping the header line."""
    rows = (spark.read.schema(schema)
            .option("header", "true").option("nullValue", NULL_MARK).option("emptyValue", "")
            .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
            .option("escape", '"').option("mode", "FAILFAST")
            .csv(path))
    texts = set(_text_columns(schema))
    return rows.select(*[_unescaped(F.col(c)).alias(c) if c in texts else F.col(c) for c in rows.columns])


def land(df: DataFrame, name: str, path: str, arrived_on: dt.date | None = None, by: str = S.EVENT_DATE) -> None:
    """Append raw source rows under ``path`` partitioned by their parsed event date, or
    by its month where days would make files too small (text that does not parse lands
    in the NULL partition, unchanged), below the day they arrived if it is given. Later
    loads prune by both instead of scanning the whole source. Landing a day of arrival
    again replaces what it landed."""
    date = F.to_date(parse_ts(SOURCE_TIME[name]))
    out = df.withColumn(by, F.trunc(date, "month") if by == S.EVENT_MONTH else date).hint("rebalance", by).write.partitionBy(by)
    if arrived_on is None:
        out.mode("append").parquet(path)
    else:
        out.mode("overwrite").parquet(f"{path}/{S.ARRIVED}={arrived_on}")


def read_landed(spark: SparkSession, name: str, path: str, arrivals: bool = False, by: str = S.EVENT_DATE) -> DataFrame:
    """A landed source: its declared columns plus the partitions, ``by`` and, with
    ``arrivals``, the day of arrival."""
    parts = ([T.StructField(S.ARRIVED, T.DateType(), True)] if arrivals else []) + [T.StructField(by, T.DateType(), True)]
    return spark.read.schema(T.StructType(SOURCE_SCHEMAS[name].fields + parts)).parquet(path)
