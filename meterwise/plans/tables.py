"""The store's tables: ordinary Spark catalog tables with defaults, partitions and buckets.

Persistent tables are external parquet tables under ``<root>/<table>``, so a new
session (or another application) attaches to what earlier ones left; transient
(staging) tables are managed and emptied with TRUNCATE TABLE. History and run
reports are partitioned and written by dynamic partition overwrite; tables of
customer grain are bucketed and sorted by customer_id, so that joins between them
need no shuffle.

A run has two phases, because Spark has no commit over several tables. First it
*prepares* the next content of every table it changes (parquet under
``<root>/_next``), reading only published tables; then, once the run log says so, it
*publishes* each by INSERT OVERWRITE. Preparing touches nothing that is published
and may be repeated; publishing reads prepared copies only and may be repeated too.
So a run that dies in either phase is finished by running it again, with the same
result. A store has one writer at a time; a reader in the middle of publishing may
see some tables of the run before others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise import schemas as S

BUCKETS_CONF = "spark.meterwise.buckets"
DEFAULT_BUCKETS = 8
DYNAMIC_CONF = "spark.sql.sources.partitionOverwriteMode"
PREPARED, PUBLISHED = "prepared", "published"


def missing(e: AnalysisException) -> bool:
    """Only a path that does not exist means "nothing written yet"; any other
    failure to read must not pass for an empty state."""
    return e.getCondition() == "PATH_NOT_FOUND"


def create_statement(name: str, table: str, buckets: int, location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS with the table's defaults, partitions and buckets."""
    partition, cluster = S.PARTITIONS.get(table), S.BUCKETED.get(table)
    columns = []
    for f in TableStore.stored(table).fields:
        default = S.DEFAULTS.get(table, {}).get(f.name)
        columns.append(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                       + (f" DEFAULT {default}" if default else ""))
    return (f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet"
            + (f" PARTITIONED BY (`{partition}`)" if partition else "")
            + (f" CLUSTERED BY (`{cluster}`) SORTED BY (`{cluster}`) INTO {buckets} BUCKETS" if cluster else "")
            + (f" LOCATION '{location}'" if location else ""))


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.database = "meterwise_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        self._names: dict[str, str] = {}
        self._buckets: int | None = None

    # ---- tables ------------------------------------------------------------
    @property
    def buckets(self) -> int:
        """The number of buckets the store was made with (the session's setting when it is new)."""
        if self._buckets is None:
            try:
                self._buckets = self.spark.read.schema("buckets int").parquet(f"{self.root}/_layout").first()[0]
            except AnalysisException as e:
                if not missing(e):
                    raise
                self._buckets = int(self.spark.conf.get(BUCKETS_CONF, str(DEFAULT_BUCKETS)))
                self.spark.createDataFrame([(self._buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.root}/_layout")
        return self._buckets

    def name(self, table: str) -> str:
        """The qualified name of ``table``, created or attached on first use."""
        if table not in self._names:
            transient = S.TABLES[table][2]
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} "
                           f"LOCATION '{self.root}/_transient/{self.spark.sparkContext.applicationId}'")
            name = f"{self.database}.{table}"
            new = not self.spark.catalog.tableExists(name)
            self.spark.sql(create_statement(name, table, self.buckets, None if transient else f"{self.root}/{table}"))
            if new and table in S.PARTITIONS and self._written(table):  # partitions that earlier sessions wrote
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            self._names[table] = name
        return self._names[table]

    def _written(self, table: str) -> bool:
        try:
            self.spark.read.schema(S.TABLES[table][0]).parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if not missing(e):
                raise
            return False
        return True

    def init_tables(self) -> None:
        """Create every table that does not exist."""
        for table in S.TABLES:
            self.name(table)

    def read(self, table: str, partition: bool = False) -> DataFrame:
        """The published rows; with the partition column if asked for."""
        schema = self.stored(table) if partition else S.TABLES[table][0]
        return self.spark.table(self.name(table)).select(*schema.fieldNames())

    @staticmethod
    def stored(table: str) -> T.StructType:
        """The table's columns with its partition column."""
        schema, partition = S.TABLES[table][0], S.PARTITIONS.get(table)
        return schema if partition is None or partition in schema.fieldNames() else T.StructType([*schema.fields, T.StructField(partition, T.StringType())])

    def overwrite(self, table: str, df: DataFrame) -> None:
        """INSERT OVERWRITE: the whole table, or the partitions that ``df`` has rows of.
        Rows of bucketed tables are dealt to their buckets first, so each bucket is one file."""
        df = df.select(*self.stored(table).fieldNames())
        if table in S.BUCKETED:
            df = df.repartition(self.buckets, S.BUCKETED[table])
        df.write.insertInto(self.name(table), overwrite=True)

    def load(self, table: str, df: DataFrame) -> DataFrame:
        """Fill a transient table and continue from it: lineage ends at its files."""
        self.overwrite(table, df)
        return self.read(table)

    def insert(self, table: str, df: DataFrame) -> None:
        """INSERT INTO by name; columns that ``df`` lacks take their DEFAULT."""
        cols = ", ".join(f"`{c}`" for c in df.columns)
        self.spark.sql(f"INSERT INTO {self.name(table)} ({cols}) SELECT {cols} FROM {{rows}}", rows=df)

    def truncate(self, *tables: str) -> None:
        for table in tables:
            self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """A copy for the rest of the run, replaced by the next run's."""
        path = f"{self.root}/_stage/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- runs --------------------------------------------------------------
    def _step(self, run_id: str, step: str) -> list:
        log = self.spark.table(self.name("run_log"))
        return log.where((F.col("run_id") == run_id) & (F.col("step") == step)).limit(1).collect()

    def is_committed(self, run_id: str) -> bool:
        return bool(self._step(run_id, PUBLISHED))

    def prepare(self, table: str, df: DataFrame) -> DataFrame:
        """Write the next content of ``table`` (or of the partitions ``df`` has) aside and continue from it."""
        path = f"{self.root}/_next/{table}"
        df = df.select(*self.stored(table).fieldNames())
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self, run_id: str, tables: list[str], emptied: list[str] = ()) -> None:
        """Publish what was prepared. ``emptied``: ``table/partition value`` of partitions
        that lost their last row."""
        self.insert("run_log", self.spark.createDataFrame([(run_id, PREPARED, sorted(tables), sorted(emptied))],
                                                          "run_id string, step string, tables array<string>, emptied array<string>"))
        self.publish(run_id)

    def recover(self) -> None:
        """Finish a run that died while it was being published: its prepared copies are
        whole, and no other run may start before."""
        log = self.spark.table(self.name("run_log"))
        done = log.groupBy("run_id").agg(F.count_if(F.col("step") == PUBLISHED).alias("n")).where("n = 0")
        for row in done.collect():  # at most one
            self.publish(row["run_id"])

    def publish(self, run_id: str) -> None:
        row = self._step(run_id, PREPARED)[0]
        with self.dynamic_overwrite():
            with ThreadPoolExecutor(max_workers=4) as pool:  # independent writes; only the waiting overlaps
                list(pool.map(self._publish, row["tables"]))
            for entry in row["emptied"]:
                table, value = entry.split("/", 1)
                none = self.spark.createDataFrame([], S.TABLES[table][0])
                self.spark.sql(f"INSERT OVERWRITE {self.name(table)} PARTITION (`{S.PARTITIONS[table]}` = '{value}') "
                               "SELECT * FROM {none}", none=none)
        self.truncate(*S.TRANSIENT)
        self.insert("run_log", self.spark.createDataFrame([(run_id, PUBLISHED)], "run_id string, step string"))

    def _publish(self, table: str) -> None:
        self.overwrite(table, self.spark.read.schema(self.stored(table)).parquet(f"{self.root}/_next/{table}"))

    @contextmanager
    def dynamic_overwrite(self) -> Iterator[None]:
        """Partitioned tables keep the partitions that a write has no rows of."""
        old = self.spark.conf.get(DYNAMIC_CONF, None)
        self.spark.conf.set(DYNAMIC_CONF, "dynamic")
        try:
            yield
        finally:
            if old is None:
                self.spark.conf.unset(DYNAMIC_CONF)
            else:
                self.spark.conf.set(DYNAMIC_CONF, old)
