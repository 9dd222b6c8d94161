"""Incremental loads of billing and sessions as Structured Streaming (E1).

A parquet file stream (``Trigger.AvailableNow``) feeds ``foreachBatch``, which
runs the same staging function as the batch load, merges the batch latest-wins
into the month-partitioned history (so a replayed or out-of-order batch changes
nothing and only touched months are rewritten), moves the per-customer totals by
signed deltas, advances the watermark, and publishes everything in one commit.

A batch is known by its stream and its number: the stream's id lies in its
checkpoint folder, so a batch that is already committed is skipped (exactly-once
on restart), while a new checkpoint is a new stream whose batches all count. The
lookback starts from the watermark at the start of a call, not from that of the
previous batch, so the order in which landed files are taken does not matter.

``withWatermark`` + ``dropDuplicatesWithinWatermark`` keeps the *first* copy of a
key; the load needs the *latest*, hence the explicit merge. Where the first copy is
what is wanted, ``first_copies`` leaves all of it to Spark: state in RocksDB, late rows
dropped by the watermark, exactly-once files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise import schemas as S
from meterwise.functions import parse_ts
from meterwise.operators import aggregates as A
from meterwise.operators import staging as G
from meterwise.operators.watermark import advance, current, seed
from meterwise.plans.daily import Run, accumulate, merge_history
from meterwise.plans.tables import TableStore, missing


@dataclass(frozen=True)
class Feed:
    source: str
    schema: T.StructType
    stage: Callable[..., DataFrame]
    history: str
    key: str
    time: str
    order: Callable[[], list[Column]]
    totals: tuple[tuple[str, list[str], Callable[..., DataFrame], str], ...]


BILLING = Feed(S.SRC_BILLING, S.SRC_BILLING_SCHEMA, G.stage_billings, "hist_billings", "transaction_id", "transaction_date",
               G.billing_order, (("acc_billing", ["customer_id"], A.billing_delta, "total_transactions"),
                                 ("acc_monthly", ["customer_id", "month"], A.monthly_delta, "n_rows")))
SESSIONS = Feed(S.SRC_SESSIONS, S.SRC_SESSIONS_SCHEMA, G.stage_sessions, "hist_sessions", "session_id", "start_time",
                G.session_order, (("acc_usage", ["customer_id"], A.usage_delta, "total_sessions"),))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id kept in a checkpoint folder; made on its first use."""
    path = f"{checkpoint}/stream"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as e:
        if not missing(e):
            raise
    new = uuid.uuid4().hex
    spark.createDataFrame([(new,)], "value string").coalesce(1).write.text(path)
    return new


def watermarks(store: TableStore) -> DataFrame:
    return seed(store.spark, store.read("pipeline_watermarks"))


def batch_writer(store: TableStore, feed: Feed, stream: str, run_ts: dt.datetime) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: stage, merge latest-wins, accumulate, commit."""
    store.recover()
    since = current(watermarks(store))[feed.source]

    def write(batch: DataFrame, batch_id: int) -> None:
        run = Run(store, f"stream-{stream}-{batch_id:010d}")
        if store.is_committed(run.run_id):
            return  # replay after a restart
        staged = store.stage(f"{feed.history}_batch", feed.stage(batch, since, run_ts))
        changed = A.signed(*merge_history(run, feed.history, staged, feed.key, feed.time, feed.order()))
        for table, keys, delta, count in feed.totals:
            accumulate(run, table, keys, delta(changed, run_ts), count)
        run.put("pipeline_watermarks", advance(watermarks(store), {feed.source: staged}, run_ts))
        run.commit()

    return write


def run_stream(spark: SparkSession, feed: Feed, landing: str, store: TableStore, checkpoint: str, run_ts: dt.datetime,
               files_per_batch: int | None = None) -> None:
    """Process every file that has landed so far, then stop."""
    stream = spark.readStream.schema(feed.schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    q = (stream.parquet(landing).writeStream
         .foreachBatch(batch_writer(store, feed, stream_id(spark, checkpoint), run_ts))
         .option("checkpointLocation", f"{checkpoint}/spark").trigger(availableNow=True).start())
    q.awaitTermination()


STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_copies(spark: SparkSession, feed: Feed, landing: str, target: str, checkpoint: str) -> None:
    """Append the first copy of every id among the rows that have landed so far to the
    parquet files at ``target``, then stop.

    Rows without ids or a readable time are left out, and so are rows at or before the
    watermark (latest time seen by earlier batches, less the lookback): the strict
    bound of the batch load. An id is remembered until the watermark passes its first
    copy's time plus the lookback, so the state follows the ids of a few days, not all.
    ``landing`` is a source landed by day of arrival; a restart goes on from ``checkpoint``."""
    parts = [T.StructField(S.ARRIVED, T.DateType())]
    rows = (spark.readStream.schema(T.StructType([*feed.schema.fields, *parts])).parquet(landing)
            .withColumn("row_time", parse_ts(feed.time).cast("timestamp"))
            .where(F.col(feed.key).isNotNull() & F.col("customer_id").isNotNull() & F.col("row_time").isNotNull())
            .withWatermark("row_time", f"{S.LOOKBACK.days} days")
            .dropDuplicatesWithinWatermark([feed.key]))
    old = spark.conf.get(STATE_STORE_CONF, None)
    spark.conf.set(STATE_STORE_CONF, ROCKSDB)  # read when the query starts
    try:
        query = (rows.writeStream.format("parquet").option("path", target)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.unset(STATE_STORE_CONF) if old is None else spark.conf.set(STATE_STORE_CONF, old)
    query.awaitTermination()
