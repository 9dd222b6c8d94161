"""Helpers shared by the operators: table access, splits, Arrow batches, words.

Python work runs inside ``mapInArrow`` on bounded slices of Arrow batches, one
output row (or a few) per input row, so a lost executor only costs its own
tasks and no task holds more than a slice of its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators.joins import materialize

SLICE_BYTES = 4 << 20  # text bytes handled at once by a Python worker: up to 100 bytes of arrays for each
ARROW_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH_BYTES = 16 << 20
SIEVE_BITS = 1 << 26  # of a broadcast bit set, 8 MB


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back: later
    stages depend on the files only."""
    return materialize(df, name)


def id_remainder(m: int, col: str = "doc_id") -> Column:
    """crc32(id as text) mod m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % F.lit(m)


def text_bytes(arr: pa.Array) -> pa.Array:
    """A string column as utf-8 with nulls as empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_string(arr.type):
        arr = arr.cast(pa.string())
    return pc.fill_null(arr, "")


def give_back() -> None:
    """Return freed memory to the system: Python workers are used again by the next
    stages, and what their allocators keep of earlier ones adds up on an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, col: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``limit`` text bytes (or one row)."""
    n = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(n)
    i = 0
    while i < len(n):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(i, j - i)
        i = j


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
             limit: int = SLICE_BYTES, col: str = "text") -> DataFrame:
    """``fn`` over bounded slices of every Arrow batch of ``df``."""
    df.sparkSession.conf.set(ARROW_BATCH_CONF, str(ARROW_BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit, col):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
        give_back()
    return df.mapInArrow(run, schema)


def hash_sample(ids: DataFrame, bound: int, salt: int, col: str = "doc_id") -> DataFrame:
    """About ``bound`` of the distinct ids (all, if fewer): those whose hash lies
    below bound / number. No task sorts or gathers them, at any size."""
    few = store(ids.where(F.col(col).isNotNull()).select(col).distinct(), "ids")
    n = few.count()
    if n <= bound:
        return few
    return few.where(F.pmod(F.xxhash64(F.lit(salt), col), F.lit(1 << 40)) < F.lit(int(bound / n * (1 << 40))))


def sieve(rows: DataFrame, keys: DataFrame, col: str, bound: int = SIEVE_BITS) -> DataFrame:
    """The ``rows`` whose ``col`` is among that of ``keys`` (read from storage), and few
    others: what a join with ``keys`` need not shuffle goes before it. A set of one bit
    for each hash is broadcast, sixteen for each key and ``bound`` at most; with more
    keys more rows pass, and the join stays right."""
    bits = min(bound, max(1 << 12, 1 << (16 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(col), F.lit(bits))
    word, mask = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    every = rows.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = keys.select(word.alias("word"), mask.alias("mask")).union(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    line = words.groupBy(F.shiftright("word", 6).alias("sieve_line")).agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).getField("mask").alias("sieve_masks"))
    of = F.get("sieve_masks", word.bitwiseAND(F.lit(63)).cast("int"))
    return rows.join(F.broadcast(line), (F.shiftright(word, 6) == F.col("sieve_line")) & (of.bitwiseAND(mask) != 0)).select(*rows.columns)


def most_frequent(counts: DataFrame, count: str, bound: int) -> DataFrame:
    """The rows of largest ``count``, as many whole steps of a sixteenth of a doubling
    as hold at most ``bound`` rows. Where the first step alone holds more (equal counts),
    about ``bound`` of its rows by hash, so that the answer is empty only if ``bound``
    or the table is. The steps are the only thing gathered."""
    step = F.floor(F.log2(F.col(count)) * 16).cast("int")
    steps = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for s, n in steps:
        if total + n > bound:
            if not total:
                near = F.pmod(F.xxhash64(*sorted(counts.columns)), F.lit(1 << 40)) < F.lit(int(bound / n * (1 << 40)))
                return counts.where((step == s) & near)
            break
        least, total = s, total + n
    return counts.where(F.lit(False) if least is None else step >= least)


def batch_of(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(cols)


def split_words(texts: pa.Array, lower: str = "ascii") -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space: (document offsets, words).

    ``lower``: "ascii" lowers A-Z only, "utf8" every letter, "" none."""
    t = text_bytes(texts)
    if lower == "ascii":
        t = pc.ascii_lower(t)
    elif lower:
        t = pc.utf8_lower(t)
    parts = pc.ascii_split_whitespace(t)
    flat = parts.flatten()
    offs = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())]).astype(np.int64)
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offs = np.concatenate([[0], np.cumsum(keep)])[offs]
    return offs, flat.filter(pa.array(keep))


def words(texts: pa.Array, lower: str = "ascii") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(document offsets, word codes, distinct words), as ``split_words`` cuts them."""
    offs, flat = split_words(texts, lower)
    enc = flat.dictionary_encode()
    return offs, enc.indices.to_numpy().astype(np.int64), enc.dictionary.to_pylist()


def segment_sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets; 0 for empty segments."""
    c = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return c[offs[1:]] - c[offs[:-1]]
