"""Key-set joins with a checked broadcast.

Many steps filter a large table by a key set that is usually small: the
repeated ids, the orphan customer ids, the keys of a day's delta, the
customers a run touched. If Catalyst cannot prove the key set small before
the job starts, both sides are shuffled, which at scale means moving the large
table just to drop or keep a few keys. Here the key set is materialized on the
shared checkpoint folder (written once as parquet and read back, which also
cuts its lineage), measured, and broadcast only when its bytes are within a
bound; beyond the bound the join stays a shuffled sort-merge join (AQE splits
skewed partitions). The result is the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.session import unique_scratch

MAX_BROADCAST_CONF = "spark.meterwise.broadcast.maxBytes"
DEFAULT_MAX_BROADCAST = 8 << 20  # a run has some hundred such joins, and all their key sets pass the driver
ROW_BYTES = 48  # of a broadcast row besides its texts: hash entry, pointers, fixed-width keys


def max_broadcast_bytes(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_BROADCAST_CONF, str(DEFAULT_MAX_BROADCAST)))


def size_in_bytes(keys: DataFrame) -> int:
    """Bytes that ``keys`` take as a broadcast relation, from one pass over them."""
    texts = [f.name for f in keys.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    per_row = F.lit(ROW_BYTES + 8 * len(keys.columns))
    for c in texts:
        per_row = per_row + F.coalesce(F.octet_length(c), F.lit(0))
    return keys.agg(F.sum(per_row.cast("long"))).first()[0] or 0


_BOUNDED: dict[tuple, tuple[DataFrame, DataFrame, bool]] = {}


def materialize(df: DataFrame, prefix: str = "keys") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and continue from the copy:
    later uses neither recompute it nor depend on its lineage."""
    spark = df.sparkSession
    path = unique_scratch(spark, prefix)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


materialize_df = materialize  # the parameter below shadows the function name


def bounded(keys: DataFrame, on: Sequence[str], materialize: bool = True) -> DataFrame:
    """The distinct ``on`` columns of ``keys``, marked for broadcast when their
    bytes are within the bound.

    ``materialize=False`` when ``keys`` is already read from storage (measuring
    it is then a cheap scan and it is not recomputed by the join). The decision
    is remembered per key set, so a set used by several joins is measured once."""
    return _measured(keys, on, materialize)[0]


def is_small(keys: DataFrame, on: Sequence[str]) -> bool:
    """Whether the distinct ``on`` columns of ``keys``, read from storage, are within the broadcast bound."""
    return _measured(keys, on, False)[1]


def _measured(keys: DataFrame, on: Sequence[str], materialize: bool) -> tuple[DataFrame, bool]:
    memo = (id(keys), tuple(on), materialize)
    hit = _BOUNDED.get(memo)
    if hit is not None and hit[0] is keys:
        return hit[1:]
    ks = keys.select(*on).distinct()
    if materialize:
        ks = materialize_df(ks)
    small = size_in_bytes(ks) <= max_broadcast_bytes(ks)
    out = F.broadcast(ks) if small else ks
    if len(_BOUNDED) > 64:
        _BOUNDED.clear()
    _BOUNDED[memo] = (keys, out, small)
    return out, small


def filter_by_keys(rows: DataFrame, keys: DataFrame, on: str | Sequence[str], how: str,
                   materialize: bool = True) -> DataFrame:
    """``rows`` semi- or anti-joined to the distinct ``keys``."""
    assert how in ("left_semi", "left_anti")
    cols = [on] if isinstance(on, str) else list(on)
    return rows.join(bounded(keys, cols, materialize), cols, how)


def split_by_keys(target: DataFrame, keys: DataFrame, on: Sequence[str],
                  materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows of ``target`` whose key is not in ``keys``, rows whose key is).
    The first passes through untouched; only the second needs to meet the delta."""
    ks = bounded(keys, list(on), materialize)
    return target.join(ks, list(on), "left_anti"), target.join(ks, list(on), "left_semi")
