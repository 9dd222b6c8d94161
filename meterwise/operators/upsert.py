"""Keyed writes expressed as DataFrame plans (G5, G6, A7, A8, H3).

Parquet has no MERGE, so every keyed write is a plan that produces the whole
next version of the target; ``meterwise.plans.tables`` publishes it. All plans
shuffle on the key at most once per side and never collect rows.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.joins import is_small, materialize, split_by_keys

INSERT_ONLY, REPLACE, ADDITIVE = "insert_only", "replace", "additive"


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "delta") -> None:
    """Raise if any key repeats. Partial aggregation keeps this cheap under skew;
    only the first offending key reaches the driver."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{what} repeats key {dup[0].asDict()}")


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str], policy: str,
           cols: Sequence[str] | None = None, sums: Sequence[str] | None = None,
           latest: str | None = "last_updated_at", materialized: bool = False,
           unique: bool = False) -> DataFrame:
    """Next version of ``target`` after writing ``delta``.

    A key that repeats in ``delta`` raises ``DuplicateKeyError``: which of its rows
    would win is undefined. ``unique`` says the caller's own grouping or window
    already made the keys unique, which saves the check.

    * ``insert_only``: new keys are added, existing rows never change.
    * ``replace``: matched rows take delta's values for ``cols`` (default: every
      non-key column) and keep their own for the rest; new keys are inserted.
    * ``additive``: matched rows add delta's ``sums``; ``latest`` takes the max.

    The target is split by the delta's keys when they are few enough to broadcast:
    untouched rows pass through without a shuffle, and only the touched rows meet the
    delta. Beyond the bound both are shuffled once by key. ``materialized`` says ``delta`` is already read
    from storage; otherwise it is written once to the scratch folder first, so the
    key split and the merge do not compute it twice.
    """
    keys = list(keys)
    delta = delta.select(*target.columns)
    if not materialized:
        delta = materialize(delta, "delta")  # small side: write once, no recomputation
    if not unique:
        assert_unique(delta, keys)
    few = is_small(delta, keys)
    if policy == INSERT_ONLY:
        if not few:
            return target.unionByName(delta.join(target.select(*keys), keys, "left_anti"))
        _, existing = split_by_keys(target.select(*keys), delta, keys, False)
        return target.unionByName(delta.join(existing, keys, "left_anti"))
    if policy == ADDITIVE:
        sums = [c for c in target.columns if c not in keys and c != latest] if sums is None else list(sums)
        aggs = [F.sum(c).cast(target.schema[c].dataType).alias(c) for c in sums]
        if latest:
            aggs.append(F.max(latest).alias(latest))
        if not few:
            return together(target, delta, keys).groupBy(*keys, SIDE, ALONE).agg(*aggs).select(*target.columns)
    untouched, touched = split_by_keys(target, delta, keys, False)
    if policy == REPLACE:
        rest = [c for c in target.columns if c not in keys]
        cols = rest if cols is None else list(cols)
        if set(cols) == set(rest):
            # whole-row replace: untouched target rows plus the delta
            return untouched.unionByName(delta)
        t, d = touched.alias("t"), delta.alias("d")
        cond = [F.col(f"t.{k}") == F.col(f"d.{k}") for k in keys]
        in_delta = F.col(f"d.{keys[0]}").isNotNull()
        out = [F.coalesce(F.col(f"d.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
        for c in rest:
            if c in cols:
                out.append(F.when(in_delta, F.col(f"d.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
            else:
                out.append(F.when(F.col(f"t.{keys[0]}").isNotNull(), F.col(f"t.{c}"))
                            .otherwise(F.col(f"d.{c}")).alias(c))
        return untouched.unionByName(t.join(d, cond, "full_outer").select(*out))
    if policy == ADDITIVE:
        added = touched.unionByName(delta).groupBy(*keys).agg(*aggs).select(*target.columns)
        return untouched.unionByName(added)
    raise ValueError(f"unknown policy {policy!r}")


NEW, SIDE, HIT, RANK, ALONE = "_new", "_side", "_hit", "_rn", "_alone"


def together(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of both, shuffled once by key: ``NEW`` 1 for rows of ``delta``, ``HIT`` 1
    where ``delta`` has the key, ``ALONE`` another number for each target row whose key it
    has not. Null keys meet nothing: ``SIDE`` keeps them apart."""
    none = functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    both = target.withColumn(NEW, F.lit(0)).unionByName(delta.withColumn(NEW, F.lit(1))).withColumn(SIDE, F.when(none, F.col(NEW)))
    met = both.withColumn(HIT, F.max(NEW).over(Window.partitionBy(*keys, SIDE)))
    return met.withColumn(ALONE, F.when(F.col(HIT) == 0, F.monotonically_increasing_id()))


def ranked(target: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``together`` with ``RANK``, a row's place in its key by ``order``. The next version
    are the rows ``WINS``; a delta key's rows in ``target`` are those with HIT 1 and NEW 0."""
    return together(target, delta, keys).withColumn(RANK, F.row_number().over(Window.partitionBy(*keys, SIDE).orderBy(*order)))


WINS = f"{HIT} = 0 OR {RANK} = 1"


def upsert_latest(target: DataFrame, delta: DataFrame, keys: Sequence[str],
                  order: Sequence[Column], materialized: bool = False) -> DataFrame:
    """Keep, per key, the row that sorts first by ``order`` across target and delta.
    Arrival order does not matter, so replaying a batch is harmless. Only target
    rows sharing a key with the delta are re-sorted, where its keys can be broadcast."""
    delta = delta.select(*target.columns)
    if not materialized:
        delta = materialize(delta, "delta")
    if not is_small(delta, keys):
        return ranked(target, delta, keys, order).where(WINS).select(*target.columns)
    untouched, touched = split_by_keys(target, delta, keys, False)
    w = Window.partitionBy(*keys).orderBy(*order)
    both = touched.unionByName(delta)
    return untouched.unionByName(both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn"))


def merge_guarded(target: DataFrame, source: DataFrame, key: str,
                  guard: Column | str = "row_hash", materialized: bool = False) -> DataFrame:
    """MERGE ... WHEN MATCHED AND target.guard != source.guard THEN UPDATE
    WHEN NOT MATCHED THEN INSERT. Unmatched target rows stay; nothing is deleted;
    a NULL guard on either side never updates (``!=`` is not true).

    ``guard`` is a column name present on both sides or a Column expression over
    the row's own columns (evaluated separately on each side). With a
    ``materialized`` (stored, usually small) source, target rows whose key the
    source does not carry pass through without a shuffle; an unmaterialized
    source would have to be computed twice for that, so it meets the whole target,
    and so does one whose keys are too many to broadcast."""
    cols = target.columns
    source = source.select(*cols)
    if materialized:
        carried = source.where(F.col(key).isNotNull())
        if is_small(carried, [key]):
            untouched, touched = split_by_keys(target, carried, [key], False)
        else:
            untouched, touched = target.where(F.col(key).isNull()), target.where(F.col(key).isNotNull())
    else:
        untouched, touched = None, target
    g = F.col(guard) if isinstance(guard, str) else guard
    t = touched.select(*cols, g.alias("_g")).alias("t")
    s = source.select(*cols, g.alias("_g")).alias("s")
    matched = F.col(f"t.{key}").isNotNull() & F.col(f"s.{key}").isNotNull()
    take_source = F.col(f"t.{key}").isNull() | (matched & (F.col("t._g") != F.col("s._g")))
    out = [F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols]
    merged = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(*out)
    return merged if untouched is None else untouched.unionByName(merged)


def content_hash(cols: Sequence[str]) -> Column:
    """Hash over all content columns, with a separator, for ``guard="row"`` merges."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols]
    return F.md5(F.concat_ws("\u001f", *parts))
