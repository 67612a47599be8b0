"""Keyed incremental upsert (MERGE) on DataFrames.

``merge_frames`` is the pure operator: one full outer join of target and
source on the unique key; matched rows take the source value for the update
columns and keep the target value for the rest, unmatched source rows are
inserted whole, unmatched target rows pass through.

``incremental_upsert`` adds the lookback filter and, with a partitioned
target, restricts the join to the partitions the source touches (see
``tidemart.sinks.versioned`` for the publish step).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.expressions import LOOKBACK_DAYS, value_literal


class DuplicateKeyError(ValueError):
    """The upsert source holds a key more than once."""


#: Repeated hashes whose keys are compared before all keys are.
HASHES_LOOKED_UP = 100


def assert_unique_keys(source: DataFrame, key: str) -> None:
    """Raise if a key appears twice in ``source``.  One aggregate job over the
    keys' 64-bit hashes, 8 bytes a key in the shuffle: without a repeated hash
    no key repeats.  Else the keys themselves are compared, first those of
    some repeated hashes, then, if these merely collide, all of them."""
    hashed = source.select(key, F.xxhash64(key).alias("__hash"))
    repeated = [r[0] for r in hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1).select("__hash").limit(HASHES_LOOKED_UP).collect()]
    dup = []
    for rows in (hashed.filter(F.col("__hash").isin(*repeated)), hashed) if repeated else ():
        dup = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).collect()
        if dup or len(repeated) < HASHES_LOOKED_UP:
            break
    if dup:
        raise DuplicateKeyError(f"duplicate upsert key {key}={dup[0][key]!r} ({dup[0]['n']} rows)")


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_columns: Sequence[str] | None = None,
    insert: bool = True,
) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``key``.

    ``update_columns=None`` updates every column of a matched row.  The output
    has the target's columns in the target's order.  Without ``insert`` source
    rows that match none are left out.
    """
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    upd = set(cols) if update_columns is None else set(update_columns) | {key}
    t = target.select(*cols, F.lit(True).alias("__in_t")).alias("t")
    s = source.select(*cols, F.lit(True).alias("__in_s")).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer" if insert else "left")
    in_s = F.col("s.__in_s").isNotNull()
    in_t = F.col("t.__in_t").isNotNull()
    out = []
    for c in cols:
        if c in upd:
            out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


def lookback_cutoff(target: DataFrame, column: str, days: int = LOOKBACK_DAYS):
    """``max(column) - days`` over the target as a Python value (one row is
    collected), or None for an empty target.  Works for dates and
    timestamps."""
    row = target.agg(F.max(column).alias("m")).first()
    if row is None or row["m"] is None:
        return None
    import datetime as dt

    return row["m"] - dt.timedelta(days=days)


def lookback_filter(
    source: DataFrame,
    target: DataFrame,
    source_column: str,
    target_column: str,
    days: int = LOOKBACK_DAYS,
    inclusive: bool = False,
) -> DataFrame:
    """Keep source rows newer than the target's watermark minus ``days``.

    The cutoff is a literal, so it is pushed into the source scan (and
    prunes partitions when ``source_column`` is a partition column).  An
    empty target means a first run: nothing is filtered.
    """
    cutoff = lookback_cutoff(target, target_column, days)
    if cutoff is None:
        return source
    c = F.col(source_column)
    lit = value_literal(cutoff)
    return source.filter(c >= lit if inclusive else c > lit)


def incremental_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_columns: Sequence[str] | None = None,
    lookback_source_column: str | None = None,
    lookback_target_column: str | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    lookback_inclusive: bool = False,
    check_duplicates: bool = True,
) -> DataFrame:
    """Lookback-filtered MERGE of ``source`` into ``target`` (pure form)."""
    if lookback_source_column:
        source = lookback_filter(
            source, target, lookback_source_column, lookback_target_column or lookback_source_column,
            lookback_days, lookback_inclusive,
        )
    if check_duplicates:
        assert_unique_keys(source, key)
    return merge_frames(target, source, key, update_columns)


def touched_partitions(target: DataFrame, source: DataFrame, key: str, partition_col: str) -> list:
    """Partition values an upsert rewrites: partitions of target rows whose
    key is in the source, plus the source rows' own partitions.

    Only the key and partition columns of the target are scanned, joined to
    the source keys with a left-semi join (AQE broadcasts the source keys
    when their measured size is small), and only the distinct partition
    values — bounded by the number of partitions, not rows — reach the
    driver.
    """
    src_keys = source.select(key)
    matched = target.select(key, partition_col).join(src_keys, key, "left_semi").select(partition_col)
    parts = matched.unionByName(source.select(partition_col)).distinct()
    return [r[0] for r in parts.collect()]


# Columns a matched order updates (the rest keep their first-seen values).
FCT_ORDERS_UPDATE_COLUMNS = (
    "order_status",
    "order_total_amount",
    "items_net_amount",
    "items_gross_amount",
    "line_item_count",
    "total_quantity",
    "has_total_mismatch",
    "updated_at",
    "_built_at",
)
