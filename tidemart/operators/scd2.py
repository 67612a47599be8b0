"""Type-2 slowly changing dimension snapshot ("check" strategy).

History rows carry ``valid_from``, ``valid_to`` (NULL while open) and
``scd_id`` = SHA-256 of (key, valid_from).  One run:

* open history rows are full-outer-joined with the current rows on the key;
* a change in any check column (NULL-safe comparison) closes the open row at
  ``as_of`` and opens a new one from the current row;
* a key missing from the current rows has its open row closed at ``as_of``
  (hard-delete invalidation); a key that comes back opens a new row;
* unchanged keys keep their row untouched (unchecked columns included);
* closed history passes through;
* rows with a NULL key are not snapshotted.

Each joined row yields one or two output rows through ``explode`` of a
two-element array, so the join runs once.  Rerunning with the same input
changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, StringType

from tidemart.operators.upsert import assert_unique_keys
from tidemart.functions.expressions import surrogate_key, ts_literal

VALID_FROM, VALID_TO, SCD_ID = "valid_from", "valid_to", "scd_id"
SCD_COLUMNS = (SCD_ID, VALID_FROM, VALID_TO)


def empty_history(current: DataFrame) -> DataFrame:
    """A history table with no rows and the snapshot schema of ``current``."""
    fields = list(current.schema.fields) + [
        StructField(SCD_ID, StringType(), True),
        StructField(VALID_FROM, TimestampNTZType(), True),
        StructField(VALID_TO, TimestampNTZType(), True),
    ]
    return current.sparkSession.createDataFrame([], StructType(fields))


def _changed(check_cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in check_cols:
        cond = cond | ~F.col(f"h.{c}").eqNullSafe(F.col(f"c.{c}"))
    return cond


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    as_of: str,
    check_cols: Sequence[str] | None = None,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """New full history after snapshotting ``current`` at ``as_of``.

    ``check_cols=None`` compares every non-key column of ``current``.
    """
    data_cols = current.columns
    if history is None:
        history = empty_history(current)
    check = [c for c in data_cols if c != key] if check_cols is None else list(check_cols)
    now = ts_literal(as_of)
    # A row without a key cannot be tracked (it would never match its own
    # history and would be reopened on every run); it is not snapshotted.
    current = current.filter(F.col(key).isNotNull())
    assert_unique_keys(current, key)
    if history.filter(F.col(VALID_TO).isNull() & (F.col(VALID_FROM) > now)).limit(1).count():
        raise ValueError(f"a snapshot at {as_of} lies before a version that is already open")

    closed = history.filter(F.col(VALID_TO).isNotNull())
    open_rows = history.filter(F.col(VALID_TO).isNull())

    h = open_rows.select(*data_cols, SCD_ID, VALID_FROM, F.lit(True).alias("__in_h")).alias("h")
    c = current.select(*data_cols, F.lit(True).alias("__in_c")).alias("c")
    j = h.join(c, F.col(f"h.{key}") == F.col(f"c.{key}"), "full_outer")

    in_h = F.col("h.__in_h").isNotNull()
    in_c = F.col("c.__in_c").isNotNull()
    changed = in_h & in_c & _changed(check)
    deleted = in_h & ~in_c

    close_at = F.when(changed, now)
    if invalidate_hard_deletes:
        close_at = close_at.when(deleted, now)

    old_version = F.when(
        in_h,
        F.struct(
            *[F.col(f"h.{x}").alias(x) for x in data_cols],
            F.col(f"h.{SCD_ID}").alias(SCD_ID),
            F.col(f"h.{VALID_FROM}").alias(VALID_FROM),
            close_at.cast(TimestampNTZType()).alias(VALID_TO),
        ),
    )
    new_key = F.col(f"c.{key}")
    new_version = F.when(
        in_c & (~in_h | changed),
        F.struct(
            *[F.col(f"c.{x}").alias(x) for x in data_cols],
            surrogate_key([new_key, now]).alias(SCD_ID),
            now.alias(VALID_FROM),
            F.lit(None).cast(TimestampNTZType()).alias(VALID_TO),
        ),
    )
    rows = j.select(F.explode(F.array_compact(F.array(old_version, new_version))).alias("r")).select("r.*")
    return closed.select(*rows.columns).unionByName(rows)


def current_rows(history: DataFrame) -> DataFrame:
    """Open (current) version of every live key."""
    return history.filter(F.col(VALID_TO).isNull())


def overlapping_periods(history: DataFrame, key: str) -> DataFrame:
    """Invariant check: keys with more than one open row.  Empty = valid."""
    return (
        current_rows(history)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("open_rows"))
        .filter(F.col("open_rows") > 1)
    )


def period_overlaps(history: DataFrame, key: str) -> DataFrame:
    """Invariant check: history rows whose period starts before the previous
    period of the same key has ended (or while it is still open).  Empty =
    valid.  A window per key ordered by valid_from; a key's history is its
    list of changes, so each window partition stays small."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(VALID_FROM, SCD_ID)
    prev_to = F.lag(F.col(VALID_TO)).over(w)
    prev_from = F.lag(F.col(VALID_FROM)).over(w)
    with_prev = history.select(key, SCD_ID, VALID_FROM, VALID_TO,
                               prev_from.alias("prev_valid_from"), prev_to.alias("prev_valid_to"))
    bad = F.col("prev_valid_from").isNotNull() & (
        F.col("prev_valid_to").isNull() | (F.col("prev_valid_to") > F.col(VALID_FROM))
    )
    return with_prev.filter(bad)


# Check columns of the two snapshots.
CUSTOMER_CHECK_COLUMNS = ("email", "country", "tier")
PRODUCT_CHECK_COLUMNS = ("sku", "product_name", "category", "list_price", "is_active")
CUSTOMER_SNAPSHOT_COLUMNS = ("customer_id", "email", "country", "tier", "created_at", "updated_at")
PRODUCT_SNAPSHOT_COLUMNS = (
    "product_id", "sku", "product_name", "description", "category", "list_price", "is_active", "updated_at",
)


def snap_customers(history: DataFrame | None, stg_customers: DataFrame, as_of: str) -> DataFrame:
    return scd2_apply(
        history, stg_customers.select(*CUSTOMER_SNAPSHOT_COLUMNS), "customer_id", as_of, CUSTOMER_CHECK_COLUMNS
    )


def snap_products(history: DataFrame | None, stg_products: DataFrame, as_of: str) -> DataFrame:
    return scd2_apply(
        history, stg_products.select(*PRODUCT_SNAPSHOT_COLUMNS), "product_id", as_of, PRODUCT_CHECK_COLUMNS
    )
