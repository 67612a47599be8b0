"""Surrogate keys that needn't travel: a key is a digest of ids of its own row,
64 characters that no codec shortens below 32 bytes.  Before a shuffle, or in an
intermediate table, it is left out where it equals that digest, and is computed
anew behind it.  Any other value (a digest of an id's unusual text, NULL) is
carried, so every row comes back as it was."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemart.functions.expressions import surrogate_key

#: Surrogate keys and the ids that they are usually a digest of.
SURROGATE_KEYS = {
    "order_sk": ("order_id",),
    "order_item_sk": ("order_id", "line_item_id"),
    "customer_sk": ("customer_id",),
    "product_sk": ("product_id",),
    "session_sk": ("session_id",),
}


def _odd(key: str) -> str:
    return f"__odd_{key}"


def without_digests(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` with each surrogate key (but those in ``keep``) replaced by what
    can't be computed from its ids: NULL, or an array of the value it has instead."""
    keys = {k: ids for k, ids in SURROGATE_KEYS.items() if k in df.columns and k not in keep
            and set(ids) <= set(df.columns) and isinstance(df.schema[k].dataType, StringType)}
    if not keys:
        return df
    odd = [F.when(~F.col(k).eqNullSafe(surrogate_key(ids)), F.array(k)).alias(_odd(k)) for k, ids in keys.items()]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in keys], *odd)


def digest(key: str, columns: Sequence[str], alias: str = "") -> Column:
    """A surrogate key of a ``without_digests`` table with these columns."""
    of = lambda c: F.col(f"{alias}.{c}" if alias else c)
    if _odd(key) not in columns:
        return of(key)
    return F.when(of(_odd(key)).isNull(), surrogate_key([of(i) for i in SURROGATE_KEYS[key]])).otherwise(F.get(of(_odd(key)), F.lit(0)))


def with_digests(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, from ``without_digests`` of a table that had it."""
    return df.select(*[digest(f.name, df.columns).alias(f.name, metadata=f.metadata) if f.name in SURROGATE_KEYS
                       else F.col(f"`{f.name}`") for f in schema.fields])
