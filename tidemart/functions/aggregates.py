"""Grouped sums and counts together with one exact distinct count.

Spark plans ``groupBy(keys).agg(sum(...), count_distinct(x))`` by grouping on
(keys, x) first, so the partial sum buffers are shuffled once per distinct
(keys, x) — about once per input row when x is nearly unique per group —
and then again per keys.

Here every input row is emitted twice (``explode`` of a two-element array,
pipelined, nothing materialised):

* tag 0 carries the measures and no distinct value, so the first
  aggregation collapses it to one row per group and map task before the
  shuffle;
* tag 1 carries only the distinct value, so the first aggregation
  deduplicates (keys, value) map-side and the shuffle on (keys, tag, value)
  spreads a hot group over its values;
* a second aggregation by keys adds up the tag-0 partial measures and counts
  the tag-1 values.

One scan, two shuffles of narrow or group-level rows, no join; NULL group
keys behave exactly as in SQL ``GROUP BY``.  Sums are cast back to the type
a single ``sum`` would give, so downstream decimal arithmetic keeps its
precision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agg_with_distinct_count(
    df: DataFrame,
    keys: Sequence[tuple[str, Column]],
    sums: dict[str, Column],
    counts: dict[str, Column],
    distinct_col: str,
    distinct_alias: str,
) -> DataFrame:
    """``groupBy(keys)`` with ``sum`` of each ``sums`` expression, ``count``
    of each ``counts`` expression (non-NULL values; ``F.lit(1)`` for rows)
    and ``count_distinct(distinct_col)``.  ``keys`` are (output name,
    expression) pairs.  Output: keys, sums, counts, the distinct count."""
    key_names = [name for name, _ in keys]
    sum_types = {
        name: t.dataType for name, t in zip(sums, df.select(*[F.sum(e) for e in sums.values()]).schema.fields)
    } if sums else {}
    base = df.select(
        *[expr.alias(name) for name, expr in keys],
        F.col(distinct_col).alias("__d"),
        *[e.alias(f"__s_{a}") for a, e in sums.items()],
        *[e.isNotNull().cast("long").alias(f"__c_{a}") for a, e in counts.items()],
    )
    tagged = base.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("__g"))
    is_measure = F.col("__g") == 0
    first = tagged.groupBy(
        *key_names, "__g", F.when(~is_measure, F.col("__d")).alias("__v")
    ).agg(
        *[F.sum(F.when(is_measure, F.col(f"__s_{a}"))).alias(f"__s_{a}") for a in sums],
        *[F.sum(F.when(is_measure, F.col(f"__c_{a}"))).alias(f"__c_{a}") for a in counts],
    )
    second = first.groupBy(*key_names).agg(
        *[F.sum(f"__s_{a}").cast(sum_types[a]).alias(a) for a in sums],
        *[F.coalesce(F.sum(f"__c_{a}"), F.lit(0)).cast("long").alias(a) for a in counts],
        F.count(F.when(F.col("__g") == 1, F.col("__v"))).alias(distinct_alias),
    )
    return second
