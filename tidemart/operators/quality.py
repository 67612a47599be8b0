"""Data tests.  Each test returns the DataFrame of failing rows; empty = pass.

Generic tests are column-level filters, group counts or anti-joins.  The
summary runs every declared application and reports one row per test.  Row
tests are counted while a model is written, or in one aggregate over it; all
uniqueness tests share one count of key hashes and an exact second look at
those that repeat; all relationships share one grouped aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.expressions import (
    CUSTOMER_TIERS,
    LTV_SEGMENTS,
    ORDER_STATUSES,
    RECENCY_SEGMENTS,
    TYPES,
    is_revenue_status,
    ts_literal,
)
from tidemart.functions.numeric import difference
from tidemart.session import scratch_path

# --- generic tests -----------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def non_negative(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value below zero; NULL passes."""
    return df.filter(F.col(column) < 0)


def values_in_set(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose non-NULL value is outside ``values`` (accepted_values with
    NULL allowed)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*values))


accepted_values = values_in_set


def recent_timestamp(df: DataFrame, column: str, as_of: str, max_age_days: int = 1) -> DataFrame:
    """Rows older than ``as_of`` minus ``max_age_days`` days."""
    cutoff = F.timestamp_add("DAY", F.lit(-max_age_days), ts_literal(as_of))
    return df.filter(F.col(column) < cutoff)


def within_range(df: DataFrame, column: str, min_value, max_value) -> DataFrame:
    """Rows with a value NOT BETWEEN min and max (NULL passes)."""
    return df.filter(~F.col(column).between(min_value, max_value))


def fits_type(df: DataFrame, column: str, type_name: str) -> DataFrame:
    """Rows whose raw text is a number that ``type_name`` can't hold; other text and NULL pass."""
    return df.filter(_lost(F.col(column), type_name))


def _lost(c: Column, type_name: str) -> Column:
    return c.try_cast("double").isNotNull() & c.try_cast(TYPES[type_name]).isNull()


def computed(df: DataFrame, column: str, inputs: Sequence[str]) -> DataFrame:
    """Rows where ``column`` is NULL though all it is computed from is there: the result didn't fit."""
    return df.filter(_uncomputed(column, inputs))


def _uncomputed(column: str, inputs: Sequence[str]) -> Column:
    out = F.col(column).isNull()
    for c in inputs:
        out = out & F.col(c).isNotNull()
    return out


def unique(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-NULL values with their row count.  Partial aggregation
    runs before the shuffle, so a hot value costs one row per map task."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Duplicated combinations of ``columns`` (NULL is a value here)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent (anti-join;
    AQE broadcasts the parent keys only if their measured size is small)."""
    keys = parent.select(F.col(field_name).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("__parent_key"), "left_anti"
    )


# --- singular tests -------------------------------------------------------------

ORPHAN_REPORT_LIMIT = 100


def no_orphaned_order_items(stg_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Lines whose order is missing or cancelled; the first 100 by key.

    The reference's LIMIT has no order; sorting by the line key first makes
    the report deterministic.  ``orderBy + limit`` plans as a top-k
    (TakeOrderedAndProject): each task keeps 100 rows, the driver merges.
    """
    status = stg_orders.select("order_id", (F.col("order_status") == "cancelled").alias("cancelled"))

    def failing(lines: DataFrame, orders: DataFrame) -> DataFrame:
        j = lines.alias("oi").join(orders.alias("o"), F.col("oi.order_id") == F.col("o.order_id"), "left")
        return j.filter(F.col("o.order_id").isNull() | F.col("o.cancelled"))

    # The join of all lines carries their order ids only.  The report's lines belong to the first
    # ids found, and just these orders' lines are looked up with their keys.
    first = (failing(stg_items.select("order_id"), status).select(F.col("oi.order_id").alias("__first"))
             .orderBy("__first").limit(ORPHAN_REPORT_LIMIT).distinct())

    def of_first(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(first), F.col("order_id").eqNullSafe(F.col("__first")), "left_semi")

    return (
        failing(of_first(stg_items), of_first(status)).select(
            F.col("oi.order_id").alias("order_id"),
            F.col("oi.line_item_id").alias("line_item_id"),
            F.col("oi.order_item_sk").alias("order_item_sk"),
        )
        .orderBy("order_id", "line_item_id", "order_item_sk")
        .limit(ORPHAN_REPORT_LIMIT)
    )


def revenue_reconciliation(ledger: DataFrame, fct: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """One row (ledger_total, fact_total, delta) when the ledger's gross
    revenue and the revenue orders' total differ by more than ``tolerance``.

    The two global sums are stacked as tagged rows and folded into one row by
    a conditional aggregate: no join between the two totals is needed.
    """
    ledger_rows = ledger.select(F.lit("ledger").alias("side"), F.col("gross_revenue").alias("amount"))
    fact_rows = fct.filter(is_revenue_status("order_status")).select(
        F.lit("fact").alias("side"), F.col("order_total_amount").alias("amount")
    )
    both = ledger_rows.unionByName(fact_rows).agg(
        F.sum(F.when(F.col("side") == "ledger", F.col("amount"))).alias("ledger_total"),
        F.sum(F.when(F.col("side") == "fact", F.col("amount"))).alias("fact_total"),
    )
    out = both.select(
        "ledger_total",
        "fact_total",
        difference(F.col("ledger_total"), F.col("fact_total")).alias("delta"),
    )
    limit = F.lit(tolerance).cast("decimal(10,4)")
    return out.filter((F.col("delta") > limit) | (F.col("delta") < -limit))


def discount_below_one(fct_items: DataFrame) -> DataFrame:
    """Lines with a discount of 100 % or more."""
    return fct_items.filter(F.col("discount_pct") >= 1.0).select("order_item_sk")


# --- declared applications ------------------------------------------------------


@dataclass(frozen=True)
class CheckSpec:
    model: str
    test: str
    column: str
    args: dict = field(default_factory=dict)


# Primary key (or grain) of each model, used to name failing rows.
MODEL_KEYS: dict[str, tuple[str, ...]] = {
    "raw_orders": ("order_id",),
    "raw_customers": ("customer_id",),
    "raw_order_items": ("order_id", "line_item_id"),
    "raw_products": ("product_id",),
    "raw_sessions": ("session_id",),
    "stg_orders": ("order_sk",),
    "stg_customers": ("customer_sk",),
    "stg_order_items": ("order_item_sk",),
    "stg_products": ("product_sk",),
    "stg_sessions": ("session_sk",),
    "dim_customer": ("customer_sk",),
    "dim_product": ("product_sk",),
    "fct_orders": ("order_sk",),
    "fct_order_items": ("order_item_sk",),
    "revenue_ledger": ("revenue_date", "currency", "customer_country", "customer_tier"),
    "customer_ltv": ("customer_sk",),
    "session_funnel": ("funnel_date", "traffic_source", "device_type"),
}


def _specs() -> list[CheckSpec]:
    # Which test applies to which column of which model.
    s: list[CheckSpec] = []

    def add(model, column, *tests):
        for t in tests:
            if isinstance(t, tuple):
                s.append(CheckSpec(model, t[0], column, t[1]))
            else:
                s.append(CheckSpec(model, t, column))

    # raw sources, before any row is filtered or normalised
    add("raw_orders", "order_id", "unique", "not_null")
    add("raw_orders", "customer_id", "not_null")
    add("raw_orders", "order_status", ("values_in_set", {"values": ORDER_STATUSES}))
    add("raw_orders", "total_amount", "non_negative")
    add("raw_orders", "placed_at", "not_null")
    add("raw_orders", "_loaded_at", "not_null")
    add("raw_customers", "customer_id", "unique", "not_null")
    add("raw_customers", "email", "not_null")
    add("raw_order_items", "order_id", "not_null")
    add("raw_order_items", "line_item_id", "not_null")
    add("raw_order_items", "quantity", "non_negative")
    add("raw_order_items", "order_id,line_item_id", "unique_combination")
    add("raw_products", "product_id", "unique", "not_null")
    add("raw_products", "sku", "unique", "not_null")
    add("raw_products", "price", "non_negative")
    add("raw_sessions", "session_id", "unique", "not_null")
    add("raw_sessions", "started_at", "not_null")
    # staging
    add("stg_orders", "order_id", "unique", "not_null")
    add("stg_orders", "order_sk", "unique", "not_null")
    add("stg_orders", "customer_id", "not_null",
        ("relationships", {"to": "stg_customers", "field": "customer_id"}))
    add("stg_orders", "order_status", ("values_in_set", {"values": ORDER_STATUSES}))
    add("stg_orders", "total_amount", "non_negative")
    add("stg_orders", "placed_at", "not_null")
    add("stg_orders", "order_date", "not_null")
    add("stg_orders", "_loaded_at", "not_null")
    add("stg_customers", "customer_id", "unique", "not_null")
    add("stg_customers", "customer_sk", "unique", "not_null")
    add("stg_customers", "email", "unique", "not_null")
    add("stg_customers", "tier", ("values_in_set", {"values": CUSTOMER_TIERS}))
    add("stg_customers", "country", "not_null")
    add("stg_order_items", "order_item_sk", "unique", "not_null")
    add("stg_order_items", "order_id", "not_null",
        ("relationships", {"to": "stg_orders", "field": "order_id"}))
    add("stg_order_items", "line_item_id", "not_null")
    add("stg_order_items", "quantity", "non_negative")
    add("stg_order_items", "line_net_amount", "non_negative")
    add("stg_order_items", "order_id,line_item_id", "unique_combination")
    add("stg_products", "product_id", "unique", "not_null")
    add("stg_products", "sku", "unique", "not_null")
    add("stg_products", "list_price", "non_negative")
    add("stg_sessions", "session_sk", "unique", "not_null")
    add("stg_sessions", "session_id", "unique", "not_null")
    add("stg_sessions", "started_at", "not_null")
    # marts
    add("dim_customer", "customer_sk", "unique", "not_null")
    add("dim_customer", "customer_id", "unique", "not_null")
    add("dim_customer", "email", "not_null")
    add("dim_customer", "country", "not_null")
    add("dim_customer", "tier", ("values_in_set", {"values": CUSTOMER_TIERS}))
    add("dim_customer", "lifetime_order_count", "non_negative")
    add("dim_customer", "lifetime_gross_revenue", "non_negative")
    add("dim_customer", "recency_segment", ("values_in_set", {"values": RECENCY_SEGMENTS}))
    add("dim_product", "product_sk", "unique", "not_null")
    add("dim_product", "product_id", "unique", "not_null")
    add("dim_product", "sku", "unique", "not_null")
    add("dim_product", "list_price", "non_negative")
    add("fct_orders", "order_sk", "unique", "not_null")
    add("fct_orders", "order_id", "unique", "not_null")
    add("fct_orders", "customer_sk", "not_null",
        ("relationships", {"to": "dim_customer", "field": "customer_sk"}))
    add("fct_orders", "order_total_amount", "non_negative")
    add("fct_orders", "order_date", "not_null")
    add("fct_order_items", "order_item_sk", "unique", "not_null")
    add("fct_order_items", "order_id", "not_null",
        ("relationships", {"to": "fct_orders", "field": "order_id"}))
    add("fct_order_items", "product_id", "not_null",
        ("relationships", {"to": "dim_product", "field": "product_id"}))
    add("fct_order_items", "line_net_amount", "non_negative")
    add("revenue_ledger", "revenue_date", "not_null")
    add("revenue_ledger", "order_count", "non_negative")
    add("revenue_ledger", "gross_revenue", "non_negative")
    add("revenue_ledger", "net_revenue", "non_negative")
    add("customer_ltv", "customer_sk", "unique", "not_null")
    add("customer_ltv", "ltv_segment", ("values_in_set", {"values": LTV_SEGMENTS}))
    add("session_funnel", "funnel_date", "not_null")
    add("session_funnel", "traffic_source", "not_null")
    add("session_funnel", "session_count", "non_negative")
    # numbers that their types can't hold (this library's own)
    for column, kind in (("quantity", "INT64"), ("unit_price", "NUMERIC"), ("discount", "NUMERIC")):
        add("raw_order_items", column, ("fits_type", {"type": kind}))
    add("raw_orders", "total_amount", ("fits_type", {"type": "NUMERIC"}))
    add("raw_products", "price", ("fits_type", {"type": "NUMERIC"}))
    add("stg_order_items", "line_gross_amount", ("computed", {"inputs": ("quantity", "unit_price")}))
    add("stg_order_items", "line_net_amount", ("computed", {"inputs": ("line_gross_amount", "discount_pct")}))
    # singular tests
    add("stg_order_items", "order_id", "no_orphaned_order_items")
    add("revenue_ledger", "gross_revenue", "revenue_reconciliation")
    add("fct_order_items", "discount_pct", "discount_below_one")
    return s


DECLARED_TESTS: list[CheckSpec] = _specs()

# Singular test -> failing rows from the models.
SINGULAR_TESTS = {
    "no_orphaned_order_items": lambda m: no_orphaned_order_items(m["stg_order_items"], m["stg_orders"]),
    "revenue_reconciliation": lambda m: revenue_reconciliation(m["revenue_ledger"], m["fct_orders"]),
    "discount_below_one": lambda m: discount_below_one(m["fct_order_items"]),
}

ROW_TESTS = ("not_null", "non_negative", "values_in_set", "recent_timestamp", "within_range", "fits_type", "computed")


def row_condition(spec: CheckSpec, as_of: str | None = None) -> Column:
    """Predicate that is TRUE exactly on a failing row of a row-level test."""
    c = F.col(spec.column)
    if spec.test == "not_null":
        return c.isNull()
    if spec.test == "non_negative":
        if spec.model.startswith("raw_"):  # raw amounts are text
            c = c.try_cast("double")
        return F.coalesce(c < 0, F.lit(False))
    if spec.test == "values_in_set":
        return c.isNotNull() & ~c.isin(*spec.args["values"])
    if spec.test == "recent_timestamp":
        cutoff = F.timestamp_add("DAY", F.lit(-spec.args.get("max_age_days", 1)), ts_literal(as_of))
        return F.coalesce(c < cutoff, F.lit(False))
    if spec.test == "fits_type":
        return _lost(c, spec.args["type"])
    if spec.test == "computed":
        return _uncomputed(spec.column, spec.args["inputs"])
    if spec.test == "within_range":
        return F.coalesce(~c.between(spec.args["min_value"], spec.args["max_value"]), F.lit(False))
    raise ValueError(spec.test)


def row_key(model: str) -> Column:
    keys = MODEL_KEYS[model]
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def failing_rows(models: dict[str, DataFrame], specs: Sequence[CheckSpec], as_of: str | None = None) -> DataFrame:
    """Union of failing rows of row-level tests as (model, test_name,
    column_name, row_id).  Each model is scanned once for all its tests:
    the per-test predicates become a tagged array that is exploded."""
    parts = []
    by_model: dict[str, list[CheckSpec]] = {}
    for spec in specs:
        by_model.setdefault(spec.model, []).append(spec)
    for model, model_specs in by_model.items():
        df = models[model]
        if all(sp.test == "not_null" for sp in model_specs):  # cheap to evaluate: reaches the scans below the model's joins
            df = df.filter(reduce(or_, [row_condition(sp, as_of) for sp in model_specs]))
        # An outer explode: for an inner one Spark would evaluate every test a second time, as a filter below it.
        tags = F.array(
            *[
                F.when(
                    row_condition(sp, as_of),
                    F.struct(F.lit(sp.test).alias("test_name"), F.lit(sp.column).alias("column_name")),
                )
                for sp in model_specs
            ]
        )
        hits = df.select(row_key(model).alias("row_id"), F.explode_outer(tags).alias("t")).filter(F.col("t").isNotNull())
        parts.append(
            hits.select(F.lit(model).alias("model"), "t.test_name", "t.column_name", "row_id")
        )
    return _union(parts)


def _hash(columns: Sequence[str], buckets: int | None) -> Column:
    h = F.xxhash64(*[F.col(c) for c in columns])
    return h if buckets is None else F.pmod(h, F.lit(buckets).cast("bigint"))


def _tested_keys(models: dict[str, DataFrame], specs: Sequence[CheckSpec | None], buckets: int | None, whole: bool) -> DataFrame:
    """(tag, h[, key]): for each row and uniqueness test the test's number,
    the key's 64-bit hash and, if asked for, the key itself as an array of
    texts (NULL stays NULL there).  A model is read once for all its tests;
    None in place of a test leaves it out."""
    parts = []
    by_model: dict[str, list[tuple[int, CheckSpec]]] = {}
    for tag, sp in enumerate(specs):
        if sp is not None:
            by_model.setdefault(sp.model, []).append((tag, sp))
    for model, tagged in by_model.items():
        entries = []
        for tag, sp in tagged:
            cols = sp.column.split(",")
            fields = [F.lit(tag).cast("smallint").alias("tag"), _hash(cols, buckets).alias("h")]
            if whole:
                fields.append(F.array(*[F.col(c).cast("string") for c in cols]).alias("key"))
            entry = F.struct(*fields)
            if sp.test == "unique":  # NULL is not a duplicate for ``unique``
                entry = F.when(F.col(cols[0]).isNotNull(), entry)
            entries.append(entry)
        parts.append(models[model].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    return _union(parts)


#: Repeated hashes are broadcast up to so many (a test's number and 8 bytes each); beyond it bitmaps of them are.
BROADCAST_HASHES = 1_000_000
#: Bits for each repeated hash in the bitmaps (one in so many other keys passes them), and in all bitmaps at most (64 MB).
BITS_PER_HASH, MOST_BITS = 16, 1 << 29


def _bit(h: Column, n_hashes: int) -> Column:
    """Number of a hash's bit, from 1: Spark's bitmaps count so."""
    bits = min(MOST_BITS, 1 << (max(n_hashes, 1) * BITS_PER_HASH - 1).bit_length())
    return F.pmod(h, F.lit(bits).cast("bigint")) + 1


def _marked(repeated: DataFrame, n_hashes: int) -> DataFrame:
    """Bitmaps (32,768 bits in a row) of the hashes that repeat in any test."""
    bit = _bit(F.col("h"), n_hashes)
    return (repeated.select(F.bitmap_bucket_number(bit).alias("bitmap"), F.bitmap_bit_position(bit).alias("position"))
            .groupBy("bitmap").agg(F.bitmap_construct_agg("position").alias("marks")))


def _suspect_keys(models: dict[str, DataFrame], sp: CheckSpec, tag: int, buckets: int | None, repeated: DataFrame,
                  marked: DataFrame, n_hashes: int) -> DataFrame:
    """(tag, key) of one uniqueness test's rows whose hash is among the repeated
    ones, or hits a mark of the bitmaps: all equal keys, and few others."""
    cols = sp.column.split(",")
    df, h = models[sp.model], _hash(cols, buckets)
    if sp.test == "unique":
        df = df.filter(F.col(cols[0]).isNotNull())
    if n_hashes <= BROADCAST_HASHES:
        own = repeated.filter(F.col("tag") == tag).select(F.col("h").alias("__h"))
        found = df.join(F.broadcast(own), h == F.col("__h"), "left_semi")
    else:
        bit = _bit(h, n_hashes)
        position = F.bitmap_bit_position(bit)
        byte = F.conv(F.hex(F.substring(F.col("marks"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.getbit(byte, (position % 8).cast("int")) == 1
        found = df.join(F.broadcast(marked), (F.bitmap_bucket_number(bit) == F.col("bitmap")) & hit, "left_semi")
    return found.select(F.lit(tag).cast("smallint").alias("tag"), F.array(*[F.col(c).cast("string") for c in cols]).alias("key"))


def duplicate_keys(models: dict[str, DataFrame], specs: Sequence[CheckSpec], buckets: int | None = None) -> DataFrame:
    """Union of ``unique`` / ``unique_combination`` failures as (model,
    test_name, column_name, key_value, n_rows), exact, in two phases.

    First all tests of all models share one count of 64-bit key hashes: a hot
    key collapses map-side, and the shuffle carries 8 bytes and a test's
    number for each distinct value.  Equal keys have equal hashes, so only
    the few keys whose hash repeats enter the second, exact grouping by the
    keys themselves, where a mere collision of hashes falls out again.
    The repeated hashes, or bitmaps of them where they are many, are broadcast:
    rows with other keys are dropped without a shuffle of the tested keys.
    ``buckets`` narrows the hashes (for tests of such collisions).
    """
    hashes = _tested_keys(models, specs, buckets, whole=False)
    repeated = hashes.groupBy("tag", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("tag", "h")
    path = scratch_path(repeated.sparkSession, "repeated-hashes")
    repeated.write.parquet(path)
    repeated = repeated.sparkSession.read.schema(repeated.schema).parquet(path)
    n_hashes = repeated.count()
    suspects = [specs[r["tag"]] for r in repeated.select("tag").distinct().collect()] if n_hashes else []
    names = repeated.sparkSession.createDataFrame(
        [(tag, sp.model, sp.test, sp.column) for tag, sp in enumerate(specs)],
        "tag smallint, model string, test_name string, column_name string")
    if not suspects:  # no model is read again
        return names.filter("false").select("model", "test_name", "column_name", F.lit("").alias("key_value"),
                                            F.lit(0).cast("bigint").alias("n_rows"))
    marked = _marked(repeated, n_hashes)
    keys = _union([_suspect_keys(models, sp, tag, buckets, repeated, marked, n_hashes)
                   for tag, sp in enumerate(specs) if sp in suspects])
    dup = keys.groupBy("tag", "key").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    return dup.join(F.broadcast(names), "tag").select(
        "model", "test_name", "column_name", F.concat_ws("|", "key").alias("key_value"), "n_rows")


def _relation_keys(models: dict[str, DataFrame], specs: Sequence[CheckSpec]) -> DataFrame:
    """(tag, key, children) of all relationships without a parent: children
    and parents of every relationship are stacked and counted in one grouped
    aggregation by (relationship, key).  Keys collapse map-side, so a hot key
    costs one row a map task; NULL keys take no part."""
    parts = []
    by_model: dict[str, list[Column]] = {}  # a model is read once for all its relationships
    for tag, sp in enumerate(specs):
        for model, column, is_parent in ((sp.model, sp.column, False), (sp.args["to"], sp.args["field"], True)):
            by_model.setdefault(model, []).append(F.when(F.col(column).isNotNull(), F.struct(
                F.lit(tag).cast("smallint").alias("tag"), F.col(column).cast("string").alias("key"),
                F.lit(0 if is_parent else 1).cast("bigint").alias("children"), F.lit(is_parent).alias("parent"))))
    for model, entries in by_model.items():
        parts.append(models[model].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    return (_union(parts).groupBy("tag", "key").agg(F.sum("children").alias("children"), F.max("parent").alias("parent"))
            .filter(~F.col("parent")).select("tag", "key", "children"))


def orphan_keys(models: dict[str, DataFrame], specs: Sequence[CheckSpec]) -> DataFrame:
    """Union of ``relationships`` failures as (model, test_name, column_name,
    row_id, key_value).  The orphans of all relationships are found together
    (``_relation_keys``); only then are the rows of those that have any looked
    up, by a semi join."""
    orphans = _relation_keys(models, specs)
    path = scratch_path(orphans.sparkSession, "orphan-keys")
    orphans.write.parquet(path)
    orphans = orphans.sparkSession.read.schema(orphans.schema).parquet(path)
    n_keys = dict(map(tuple, orphans.groupBy("tag").count().collect()))  # a row a relationship
    parts = []
    for tag, sp in enumerate(specs):
        own = orphans.filter(F.col("tag") == tag).select(F.col("key").alias("__key"))
        df = models[sp.model] if tag in n_keys else models[sp.model].filter("false")
        rows = df.join(F.broadcast(own) if n_keys.get(tag, 0) <= BROADCAST_HASHES else own,
                       F.col(sp.column).cast("string") == F.col("__key"), "left_semi")
        parts.append(rows.select(
            F.lit(sp.model).alias("model"), F.lit(sp.test).alias("test_name"), F.lit(sp.column).alias("column_name"),
            row_key(sp.model).alias("row_id"), F.col(sp.column).cast("string").alias("key_value")))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(model: str, specs: Sequence[CheckSpec] | None = None, as_of: str | None = None) -> dict[str, Column]:
    """Failing rows of each row-level test of a model as aggregates, named
    ``test:column``.  They can be observed while the model is written, so
    that the tests cost no scan of their own."""
    return {f"{sp.test}:{sp.column}": F.count_if(row_condition(sp, as_of))
            for sp in (DECLARED_TESTS if specs is None else specs) if sp.model == model and sp.test in ROW_TESTS}


def dq_summary(models: dict[str, DataFrame], specs: Sequence[CheckSpec] | None = None,
               as_of: str | None = None, observed: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """One row per declared test: (model, test_name, column_name,
    failing_rows, status).

    Row-level tests of a model were counted while it was written
    (``observed``: model -> ``test:column`` -> rows, see ``row_counts``) or
    share one aggregate over a single scan; uniqueness tests of all models
    share the two phases of ``duplicate_keys``; all relationships share one
    grouped aggregation; the singular tests run by themselves.
    """
    spark = SparkSession.getActiveSession()
    specs = DECLARED_TESTS if specs is None else specs
    observed = observed or {}
    parts, known = [], []
    by_model: dict[str, list[CheckSpec]] = {}
    for sp in specs:
        if sp.test in ROW_TESTS:
            count = observed.get(sp.model, {}).get(f"{sp.test}:{sp.column}")
            if count is None:
                by_model.setdefault(sp.model, []).append(sp)
            else:
                known.append((sp.model, sp.test, sp.column, count))
    for model, own in by_model.items():
        counts = models[model].agg(*[c.alias(f"c{i}") for i, c in enumerate(row_counts(model, own, as_of).values())])
        entries = [F.struct(F.lit(sp.test).alias("test_name"), F.lit(sp.column).alias("column_name"),
                            F.col(f"c{i}").alias("failing_rows")) for i, sp in enumerate(own)]
        parts.append(counts.select(F.explode(F.array(*entries)).alias("r")).select(F.lit(model).alias("model"), "r.*"))
    counted = []  # (model, test, column) with the number of failing keys or rows, where there are any
    unique_specs = [s for s in specs if s.test in ("unique", "unique_combination")]
    if unique_specs:
        duplicates = duplicate_keys(models, unique_specs)
        counted.append(duplicates.groupBy("model", "test_name", "column_name").agg(F.count(F.lit(1)).alias("failing_rows")))
    relations = [s for s in specs if s.test == "relationships"]
    if relations:
        lost = _relation_keys(models, relations).groupBy("tag").agg(F.sum("children").alias("failing_rows"))
        names = spark.createDataFrame([(tag, s.model, s.test, s.column) for tag, s in enumerate(relations)],
                                      "tag smallint, model string, test_name string, column_name string")
        counted.append(names.join(lost, "tag").select("model", "test_name", "column_name", "failing_rows"))
    for sp in specs:
        if sp.test in SINGULAR_TESTS:
            failing = SINGULAR_TESTS[sp.test](models).agg(F.count(F.lit(1)).alias("failing_rows"))
            parts.append(failing.select(F.lit(sp.model).alias("model"), F.lit(sp.test).alias("test_name"),
                                        F.lit(sp.column).alias("column_name"), "failing_rows"))
    # Tests without a failing key have no row above: each starts from 0.
    zero = [(s.model, s.test, s.column, 0) for s in unique_specs + relations]
    parts.append(spark.createDataFrame(known + zero, "model string, test_name string, column_name string, failing_rows bigint"))
    out = _union(parts + counted).groupBy("model", "test_name", "column_name").agg(F.sum("failing_rows").alias("failing_rows"))
    return out.withColumn("status", F.when(F.col("failing_rows") == 0, F.lit("pass")).otherwise(F.lit("fail")))
