"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query builds the model graph over the driver's test tables at
``sf_dir`` and returns one model or operator result.  Outputs pass through
``for_compare``: decimal money is rounded to 4 digits and returned as double,
32-bit integers widen to bigint, so results line up with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType, ByteType

from tidemart.plans.graph import ModelGraph
from tidemart.plans.staging import BUILT_AT

Query = Callable[[SparkSession, str], DataFrame]


def for_compare(df: DataFrame) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            c = F.round(c, 4).cast("double")
        elif isinstance(field.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def _graph(spark: SparkSession, sf_dir: str) -> ModelGraph:
    return ModelGraph.from_testdata(spark, sf_dir)


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return for_compare(_graph(spark, sf_dir).model(name))

    run.__name__ = name
    return run


MODEL_QUERIES = (
    "stg_orders", "stg_customers", "stg_products", "stg_order_items", "stg_sessions",
    "order_items_rollup", "int_orders_enriched", "customer_rollup",
    "int_customer_lifetime_metrics", "dim_product", "dim_customer", "customer_ltv",
    "fct_orders", "fct_order_items", "revenue_ledger", "daily_sessions",
    "daily_conversions", "session_funnel",
)

QUERIES: dict[str, Query] = {name: _model_query(name) for name in MODEL_QUERIES}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@register("filter_revenue_orders")
def q_filter_revenue_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.plans.intermediate import filter_revenue_orders

    g = _graph(spark, sf_dir)
    return for_compare(
        filter_revenue_orders(g.stg_orders).select("order_id", "customer_id", "order_status", "total_amount")
    )


@register("surrogate_key")
def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return g.stg_order_items.select("order_id", "line_item_id", "order_item_sk")


@register("line_amounts_exact")
def q_line_amounts_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All digits of the line amounts as text, over the lines with planted
    prices, quantities and discounts of every size."""
    lines = _faulty_graph(spark, sf_dir).stg_order_items
    return lines.select("order_item_sk", *[
        F.col(c).cast("string").alias(c) for c in ("quantity", "unit_price", "discount_pct", "line_gross_amount", "line_net_amount")])


@register("order_total_mismatch")
def q_order_total_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return for_compare(
        g.int_orders_enriched.select(
            "order_id", "order_total_amount", "items_net_amount", "has_total_mismatch"
        )
    )


@register("recency_segment")
def q_recency_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return g.int_customer_lifetime_metrics.groupBy("recency_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("days_since_last_order").alias("min_days"),
        F.max("days_since_last_order").alias("max_days"),
    )


# --- data tests ------------------------------------------------------------------


class _Models(dict):
    """Model name -> DataFrame, built on demand from a ModelGraph."""

    def __init__(self, graph: ModelGraph):
        super().__init__()
        self.graph = graph

    def __missing__(self, name: str) -> DataFrame:
        df = self.graph.model(name)
        self[name] = df
        return df


def _specs_of(test: str):
    from tidemart.operators.quality import DECLARED_TESTS

    return [s for s in DECLARED_TESTS if s.test == test]


# Applications of the tests the reference defines but applies nowhere.
def recent_timestamp_specs():
    from tidemart.operators.quality import CheckSpec

    return [
        CheckSpec(m, "recent_timestamp", "_loaded_at", {"max_age_days": 1})
        for m in ("stg_orders", "stg_customers", "stg_products", "stg_order_items", "stg_sessions")
    ]


def within_range_specs():
    from tidemart.operators.quality import CheckSpec

    return [CheckSpec("stg_order_items", "within_range", "discount_pct", {"min_value": 0, "max_value": 1})]


def _faulty_graph(spark: SparkSession, sf_dir: str) -> ModelGraph:
    return ModelGraph.from_faulty_testdata(spark, sf_dir)


def _row_test_query(test: str, specs_fn=None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tidemart.operators.quality import failing_rows

        g = _faulty_graph(spark, sf_dir)
        specs = specs_fn() if specs_fn else _specs_of(test)
        return failing_rows(_Models(g), specs, g.as_of)

    return run


QUERIES["test_not_null"] = _row_test_query("not_null")
QUERIES["test_non_negative"] = _row_test_query("non_negative")
QUERIES["test_values_in_set"] = _row_test_query("values_in_set")
QUERIES["test_recent_timestamp"] = _row_test_query("recent_timestamp", recent_timestamp_specs)
QUERIES["test_fits_type"] = _row_test_query("fits_type")
QUERIES["test_computed"] = _row_test_query("computed")
QUERIES["test_within_range"] = _row_test_query("within_range", within_range_specs)


@register("test_unique")
def q_test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.quality import duplicate_keys

    return duplicate_keys(_Models(_faulty_graph(spark, sf_dir)), _specs_of("unique"))


@register("test_unique_combination")
def q_test_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.quality import duplicate_keys

    return duplicate_keys(_Models(_faulty_graph(spark, sf_dir)), _specs_of("unique_combination"))


@register("test_relationships")
def q_test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.quality import orphan_keys

    return orphan_keys(_Models(_graph(spark, sf_dir)), _specs_of("relationships"))


@register("test_no_orphaned_order_items")
def q_test_no_orphaned_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.quality import no_orphaned_order_items

    g = _graph(spark, sf_dir)
    return no_orphaned_order_items(g.stg_order_items, g.stg_orders)


@register("test_revenue_reconciliation")
def q_test_revenue_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger last built on 2001-01-01 against the facts of 2001-08-02."""
    from tidemart.operators.quality import revenue_reconciliation
    from tidemart.plans.marts import revenue_ledger
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    return for_compare(revenue_reconciliation(revenue_ledger(R.orders_batch1(g), g.as_of), g.fct_orders))


@register("test_discount_below_one")
def q_test_discount_below_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.quality import discount_below_one

    return discount_below_one(_faulty_graph(spark, sf_dir).fct_order_items)


@register("dq_summary")
def q_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test over the faulty tables.  Each model is written once, which
    counts its row-level tests, and read back by the others.  The facts are
    written one after another, and so are the results of the groups of tests
    that shuffle: the shuffles of one lie on disk at a time."""
    from tidemart.operators.quality import DECLARED_TESTS, SINGULAR_TESTS, dq_summary, row_counts
    from tidemart.session import scratch_path, shuffles_released
    from tidemart.sinks.stored import store

    g = _faulty_graph(spark, sf_dir)
    specs = list(DECLARED_TESTS) + recent_timestamp_specs() + within_range_specs()
    observed = {}
    for models in (("stg_orders", "stg_customers", "stg_products", "stg_order_items", "stg_sessions"),
                   ("fct_orders",), ("fct_order_items",), ("dim_customer", "dim_product", "session_funnel"),
                   ("revenue_ledger", "customer_ltv")):
        observed |= g.materialize(*models, count=lambda model: row_counts(model, specs, g.as_of))
    groups: dict[str, list] = {}
    for sp in specs:
        alone = sp.test in SINGULAR_TESTS or sp.test == "relationships"
        groups.setdefault(sp.test if alone else "other", []).append(sp)
    found = []
    for own in groups.values():
        with shuffles_released(spark):
            found.append(store(dq_summary(_Models(g), own, g.as_of, observed), scratch_path(spark, "dq-summary")))
    return reduce(DataFrame.unionByName, found)


# --- freshness and run metadata ---------------------------------------------------


@register("source_freshness")
def q_source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.freshness import source_freshness

    g = _graph(spark, sf_dir)
    return source_freshness(g.raw, g.as_of)


@register("last_refresh")
def q_last_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts are built and published; the answer comes from their
    manifests, without reading a row of them."""
    from tidemart.plans.build import BuildConfig, build_testdata, refreshed
    from tidemart.session import scratch_path

    cfg = BuildConfig(scratch_path(spark, "refresh"), fact_grain="year", run_tests=False, run_log=False,
                      grain_override={"dim_customer": "year"})
    build_testdata(spark, sf_dir, cfg)
    return refreshed(spark, cfg)


# --- metrics ----------------------------------------------------------------------


def _metric_query(metrics, group_by=("order_date",), grain="day", where=None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tidemart.operators.metrics import query_metrics

        return for_compare(query_metrics(_graph(spark, sf_dir).fct_orders, metrics, group_by, grain, where))

    return run


QUERIES["metric_gross_revenue"] = _metric_query(["gross_revenue"])
QUERIES["metric_net_revenue"] = _metric_query(["net_revenue"])
QUERIES["metric_orders"] = _metric_query(["orders"])
QUERIES["metric_item_quantity"] = _metric_query(["item_quantity"])
QUERIES["metric_average_order_value"] = _metric_query(["average_order_value"])
QUERIES["metric_units_per_order"] = _metric_query(["units_per_order"])
QUERIES["metric_revenue_by_country"] = _metric_query(
    ["gross_revenue", "net_revenue", "orders", "average_order_value"], ("customer_country", "tier"), "day"
)
QUERIES["metric_revenue_by_status"] = _metric_query(
    ["gross_revenue", "orders", "units_per_order"], ("order_date", "order_status"), "month"
)
QUERIES["metric_weekly_gold"] = _metric_query(
    ["net_revenue", "average_order_value", "units_per_order"], ("order_date",), "week", "customer_tier = 'gold'"
)
QUERIES["metric_tier_filter"] = _metric_query(
    ["gross_revenue", "orders", "units_per_order"], ("order_date", "order_status"), "month",
    "tier IN ('gold', 'platinum') AND currency = 'USD'"
)


@register("metric_nested_derived")
def q_metric_nested_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived metric whose divisor is nested and is zero for one status: no division error, NULL there."""
    from dataclasses import replace

    from tidemart.operators.metrics import SALES, Measure, Metric, query_metrics

    model = replace(SALES, measures={**SALES.measures, "mismatches": Measure("mismatches", "sum", "mismatch")}, metrics={
        **SALES.metrics, "mismatches": Metric("mismatches", "simple", measure="mismatches"),
        "units_per_mismatch": Metric("units_per_mismatch", "derived", expr="item_quantity / ((mismatches + mismatches) * orders - -0.0 * (1 + 2))")})
    fact = _graph(spark, sf_dir).fct_orders.withColumn(
        "mismatch", F.when(F.col("order_status") == "placed", F.lit(0)).otherwise(F.col("has_total_mismatch").cast("bigint")).cast("bigint"))
    return for_compare(query_metrics(fact, ["mismatches", "units_per_mismatch"], ("order_status",), "day", "tier <> 'bronze'", model))


QUERIES["metric_quarterly_by_country"] = _metric_query(
    ["gross_revenue", "orders", "item_quantity"], ("order_date", "customer_country"), "quarter", "currency <> 'USD'"
)
QUERIES["metric_yearly_by_tier"] = _metric_query(
    ["gross_revenue", "average_order_value"], ("order_date", "tier"), "year"
)


@register("time_spine")
def q_time_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily orders and gross revenue on the dense spine of the order-date
    range: days without orders appear with zeros."""
    from tidemart.operators.metrics import query_metrics
    from tidemart.sources.spine import dense_daily

    daily = query_metrics(_graph(spark, sf_dir).fct_orders, ["orders", "gross_revenue"])
    return for_compare(dense_daily(spark, daily, "order_date__day", {"orders": 0}).fillna(
        0, subset=["gross_revenue"]
    ))


# --- incremental upsert -------------------------------------------------------------


@register("fct_orders_incremental")
def q_fct_orders_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fct_orders built on 2001-01-01, then the 2001-08-02 batch merged with
    the updated_at lookback (3 days before the target's last build)."""
    from tidemart.operators.upsert import FCT_ORDERS_UPDATE_COLUMNS, incremental_upsert
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    merged = incremental_upsert(
        R.orders_batch1(g), R.orders_batch2(g), "order_sk", FCT_ORDERS_UPDATE_COLUMNS,
        lookback_source_column="updated_at", lookback_target_column="_built_at",
    )
    return for_compare(merged)


@register("fct_order_items_incremental")
def q_fct_order_items_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fct_order_items built on 2001-01-01, then the later batch merged with
    the order_date lookback; every column of a matched line is updated."""
    from tidemart.operators.upsert import incremental_upsert
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    merged = incremental_upsert(
        R.items_batch1(g), R.items_batch2(g), "order_item_sk", None,
        lookback_source_column="order_date", lookback_target_column="order_date", lookback_inclusive=True,
    )
    return for_compare(merged)


def _published(table, key: str, first: DataFrame, batch: DataFrame, update_columns, source_column: str,
               target_column: str, inclusive: bool) -> DataFrame:
    """First load, incremental upsert of a later batch and read, through the versioned table."""
    from tidemart.operators.upsert import lookback_filter
    from tidemart.sinks.versioned import upsert_partitions

    table.overwrite(first, unique_key=key, stored=True)
    source = lookback_filter(batch, table.read(), source_column, target_column, inclusive=inclusive)
    upsert_partitions(table, source, key, update_columns)
    return for_compare(table.read().drop(table.partition_col))


@register("fct_orders_published")
def q_fct_orders_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenario of fct_orders_incremental, written to a table partitioned by month and read back."""
    from tidemart.operators.upsert import FCT_ORDERS_UPDATE_COLUMNS
    from tidemart.session import scratch_path
    from tidemart.sinks.versioned import VersionedTable
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    g.materialize("fct_orders")
    table = VersionedTable(spark, scratch_path(spark, "fct_orders"), "order_date", "month", index_key="order_sk")
    return _published(table, "order_sk", R.orders_batch1(g), R.orders_batch2(g), FCT_ORDERS_UPDATE_COLUMNS,
                      "updated_at", BUILT_AT, False)


@register("fct_order_items_published")
def q_fct_order_items_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written, upserted and read back; some of the first load have no
    date, and the batch moves lines between partitions and out of the NULL one."""
    from tidemart.session import scratch_path
    from tidemart.sinks.versioned import VersionedTable
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    g.materialize("fct_order_items")
    table = VersionedTable(spark, scratch_path(spark, "fct_order_items"), "order_date", "month", index_key="order_item_sk")
    return _published(table, "order_item_sk", R.items_batch1_undated(g), R.items_batch2(g), None,
                      "order_date", "order_date", True)


# --- SCD2 snapshots -----------------------------------------------------------------


@register("snap_customers_initial")
def q_snap_customers_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.scd2 import scd2_apply, CUSTOMER_CHECK_COLUMNS
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    return scd2_apply(None, R.customers_v1(g), "customer_id", R.SNAPSHOT_1, CUSTOMER_CHECK_COLUMNS)


def _customer_history(g, runs):
    """Apply snapshot runs in order.  Between runs the history is
    checkpointed into the shared checkpoint directory, as a published
    version would be, so each run starts from materialised rows instead of
    re-deriving the previous runs (each run reads its history twice: closed
    rows pass through, open rows are joined)."""
    from tidemart.operators.scd2 import scd2_apply, CUSTOMER_CHECK_COLUMNS
    from tidemart.session import checkpoint_dir

    h = None
    for i, (current, as_of) in enumerate(runs):
        h = scd2_apply(h, current, "customer_id", as_of, CUSTOMER_CHECK_COLUMNS)
        if i < len(runs) - 1:
            checkpoint_dir(current.sparkSession)
            h = h.checkpoint(eager=True)
    return h


@register("snap_customers_changes")
def q_snap_customers_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    return _customer_history(g, [(R.customers_v1(g), R.SNAPSHOT_1), (R.customers_v2(g), R.SNAPSHOT_2)])


@register("snap_customers_deletes")
def q_snap_customers_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: deletions invalidate open rows, returning keys open new ones."""
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    return _customer_history(
        g,
        [(R.customers_v1(g), R.SNAPSHOT_1), (R.customers_v2(g), R.SNAPSHOT_2), (R.customers_v3(g), R.SNAPSHOT_3)],
    )


@register("snap_products_changes")
def q_snap_products_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.operators.scd2 import scd2_apply, PRODUCT_CHECK_COLUMNS
    from tidemart.sources import revisions as R

    from tidemart.session import checkpoint_dir

    g = _graph(spark, sf_dir)
    checkpoint_dir(spark)
    h = scd2_apply(None, R.products_v1(g), "product_id", R.SNAPSHOT_1, PRODUCT_CHECK_COLUMNS).checkpoint(eager=True)
    h = scd2_apply(h, R.products_v2(g), "product_id", R.SNAPSHOT_2, PRODUCT_CHECK_COLUMNS)
    return for_compare(h)


@register("snap_period_overlaps")
def q_snap_period_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History invariant over three customer snapshot runs, some of whose
    closed rows were damaged: no key has a period starting before its previous
    one ended."""
    from tidemart.operators.scd2 import period_overlaps
    from tidemart.sources import revisions as R

    g = _graph(spark, sf_dir)
    h = _customer_history(
        g,
        [(R.customers_v1(g), R.SNAPSHOT_1), (R.customers_v2(g), R.SNAPSHOT_2), (R.customers_v3(g), R.SNAPSHOT_3)],
    )
    return period_overlaps(R.drifted_history(h), "customer_id")
