"""The build job: raw tables -> published marts, full or incremental.

Order follows the model graph.  Each mart is written as a versioned parquet
table; downstream marts read the *published* upstream table, which cuts the
lineage at every layer (a lost executor recomputes from parquet, not from
raw) and avoids computing the order fact twice.

Incremental facts:
* fct_orders — source = orders updated after (last build stamp - lookback);
  the filter is applied to the staged orders before the join, and the line
  items are restricted to those orders with a left-semi join before they are
  rolled up; MERGE on order_sk with the update list.
* fct_order_items — source = lines of orders dated on/after
  (max order_date - lookback); MERGE on order_item_sk, all columns.
Both rewrite only the date partitions the batch touches.
"""

from __future__ import annotations

import datetime as dt
import time
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.expressions import LOOKBACK_DAYS, value_literal
from tidemart.operators.quality import DECLARED_TESTS, dq_summary, row_counts
from tidemart.operators.upsert import FCT_ORDERS_UPDATE_COLUMNS
from tidemart.plans import intermediate as I
from tidemart.plans import marts as M
from tidemart.plans.graph import ModelGraph
from tidemart.plans.staging import BUILT_AT
from tidemart.session import runtime_filters, size_shuffles, together
from tidemart.sinks.layout import schema_name, table_path
from tidemart.sinks.versioned import VersionedTable, in_partitions, upsert_partitions


@dataclass(frozen=True)
class Layout:
    layer: str = "gold"
    partition_by: str | None = None
    grain: str = "day"
    cluster_by: tuple[str, ...] = ()


# Partitioning and clustering of each mart.  Fact tables partition by day in
# production; ``BuildConfig.fact_grain`` can coarsen that for small data.
MART_LAYOUT: dict[str, Layout] = {
    "fct_orders": Layout("gold", "order_date", "day", ("customer_id", "order_status")),
    "fct_order_items": Layout("gold", "order_date", "day", ("product_id",)),
    "dim_customer": Layout("gold", "customer_created_date", "month", ("country", "tier")),
    "dim_product": Layout("gold", None, "day", ("category",)),
    "revenue_ledger": Layout("gold", "revenue_date", "day", ("currency", "customer_country")),
    "customer_ltv": Layout("gold", None, "day", ("recency_segment",)),
    "session_funnel": Layout("gold", "funnel_date", "day", ("traffic_source", "device_type")),
}


# Column descriptions persisted with the marts (parquet schema metadata).
MART_COMMENTS: dict[str, dict[str, str]] = {
    "fct_orders": {
        "order_sk": "surrogate key of the order (SHA-256 of order_id)",
        "has_total_mismatch": "order total differs from the sum of its net line amounts by more than 1 %",
        "_built_at": "as-of time of the build that last wrote the row",
    },
    "fct_order_items": {
        "line_net_amount": "quantity x unit price x (1 - discount)",
        "_built_at": "as-of time of the build that last wrote the row",
    },
    "dim_customer": {
        "recency_segment": "active <=30 days, recent <=90, dormant <=365, else churned; never_ordered",
        "lifetime_gross_revenue": "sum of paid, shipped and delivered order totals",
    },
    "customer_ltv": {"ltv_segment": "whale >=5000, high_value >=1000, mid_value >=100, low_value >0, else non_buyer"},
    "revenue_ledger": {"cancelled_revenue": "always 0: cancelled orders are filtered out before aggregation"},
    "session_funnel": {
        "gross_revenue": "same-day revenue of converting customers, counted once per session",
        "conversion_rate": "converting customers / authenticated customers",
    },
}

# What each mart holds; kept with every published version.
MART_DESCRIPTIONS: dict[str, str] = {
    "fct_orders": "one row an order with its line totals and the customer as of the build",
    "fct_order_items": "one row a line item of a known order",
    "dim_customer": "one row a customer with lifetime measures over revenue orders",
    "dim_product": "one row a product",
    "revenue_ledger": "revenue orders by day, currency, country and tier",
    "customer_ltv": "one row a customer with its lifetime-value segment",
    "session_funnel": "sessions and conversions by day, traffic source and device",
}

# Columns whose maximum the manifest keeps, where they are more than the build stamp: the lookback starts from them.
MART_STAMPS: dict[str, tuple[str, ...]] = {"fct_orders": (BUILT_AT,), "fct_order_items": (BUILT_AT, "order_date")}

# Keys of the facts that upserts look up; their partitions are indexed.
MART_KEYS = {"fct_orders": "order_sk", "fct_order_items": "order_item_sk"}

# Retention of audit tables, in days.
AUDIT_RETENTION_DAYS = 180


@dataclass
class BuildConfig:
    warehouse: str
    target_name: str = "dev"
    default_schema: str = "analytics"
    fact_grain: str = "day"
    lookback_days: int = LOOKBACK_DAYS
    full_refresh: bool = False
    run_log: bool = True
    run_tests: bool = True
    run_snapshots: bool = False
    keep_versions: int = 2
    keep_hours: float = 1.0
    version: str = "tidemart-0.1"
    grain_override: dict[str, str] = field(default_factory=dict)


def _table(spark: SparkSession, cfg: BuildConfig, name: str) -> VersionedTable:
    lay = MART_LAYOUT[name]
    grain = cfg.grain_override.get(name, lay.grain)
    if name.startswith("fct_") or name in ("revenue_ledger", "session_funnel"):
        grain = cfg.grain_override.get(name, cfg.fact_grain)
    path = table_path(cfg.warehouse, schema_name(lay.layer, cfg.target_name, cfg.default_schema), name)
    return VersionedTable(spark, path, lay.partition_by, grain, lay.cluster_by, MART_COMMENTS.get(name),
                          row_counts(name), MART_STAMPS.get(name, (BUILT_AT,)), MART_DESCRIPTIONS[name], MART_KEYS.get(name))


def refreshed(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """(model, last_built_at, row_count) of the published marts, from their
    manifests: no row is read."""
    rows = []
    for name in MART_LAYOUT:
        t = _table(spark, cfg, name)
        if t.exists():
            rows.append((name, t.maximum(BUILT_AT), t.observed().get("rows")))
    return spark.createDataFrame(rows, "model string, last_built_at timestamp_ntz, row_count bigint")


def _drop_partition_helper(df: DataFrame, table: VersionedTable) -> DataFrame:
    pc = table.partition_col
    if pc and table.partition_by and pc != table.partition_by and pc in df.columns:
        return df.drop(pc)
    return df


def read_mart(spark: SparkSession, cfg: BuildConfig, name: str) -> DataFrame:
    t = _table(spark, cfg, name)
    return _drop_partition_helper(t.read(), t)


@contextmanager
def _timed(timings: dict | None, name: str):
    t0 = time.perf_counter()
    yield
    if timings is not None:
        timings[name] = round(time.perf_counter() - t0, 3)


def build(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    as_of: str,
    cfg: BuildConfig,
    funnel_orders: DataFrame | None = None,
    timings: dict | None = None,
    report: dict | None = None,
) -> dict[str, int]:
    """Run one build; returns {mart: published version}.  ``timings``, if
    given, receives the wall time of each step in seconds; ``report``
    receives the number of failing data tests.  The run log records the
    actual outcome: the marts published and success, or failure (then the
    error is re-raised; marts not yet published keep their previous
    version)."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    versions: dict[str, int] = {}
    try:
        _run_steps(spark, raw, as_of, cfg, funnel_orders, timings, report, versions, started)
    except Exception:
        _log(spark, cfg, started, versions, success=False)
        raise
    _log(spark, cfg, started, versions, success=True)
    return versions


def _run_steps(spark, raw, as_of, cfg: BuildConfig, funnel_orders, timings, report, versions, started) -> None:
    size_shuffles(spark, raw.values())
    g = ModelGraph(raw, as_of)

    # --- facts -------------------------------------------------------------------
    orders_t = _table(spark, cfg, "fct_orders")
    touched_orders: list | None = None  # None = full rebuild of fct_orders
    with _timed(timings, "fct_orders"):
        touched_orders = _build_fct_orders(spark, g, orders_t, cfg, as_of, versions)
    items_t = _table(spark, cfg, "fct_order_items")
    with _timed(timings, "fct_order_items"):
        _build_fct_order_items(g, items_t, cfg, as_of, versions)

    fct = read_mart(spark, cfg, "fct_orders")

    # --- dimensions and rollups: independent of each other, so they run side by side ---
    def products():
        with _timed(timings, "dim_product"):
            versions["dim_product"] = _table(spark, cfg, "dim_product").overwrite(stg_products)

    def customers():
        with _timed(timings, "dim_customer"):
            versions["dim_customer"] = _table(spark, cfg, "dim_customer").overwrite(dim_customer)
        with _timed(timings, "customer_ltv"):
            dim_c = read_mart(spark, cfg, "dim_customer")
            versions["customer_ltv"] = _table(spark, cfg, "customer_ltv").overwrite(M.customer_ltv(dim_c, as_of))

    def ledger():
        with _timed(timings, "revenue_ledger"):
            _build_revenue_ledger(spark, cfg, fct, as_of, touched_orders, versions)

    def funnel():
        with _timed(timings, "session_funnel"):
            _build_session_funnel(spark, cfg, g.stg_sessions, fct, funnel_orders, as_of, touched_orders, versions)

    stg_products, dim_customer = g.dim_product, g.dim_customer
    together([products, customers, ledger, funnel])
    if cfg.run_snapshots:
        with _timed(timings, "snapshots"):
            _snapshots(spark, cfg, g, as_of, versions)
    with _timed(timings, "vacuum"):
        for name in MART_LAYOUT:
            _table(spark, cfg, name).vacuum(cfg.keep_versions, cfg.keep_hours)
    if cfg.run_tests:
        with _timed(timings, "tests"):
            failed = _tests(spark, cfg, g, as_of, started)
        if report is not None:
            report["failed_tests"] = failed


def _snapshots(spark, cfg: BuildConfig, g: ModelGraph, as_of: str, versions) -> None:
    from tidemart.plans.snapshots import history_table, snapshot_customers, snapshot_products

    schema = schema_name("snapshots", cfg.target_name, cfg.default_schema)
    customers = history_table(spark, table_path(cfg.warehouse, schema, "snap_customers_scd2"))
    products = history_table(spark, table_path(cfg.warehouse, schema, "snap_products_scd2"))
    versions["snap_customers_scd2"] = snapshot_customers(customers, g.stg_customers, as_of)
    versions["snap_products_scd2"] = snapshot_products(products, g.stg_products, as_of)
    customers.vacuum(cfg.keep_versions, cfg.keep_hours)
    products.vacuum(cfg.keep_versions, cfg.keep_hours)


def _tests(spark, cfg: BuildConfig, g: ModelGraph, as_of: str, started) -> int:
    """Run every declared data test against the published marts (staging
    models are evaluated from raw), append the summary to the audit layer and
    return the number of failing tests.  Row-level tests of the marts were
    counted while they were written; their manifests have the results."""
    models = {name: getattr(g, name) for name in
              ("stg_orders", "stg_customers", "stg_products", "stg_order_items", "stg_sessions")}
    models.update({f"raw_{name}": df for name, df in g.raw.items()})
    models.update({name: read_mart(spark, cfg, name) for name in MART_LAYOUT})
    observed = {name: _table(spark, cfg, name).observed() for name in MART_LAYOUT}  # also has "rows", which is no test
    summary = dq_summary(models, DECLARED_TESTS, as_of, observed).select(
        "*", value_literal(started).alias("run_started_at"),
        F.to_date(value_literal(started)).alias("run_date"),
    )
    path = table_path(cfg.warehouse, schema_name("audit", cfg.target_name, cfg.default_schema), "dq_results")
    summary.coalesce(1).write.mode("append").partitionBy("run_date").parquet(path)
    written = spark.read.parquet(path).filter(F.col("run_date") == F.lit(started.date()))
    written = written.filter(F.col("run_started_at") == value_literal(started))
    return written.filter(F.col("status") == "fail").count()


def _cutoff(table: VersionedTable, column: str, days: int):
    """Watermark of a published table less the lookback, from its manifest; None without rows."""
    latest = table.maximum(column)
    return None if latest is None else latest - dt.timedelta(days=days)


def _first_load(g: ModelGraph, name: str, table: VersionedTable) -> int:
    """A fact is computed once, before its version is written: the shuffles of
    both, and of the slices the version is written in, don't lie on disk together."""
    with ExitStack() as files:
        g.materialize(name)
        files.callback(g.discard, name)
        return table.overwrite(g.model(name), unique_key=MART_KEYS[name], stored=True, written=files.close)


def _build_fct_orders(spark, g: ModelGraph, orders_t: VersionedTable, cfg: BuildConfig, as_of: str, versions):
    """Returns the partition values the incremental MERGE rewrote, or None
    after a full load."""
    if cfg.full_refresh or not orders_t.exists():
        cutoff = None
    else:
        cutoff = _cutoff(orders_t, BUILT_AT, cfg.lookback_days)
    if cutoff is None:  # first run, full refresh, or a target without rows
        versions["fct_orders"] = _first_load(g, "fct_orders", orders_t)
        return None
    else:
        stg_o = g.stg_orders.filter(F.col("updated_at") > value_literal(cutoff))
        items = g.stg_order_items.join(stg_o.select("order_id"), "order_id", "left_semi")
        source = M.fct_orders(I.int_orders_enriched(stg_o, items, g.stg_customers, as_of), as_of)
        touched: list = []
        with runtime_filters(spark):  # the line items are filtered by the changed orders right at their scan
            versions["fct_orders"] = upsert_partitions(
                orders_t, source, "order_sk", FCT_ORDERS_UPDATE_COLUMNS, touched_out=touched
            )
        return touched


def _build_revenue_ledger(spark, cfg: BuildConfig, fct: DataFrame, as_of: str, touched, versions) -> None:
    """The ledger's rows for a date depend only on that date's orders, so
    after an incremental fact run only the partitions the MERGE touched are
    recomputed (fact read with a partition filter) and replaced."""
    table = _table(spark, cfg, "revenue_ledger")
    orders_t = _table(spark, cfg, "fct_orders")
    same_layout = table.grain == orders_t.grain
    if touched is None or not table.exists() or not same_layout:
        versions["revenue_ledger"] = table.overwrite(M.revenue_ledger(fct, as_of))
        return
    if not touched:
        versions["revenue_ledger"] = table.current_version()
        return
    part = orders_t.partition_col
    fct_touched = _drop_partition_helper(orders_t.read().filter(in_partitions(part, touched)), orders_t)
    versions["revenue_ledger"] = table.replace_partitions(M.revenue_ledger(fct_touched, as_of), touched)


def _build_session_funnel(spark, cfg: BuildConfig, sessions: DataFrame, fct: DataFrame, funnel_orders: DataFrame | None,
                          as_of: str, touched_orders, versions) -> None:
    """The funnel's rows for a date depend only on that date's sessions and on
    the revenue orders of that date.  After an incremental fact run the dates
    recomputed are those of orders that the MERGE touched and of sessions
    loaded since the last build less the lookback; both sides are filtered to
    them, and their partitions are replaced.  The distinct dates, bounded by
    the calendar, are all that reaches the driver."""
    table = _table(spark, cfg, "session_funnel")
    orders = funnel_orders if funnel_orders is not None else M.fct_revenue_orders(fct)
    same_layout = table.grain == _table(spark, cfg, "fct_orders").grain
    since = _cutoff(table, BUILT_AT, cfg.lookback_days) if table.exists() else None
    if cfg.full_refresh or touched_orders is None or since is None or not same_layout:
        versions["session_funnel"] = table.overwrite(M.session_funnel(sessions, orders, as_of))
        return
    period = (lambda c: F.col(c)) if table.grain == "day" else (lambda c: F.trunc(F.col(c), table.grain))
    loaded = sessions.filter((F.col("_loaded_at") > value_literal(since)) | F.col("_loaded_at").isNull())
    dates = {r[0] for r in loaded.select(period("session_date")).distinct().collect()}
    if funnel_orders is None:
        dates |= set(touched_orders)
    if not dates:
        versions["session_funnel"] = table.current_version()
        return
    own = lambda df, column: df.withColumn("__period", period(column)).filter(
        in_partitions("__period", sorted(dates, key=lambda d: (d is not None, d)))).drop("__period")
    fresh = M.session_funnel(own(sessions, "session_date"), own(orders, "order_date"), as_of)
    versions["session_funnel"] = table.replace_partitions(fresh, sorted(dates, key=lambda d: (d is not None, d)))


def _build_fct_order_items(g: ModelGraph, items_t: VersionedTable, cfg: BuildConfig, as_of: str, versions):
    if cfg.full_refresh or not items_t.exists():
        cutoff = None
    else:
        cutoff = _cutoff(items_t, "order_date", cfg.lookback_days)
    if cutoff is None:
        versions["fct_order_items"] = _first_load(g, "fct_order_items", items_t)
    else:
        stg_o = g.stg_orders.filter(F.col("order_date") >= value_literal(cutoff))
        source = M.fct_order_items_of_lines(g.order_lines, stg_o, as_of)
        with runtime_filters(items_t.spark):
            versions["fct_order_items"] = upsert_partitions(items_t, source, "order_item_sk", None)


def _log(spark, cfg: BuildConfig, started, versions, success: bool = True) -> None:
    """Append the run to the run log and expire old audit partitions
    (directory listing only)."""
    if not cfg.run_log:
        return
    from tidemart.sinks.layout import expire_partitions
    from tidemart.sinks.run_log import log_run

    audit = schema_name("audit", cfg.target_name, cfg.default_schema)
    path = table_path(cfg.warehouse, audit, "run_log")
    log_run(
        spark, path, started, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), cfg.target_name,
        len(versions), success, cfg.version,
    )
    oldest = started.date() - dt.timedelta(days=AUDIT_RETENTION_DAYS)
    expire_partitions(spark, path, "started_date", oldest)
    expire_partitions(spark, table_path(cfg.warehouse, audit, "dq_results"), "run_date", oldest)


def build_testdata(spark: SparkSession, sf_dir: str, cfg: BuildConfig, as_of: str | None = None,
                   timings: dict | None = None, report: dict | None = None) -> dict[str, int]:
    from tidemart.sources import testdata

    return build(
        spark,
        testdata.raw_tables(spark, sf_dir),
        as_of or testdata.DEFAULT_AS_OF,
        cfg,
        funnel_orders=testdata.funnel_orders(spark, sf_dir),
        timings=timings,
        report=report,
    )
