"""The model graph over one set of raw tables.

``ModelGraph`` wires staging -> intermediate -> marts lazily: each attribute is
a DataFrame built on first access and shared by every model that refers to
it.  Nothing runs until an action; Spark then sees one plan per output and
reuses identical exchanges within it.

    orders ─ stg_orders ──┬─ int_orders_enriched ─ fct_orders ─┬─ revenue_ledger
    order_items ─ stg_order_items ─┬┘                          ├─ session_funnel
       order_lines, stg_orders ──── fct_order_items            └─ metrics
    customers ─ stg_customers ─┬─ int_orders_enriched
                               ├─ int_customer_lifetime_metrics ─ dim_customer ─ customer_ltv
                               └─ SCD2 snapshot
    products ─ stg_products ─┬─ dim_product
                             └─ SCD2 snapshot
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from tidemart.plans import intermediate as I
from tidemart.plans import marts as M
from tidemart.plans import staging as S
from tidemart.session import scratch_path, together
from tidemart.sinks import fs
from tidemart.sinks.observe import write_observed
from tidemart.sinks.stored import store
from tidemart.sources import testdata


class ModelGraph:
    """All models over raw tables given as a name -> DataFrame mapping.

    ``funnel_orders`` optionally replaces the funnel's order side (the test
    data needs it; in production it is the revenue subset of fct_orders).
    """

    def __init__(
        self,
        raw: dict[str, DataFrame],
        as_of: str,
        funnel_orders: Callable[[], DataFrame] | None = None,
    ):
        self.raw = raw
        self.as_of = as_of
        self._funnel_orders = funnel_orders
        self._files: dict[str, str] = {}  # of materialized models

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, as_of: str = testdata.DEFAULT_AS_OF):
        return cls(
            testdata.raw_tables(spark, sf_dir),
            as_of,
            funnel_orders=lambda: testdata.funnel_orders(spark, sf_dir),
        )

    @classmethod
    def from_faulty_testdata(cls, spark: SparkSession, sf_dir: str, as_of: str = testdata.DEFAULT_AS_OF):
        """The test tables with planted faults, for the data tests."""
        from tidemart.sources.faults import faulty

        graph = cls.from_testdata(spark, sf_dir, as_of)
        graph.raw = faulty(graph.raw)
        return graph

    def materialize(self, *names: str, count: Callable[[str], dict[str, Column]] | None = None) -> dict[str, dict[str, int]]:
        """Write models to the shared folder and go on from the files: what
        several outputs read is computed once, and a lost executor reads it again.
        ``count`` gives aggregates of a model by name; they are observed while
        it is written, and their values are returned by model.  The models of
        one call are written side by side, so none of them should read another.
        Surrogate keys that their row's ids give are not in the files."""
        models = {name: self.model(name) for name in names}
        paths = {name: scratch_path(df.sparkSession, name) for name, df in models.items()}

        def write(name: str) -> dict[str, int]:
            def out(df: DataFrame) -> None:
                setattr(self, name, store(df, paths[name]))

            return write_observed(models[name], out, count(name) if count else {})

        observed = dict(zip(names, together([lambda name=name: write(name) for name in names])))
        self._files.update(paths)
        return observed

    def discard(self, *names: str) -> None:
        """Delete the files of materialized models; what asks for one again computes it."""
        for name in names:
            fs.delete(self.model(name).sparkSession, self._files.pop(name))
            delattr(self, name)

    # staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return S.stg_orders(self.raw["orders"], self.as_of)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return S.stg_customers(self.raw["customers"], self.as_of)

    @cached_property
    def stg_products(self) -> DataFrame:
        return S.stg_products(self.raw["products"], self.as_of)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return S.stg_order_items(self.raw["order_items"], self.as_of)

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return S.stg_sessions(self.raw["sessions"], self.as_of)

    @cached_property
    def order_lines(self) -> DataFrame:
        return S.order_lines(self.raw["order_items"])

    # intermediate
    @cached_property
    def order_items_rollup(self) -> DataFrame:
        return I.order_items_rollup(self.stg_order_items)

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return I.int_orders_enriched(self.stg_orders, self.stg_order_items, self.stg_customers, self.as_of)

    @cached_property
    def customer_rollup(self) -> DataFrame:
        return I.customer_rollup(self.stg_orders, self.as_of)

    @cached_property
    def int_customer_lifetime_metrics(self) -> DataFrame:
        return I.int_customer_lifetime_metrics(self.stg_customers, self.stg_orders, self.as_of)

    # marts
    @cached_property
    def dim_product(self) -> DataFrame:
        return M.dim_product(self.stg_products, self.as_of)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return M.dim_customer(self.int_customer_lifetime_metrics, self.as_of)

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return M.customer_ltv(self.dim_customer, self.as_of)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return M.fct_orders(self.int_orders_enriched, self.as_of)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return M.fct_order_items_of_lines(self.order_lines, self.stg_orders, self.as_of)

    @cached_property
    def revenue_ledger(self) -> DataFrame:
        return M.revenue_ledger(self.fct_orders, self.as_of)

    @cached_property
    def funnel_orders(self) -> DataFrame:
        if self._funnel_orders is not None:
            return self._funnel_orders()
        return M.fct_revenue_orders(self.fct_orders)

    @cached_property
    def daily_sessions(self) -> DataFrame:
        return M.daily_sessions(self.stg_sessions)

    @cached_property
    def daily_conversions(self) -> DataFrame:
        return M.daily_conversions(self.stg_sessions, self.funnel_orders)

    @cached_property
    def session_funnel(self) -> DataFrame:
        return M.session_funnel(self.stg_sessions, self.funnel_orders, self.as_of)

    def model(self, name: str) -> DataFrame:
        """A model by name, or a raw table as ``raw_<table>``."""
        return self.raw[name[4:]] if name.startswith("raw_") else getattr(self, name)
