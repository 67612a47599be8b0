import datetime as dt
from decimal import Decimal

from tidemart.operators.freshness import cost_per_model, source_freshness, stale_sources
from tidemart.operators.metrics import query_metrics

from pyspark.sql import functions as F

from helpers import rows

FCT = ("order_sk string, order_date date, order_status string, customer_country string, customer_tier string,"
       " order_total_amount decimal(18,4), items_net_amount decimal(38,8), total_quantity bigint")
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 20)


def _fct(spark):
    return spark.createDataFrame(
        [("a", D1, "paid", "US", "gold", Decimal("10"), Decimal("9"), 3),
         ("b", D1, "paid", "US", "gold", Decimal("5.0001"), Decimal("5"), 1),
         ("c", D2, "cancelled", "FR", "bronze", Decimal("7"), None, 2)], FCT)


def test_simple_ratio_and_derived_metrics(spark):
    out = query_metrics(_fct(spark), ["gross_revenue", "orders", "average_order_value", "units_per_order"])
    assert rows(out) == [
        (D1, Decimal("15.0001"), 2, Decimal("7.50005"), 2.0),
        (D2, Decimal("7.0000"), 1, Decimal("7.0000"), 2.0),
    ]


def test_month_grain_dimensions_and_where(spark):
    out = query_metrics(_fct(spark), ["net_revenue", "item_quantity"], ["order_date", "tier"], "month",
                        where="order_status = 'paid'")
    assert rows(out) == [(D1, "gold", Decimal("14.00000000"), 4)]


def test_freshness_statuses(spark):
    def src(ts):
        return spark.createDataFrame([(ts,)], "_loaded_at timestamp_ntz")

    now = "2024-01-02 00:00:00"
    f = source_freshness(
        {"fresh": src(dt.datetime(2024, 1, 1, 23)), "warn": src(dt.datetime(2024, 1, 1, 12)),
         "err": src(dt.datetime(2023, 12, 30)),
         "empty": spark.createDataFrame([], "_loaded_at timestamp_ntz")}, now)
    got = {r.source: (r.age_in_seconds, r.status) for r in f.collect()}
    assert got == {"fresh": (3600, "pass"), "warn": (43200, "warn"), "err": (259200, "error"),
                   "empty": (None, "error")}
    assert sorted(r.source for r in stale_sources(f).collect()) == ["empty", "err", "warn"]


def test_cost_per_model(spark):
    log = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 12), "QUERY", "select 1 /* tidemart-0.1 | abc | fct_orders */", 2 ** 40),
         (dt.datetime(2024, 1, 1, 13), "QUERY", "select 2 /* tidemart-0.1 | abc | dim_product */", 2 ** 39),
         (dt.datetime(2024, 1, 1, 14), "QUERY", "select 3 /* tidemart-0.1 | abc | fct_orders */", 2 ** 40),
         (dt.datetime(2023, 1, 1), "QUERY", "select /* tidemart-0.1 | abc | old */", 2 ** 40),
         (dt.datetime(2024, 1, 1, 15), "LOAD", "load /* other-x | a | fct_orders */", 2 ** 40)],
        "creation_time timestamp_ntz, job_type string, query string, total_bytes_billed bigint",
    )
    out = [tuple(r) for r in cost_per_model(log, "2024-01-02 00:00:00").collect()]
    assert out == [("fct_orders", 10.0), ("dim_product", 2.5)]


def test_derived_metrics_take_any_arithmetic(spark):
    import dataclasses

    import pytest

    from tidemart.operators.metrics import SALES, Metric, query_metrics

    fact = spark.createDataFrame(
        [("a", "x", 10, 4, 3), ("b", "x", 20, 5, 0), ("c", "y", 7, 7, 0)],
        "order_sk string, customer_country string, order_total_amount int, items_net_amount int, total_quantity int")
    extra = {"margin": Metric("margin", "derived", expr="(gross_revenue - net_revenue) / (item_quantity * 2) + 1"),
             "margin_each": Metric("margin_each", "derived", expr="margin / orders"),
             "lost": Metric("lost", "derived", expr="orders / nothing")}
    model = dataclasses.replace(SALES, metrics={**SALES.metrics, **extra})
    got = {r.customer_country: (r.margin, r.margin_each)
           for r in query_metrics(fact, ["margin", "margin_each"], ("customer_country",), model=model).collect()}
    assert got == {"x": (4.5, 2.25), "y": (None, None)}
    with pytest.raises(ValueError, match="nothing"):
        query_metrics(fact, ["lost"], ("customer_country",), model=model)


def test_derived_metrics_are_trees(spark):
    """Nested divisors of zero give NULL; what is no arithmetic is refused."""
    from dataclasses import replace

    import pytest

    from tidemart.operators.metrics import SALES, Metric

    def value(expr, fact):
        model = replace(SALES, metrics={**SALES.metrics, "it": Metric("it", "derived", expr=expr)})
        return [r[0] for r in query_metrics(fact, ["it"], (), model=model).collect()]

    fact = _fct(spark)
    assert value("orders / ((item_quantity - item_quantity) * orders)", fact) == [None]
    assert value("orders / (2 * (orders + orders)) - -1.5", fact) == [1.75]
    assert value("1 / (orders / (orders - orders))", fact) == [None]
    for bad in ("orders +", "abs(orders)", "orders ** 2", "'a'", "nothing / orders"):
        with pytest.raises(ValueError):
            value(bad, fact)


def test_filters_name_dimensions(spark):
    fact = _fct(spark)
    by_name = query_metrics(fact, ["orders"], ("order_date",), where="tier = 'gold'")
    by_column = query_metrics(fact, ["orders"], ("order_date",), where="customer_tier = 'gold'")
    assert rows(by_name) == rows(by_column)
    clash = fact.withColumn("tier", F.lit("of another kind"))
    assert rows(query_metrics(clash, ["orders"], ("order_date", "tier"), where="tier = 'gold'")) == rows(
        query_metrics(fact, ["orders"], ("order_date", "tier"), where="customer_tier = 'gold'"))
