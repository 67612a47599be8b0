"""Metric layer over the ``sales`` semantic model (backed by fct_orders).

A metric request is compiled into one grouped aggregation of the measures it
needs (the split distinct form of ``functions.aggregates`` when a distinct
count sits next to other measures), followed by a projection for ratio and
derived metrics; measures are aggregated once even when several metrics
share them.
"""

from __future__ import annotations

import ast
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.aggregates import agg_with_distinct_count
from tidemart.functions.expressions import money_ratio


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # sum | count_distinct | count | min | max | avg
    expr: str


@dataclass(frozen=True)
class Metric:
    name: str
    type: str  # simple | ratio | derived
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    expr: str | None = None


@dataclass(frozen=True)
class SemanticModel:
    name: str
    time_dimension: str
    dimensions: dict[str, str]  # dimension name -> column expression
    measures: dict[str, Measure]
    metrics: dict[str, Metric]


# The ``sales`` semantic model: entities order (order_sk) and customer
# (customer_id); dimension ``tier`` maps to the fact's customer_tier column.
SALES = SemanticModel(
    name="sales",
    time_dimension="order_date",
    dimensions={
        "order_date": "order_date",
        "order_status": "order_status",
        "customer_country": "customer_country",
        "tier": "customer_tier",
    },
    measures={
        "gross_revenue": Measure("gross_revenue", "sum", "order_total_amount"),
        "net_revenue": Measure("net_revenue", "sum", "items_net_amount"),
        "order_count": Measure("order_count", "count_distinct", "order_sk"),
        "item_quantity": Measure("item_quantity", "sum", "total_quantity"),
    },
    metrics={
        "gross_revenue": Metric("gross_revenue", "simple", measure="gross_revenue"),
        "net_revenue": Metric("net_revenue", "simple", measure="net_revenue"),
        "orders": Metric("orders", "simple", measure="order_count"),
        "item_quantity": Metric("item_quantity", "simple", measure="item_quantity"),
        "average_order_value": Metric(
            "average_order_value", "ratio", numerator="gross_revenue", denominator="orders"
        ),
        "units_per_order": Metric("units_per_order", "derived", expr="item_quantity / orders"),
    },
)

_AGGS = {
    "sum": F.sum,
    "count_distinct": F.count_distinct,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
}

GRAINS = ("day", "week", "month", "quarter", "year")


def _inputs(model: SemanticModel, metric: str) -> list[str]:
    """Metrics that a ratio or a derived metric is computed from."""
    m = model.metrics[metric]
    if m.type == "simple":
        return []
    names = [m.numerator, m.denominator] if m.type == "ratio" else [
        n.id for n in ast.walk(_parsed(m.expr)) if isinstance(n, ast.Name)]
    unknown = sorted(set(names) - set(model.metrics))
    if not names:
        raise ValueError(f"metric {metric!r} is computed from no metric")
    if unknown:
        raise ValueError(f"metric {metric!r} refers to {unknown}, which are no metrics")
    return list(dict.fromkeys(names))


def _parsed(expr: str) -> ast.expr:
    try:
        return ast.parse(expr.strip(), mode="eval").body
    except SyntaxError as e:
        raise ValueError(f"metric expression {expr!r} is no arithmetic") from e


def _arithmetic(node: ast.expr, expr: str) -> Column:
    """The expression's tree as a Column, in double: + - * / over metrics,
    numbers and parentheses; a zero divisor, however deep, gives NULL."""
    if isinstance(node, ast.Name):
        return F.col(f"__v_{node.id}").cast("double")
    if isinstance(node, ast.Constant) and type(node.value) in (int, float):
        return F.lit(float(node.value))
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
        inner = _arithmetic(node.operand, expr)
        return -inner if isinstance(node.op, ast.USub) else inner
    if isinstance(node, ast.BinOp) and type(node.op) in _OPERATIONS:
        return _OPERATIONS[type(node.op)](_arithmetic(node.left, expr), _arithmetic(node.right, expr))
    raise ValueError(f"metric expression {expr!r} is no arithmetic")


_OPERATIONS = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: F.try_divide,
}


def _filtered(fact: DataFrame, where: str | Column, model: SemanticModel) -> DataFrame:
    """``fact`` filtered by a condition in which a name is first a dimension of
    the model, else a column.  The dimensions stand beside the columns for the
    filter only; Catalyst pushes it down to the columns behind them."""
    if not isinstance(where, str):
        return fact.filter(where)
    own = {d: e for d, e in model.dimensions.items() if d != e}
    named = fact.select("*", *[F.col(e).alias(f"__dimension_{d}") for d, e in own.items()])
    hidden = {d: f"__column_{d}" for d in own if d in fact.columns}
    named = named.withColumnsRenamed(hidden).withColumnsRenamed({f"__dimension_{d}": d for d in own})
    return named.filter(where).drop(*own).withColumnsRenamed({v: k for k, v in hidden.items()}).select(*fact.columns)


def _measures_of(model: SemanticModel, metric: str) -> set[str]:
    m = model.metrics[metric]
    if m.type == "simple":
        return {m.measure}
    return set().union(*(_measures_of(model, n) for n in _inputs(model, metric)))


def _with_metric(df: DataFrame, model: SemanticModel, metric: str) -> DataFrame:
    """``df`` (grouped measures) with the metric as column ``__v_<metric>``."""
    if f"__v_{metric}" in df.columns:
        return df
    m = model.metrics[metric]
    for n in _inputs(model, metric):
        df = _with_metric(df, model, n)
    if m.type == "simple":
        value = F.col(f"__m_{m.measure}")
    elif m.type == "ratio":
        value = money_ratio(f"__v_{m.numerator}", f"__v_{m.denominator}")
    else:
        value = _arithmetic(_parsed(m.expr), m.expr)
    return df.withColumn(f"__v_{metric}", value)


def time_bucket(column: str, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    if grain == "day":
        return F.col(column)
    return F.trunc(F.col(column), grain)


def query_metrics(
    fact: DataFrame,
    metrics: Sequence[str],
    group_by: Sequence[str] = ("order_date",),
    grain: str = "day",
    where: str | Column | None = None,
    model: SemanticModel = SALES,
) -> DataFrame:
    """Compute ``metrics`` grouped by ``group_by`` dimensions.

    The time dimension is bucketed to ``grain`` and named
    ``<dimension>__<grain>``; categorical dimensions keep their names.
    ``where`` may name dimensions and columns.
    """
    if where is not None:
        fact = _filtered(fact, where, model)
    keys: list[tuple[str, Column]] = []
    for d in group_by:
        if d == model.time_dimension:
            keys.append((f"{d}__{grain}", time_bucket(model.dimensions[d], grain)))
        else:
            keys.append((d, F.col(model.dimensions[d])))
    measures = sorted(set().union(*[_measures_of(model, m) for m in metrics]))
    distinct = [n for n in measures if model.measures[n].agg == "count_distinct"]
    plain = [n for n in measures if n not in distinct]
    summable = all(model.measures[n].agg == "sum" for n in plain)
    if keys and len(distinct) == 1 and plain and summable:
        # one distinct measure next to sums: single-scan form that collapses
        # the sums to group level before shuffling (see functions/aggregates)
        n = distinct[0]
        grouped = agg_with_distinct_count(
            fact, keys, {f"__m_{p}": F.col(model.measures[p].expr) for p in plain}, {},
            model.measures[n].expr, f"__m_{n}",
        )
    else:
        aggs = [_AGGS[model.measures[n].agg](model.measures[n].expr).alias(f"__m_{n}") for n in measures]
        key_cols = [expr.alias(name) for name, expr in keys]
        grouped = fact.groupBy(*key_cols).agg(*aggs) if keys else fact.agg(*aggs)
    out_keys = [k for k in grouped.columns if not k.startswith("__m_")]
    for m in metrics:
        grouped = _with_metric(grouped, model, m)
    return grouped.select(*out_keys, *[F.col(f"__v_{m}").alias(m) for m in metrics])
