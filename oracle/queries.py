"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracle.duckdb_sql import AS_OF, select_model, with_ctes

MONEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "stg_orders": ("total_amount",),
    "stg_customers": (),
    "stg_products": ("list_price",),
    "stg_order_items": ("unit_price", "discount_pct", "line_gross_amount", "line_net_amount"),
    "stg_sessions": (),
    "order_items_rollup": ("gross_amount_from_items", "net_amount_from_items"),
    "int_orders_enriched": ("order_total_amount", "items_net_amount", "items_gross_amount"),
    "customer_rollup": ("lifetime_gross_revenue", "avg_order_value"),
    "int_customer_lifetime_metrics": ("lifetime_gross_revenue", "avg_order_value"),
    "dim_product": ("list_price",),
    "dim_customer": ("lifetime_gross_revenue", "avg_order_value"),
    "customer_ltv": ("lifetime_gross_revenue", "avg_order_value"),
    "fct_orders": ("order_total_amount", "items_net_amount", "items_gross_amount"),
    "fct_order_items": ("unit_price", "discount_pct", "line_gross_amount", "line_net_amount"),
    "revenue_ledger": (
        "gross_revenue", "net_revenue", "avg_order_value", "delivered_revenue", "cancelled_revenue",
    ),
    "daily_sessions": (),
    "daily_conversions": ("gross_revenue",),
    "session_funnel": ("gross_revenue", "avg_order_value"),
}

ORACLE_SQL: dict[str, str] = {
    name: with_ctes(select_model(name, cols)) for name, cols in MONEY_COLUMNS.items()
}

ORACLE_SQL["filter_revenue_orders"] = with_ctes(
    "SELECT order_id, customer_id, order_status, CAST(ROUND(total_amount, 4) AS DOUBLE) AS total_amount "
    "FROM revenue_orders"
)
ORACLE_SQL["surrogate_key"] = with_ctes(
    "SELECT order_id, line_item_id, order_item_sk FROM stg_order_items"
)
ORACLE_SQL["line_amounts_exact"] = with_ctes(
    "SELECT order_item_sk, CAST(quantity AS VARCHAR) AS quantity, CAST(unit_price AS VARCHAR) AS unit_price, "
    "CAST(CAST(discount_pct AS DECIMAL(38,9)) AS VARCHAR) AS discount_pct, "
    "CAST(line_gross_amount AS VARCHAR) AS line_gross_amount, CAST(line_net_amount AS VARCHAR) AS line_net_amount "
    "FROM stg_order_items",
    faulty=True,
)
ORACLE_SQL["order_total_mismatch"] = with_ctes(
    "SELECT order_id, CAST(ROUND(order_total_amount, 4) AS DOUBLE) AS order_total_amount, "
    "CAST(ROUND(items_net_amount, 4) AS DOUBLE) AS items_net_amount, has_total_mismatch "
    "FROM int_orders_enriched"
)
ORACLE_SQL["recency_segment"] = with_ctes(
    "SELECT recency_segment, COUNT(*) AS customers, MIN(days_since_last_order) AS min_days, "
    "MAX(days_since_last_order) AS max_days FROM int_customer_lifetime_metrics GROUP BY recency_segment"
)


# --- data tests ------------------------------------------------------------------
# Which test applies to which column, written down here once more so
# that a test that is forgotten in the library turns red.
STATUSES = "placed paid shipped delivered cancelled"
TIERS = "bronze silver gold platinum"
NOT_NULL = """
raw_orders: order_id customer_id placed_at _loaded_at
raw_customers: customer_id email
raw_order_items: order_id line_item_id
raw_products: product_id sku
raw_sessions: session_id started_at
stg_orders: order_id order_sk customer_id placed_at order_date _loaded_at
stg_customers: customer_id customer_sk email country
stg_order_items: order_item_sk order_id line_item_id
stg_products: product_id sku
stg_sessions: session_sk session_id started_at
dim_customer: customer_sk customer_id email country
dim_product: product_sk product_id sku
fct_orders: order_sk order_id customer_sk order_date
fct_order_items: order_item_sk order_id product_id
revenue_ledger: revenue_date
customer_ltv: customer_sk
session_funnel: funnel_date traffic_source
"""
UNIQUE = """
raw_orders: order_id
raw_customers: customer_id
raw_products: product_id sku
raw_sessions: session_id
stg_orders: order_id order_sk
stg_customers: customer_id customer_sk email
stg_order_items: order_item_sk
stg_products: product_id sku
stg_sessions: session_sk session_id
dim_customer: customer_sk customer_id
dim_product: product_sk product_id sku
fct_orders: order_sk order_id
fct_order_items: order_item_sk
customer_ltv: customer_sk
"""
UNIQUE_COMBINATION = """
raw_order_items: order_id,line_item_id
stg_order_items: order_id,line_item_id
"""
NON_NEGATIVE = """
raw_orders: total_amount
raw_order_items: quantity
raw_products: price
stg_orders: total_amount
stg_order_items: quantity line_net_amount
stg_products: list_price
dim_customer: lifetime_order_count lifetime_gross_revenue
dim_product: list_price
fct_orders: order_total_amount
fct_order_items: line_net_amount
revenue_ledger: order_count gross_revenue net_revenue
session_funnel: session_count
"""
IN_SET = [
    ("raw_orders", "order_status", STATUSES),
    ("stg_orders", "order_status", STATUSES),
    ("stg_customers", "tier", TIERS),
    ("dim_customer", "tier", TIERS),
    ("dim_customer", "recency_segment", "never_ordered active recent dormant churned"),
    ("customer_ltv", "ltv_segment", "whale high_value mid_value low_value non_buyer"),
]
PARENTS = [
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("fct_orders", "customer_sk", "dim_customer", "customer_sk"),
    ("fct_order_items", "order_id", "fct_orders", "order_id"),
    ("fct_order_items", "product_id", "dim_product", "product_id"),
]
# Numbers by the type that has to hold them, and amounts by what they are computed from.
FITS = {("raw_order_items", "quantity"): "BIGINT", ("raw_order_items", "unit_price"): "DECIMAL(38,9)",
        ("raw_order_items", "discount"): "DECIMAL(38,9)", ("raw_orders", "total_amount"): "DECIMAL(38,9)",
        ("raw_products", "price"): "DECIMAL(38,9)"}
COMPUTED = {("stg_order_items", "line_gross_amount"): "quantity + unit_price",
            ("stg_order_items", "line_net_amount"): "line_gross_amount + discount_pct"}
# What names a row of a model in a report.
ROW_NAMES = {
    "raw_orders": "order_id", "raw_customers": "customer_id", "raw_order_items": "order_id line_item_id",
    "raw_products": "product_id", "raw_sessions": "session_id",
    "stg_orders": "order_sk", "stg_customers": "customer_sk", "stg_order_items": "order_item_sk",
    "stg_products": "product_sk", "stg_sessions": "session_sk", "dim_customer": "customer_sk",
    "dim_product": "product_sk", "fct_orders": "order_sk", "fct_order_items": "order_item_sk",
    "revenue_ledger": "revenue_date currency customer_country customer_tier", "customer_ltv": "customer_sk",
    "session_funnel": "funnel_date traffic_source device_type",
}


def _applied(table: str) -> list[tuple[str, str]]:
    lines = [line.split(":") for line in table.strip().splitlines()]
    return [(model, column) for model, columns in lines for column in columns.split()]


def _text(columns: list[str]) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    return texts[0] if len(texts) == 1 else f"concat_ws('|', {', '.join(texts)})"


def _report(model: str, test: str, column: str, shown: str, rest: str) -> str:
    return f"SELECT '{model}' AS model, '{test}' AS test_name, '{column}' AS column_name, {shown} FROM {model} {rest}"


def _rows(test: str, applied: list[tuple[str, str]], fails) -> list[tuple[str, str, str, str]]:
    return [(m, test, c, _report(m, test, c, f"{_text(ROW_NAMES[m].split())} AS row_id", "WHERE " + fails(m, c)))
            for m, c in applied]


def _repeated(test: str, applied: list[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    out = []
    for m, c in applied:
        known = f"WHERE {c} IS NOT NULL" if test == "unique" else ""
        out.append((m, test, c, _report(m, test, c, f"{_text(c.split(','))} AS key_value, COUNT(*) AS n_rows",
                                        f"{known} GROUP BY {c} HAVING COUNT(*) > 1")))
    return out


def _below_zero(model: str, column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE) < 0" if model.startswith("raw_") else f"{column} < 0"


def _quoted(words: str) -> str:
    return ", ".join(f"'{w}'" for w in words.split())


_SETS = {(m, c): words for m, c, words in IN_SET}
TESTS = {
    "not_null": _rows("not_null", _applied(NOT_NULL), lambda m, c: f"{c} IS NULL"),
    "non_negative": _rows("non_negative", _applied(NON_NEGATIVE), _below_zero),
    "values_in_set": _rows("values_in_set", list(_SETS), lambda m, c: f"{c} NOT IN ({_quoted(_SETS[m, c])})"),
    "recent_timestamp": _rows(
        "recent_timestamp",
        [(f"stg_{s}", "_loaded_at") for s in ("orders", "customers", "products", "order_items", "sessions")],
        lambda m, c: f"{c} < {AS_OF} - INTERVAL 1 DAY"),
    "within_range": _rows("within_range", [("stg_order_items", "discount_pct")], lambda m, c: f"{c} < 0 OR {c} > 1"),
    "fits_type": _rows("fits_type", list(FITS),
                       lambda m, c: f"TRY_CAST({c} AS DOUBLE) IS NOT NULL AND TRY_CAST({c} AS {FITS[m, c]}) IS NULL"),
    "computed": _rows("computed", list(COMPUTED), lambda m, c: f"{c} IS NULL AND " + " AND ".join(
        f"{i} IS NOT NULL" for i in COMPUTED[m, c].split(" + "))),
    "unique": _repeated("unique", _applied(UNIQUE)),
    "unique_combination": _repeated("unique_combination", _applied(UNIQUE_COMBINATION)),
    "relationships": [
        (m, "relationships", c, _report(
            m, "relationships", c, f"{_text(ROW_NAMES[m].split())} AS row_id, CAST({c} AS VARCHAR) AS key_value",
            f"WHERE {c} NOT IN (SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL)"))
        for m, c, parent, pc in PARENTS],
}
_ORPHANS = """SELECT * FROM (
    SELECT order_id, line_item_id, order_item_sk FROM stg_order_items
    WHERE order_id IS NULL
       OR order_id NOT IN (SELECT order_id FROM stg_orders WHERE order_id IS NOT NULL AND order_status IS DISTINCT FROM 'cancelled')
       OR order_id IN (SELECT order_id FROM stg_orders WHERE order_status = 'cancelled'))
ORDER BY ALL ASC NULLS FIRST LIMIT 100"""
_DISCOUNTS = "SELECT order_item_sk FROM fct_order_items WHERE discount_pct >= 1.0"


def _drift(ledger: str) -> str:
    return f"""SELECT CAST(round(ledger, 4) AS DOUBLE) AS ledger_total, CAST(round(fact, 4) AS DOUBLE) AS fact_total,
       CAST(round(ledger - fact, 4) AS DOUBLE) AS delta
FROM (SELECT sum(money) FILTER (side = 'ledger') AS ledger, sum(money) FILTER (side = 'fact') AS fact
      FROM ({ledger}
            UNION ALL SELECT 'fact', order_total_amount FROM fct_orders
            WHERE order_status IN (SELECT DISTINCT order_status FROM revenue_orders)))
WHERE abs(ledger - fact) > 0.01"""


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


for _name in ("not_null", "non_negative", "values_in_set", "recent_timestamp", "within_range", "fits_type", "computed", "unique",
              "unique_combination"):
    ORACLE_SQL[f"test_{_name}"] = with_ctes(_union(sql for *_, sql in TESTS[_name]), faulty=True)
ORACLE_SQL["test_relationships"] = with_ctes(_union(sql for *_, sql in TESTS["relationships"]))
ORACLE_SQL["test_no_orphaned_order_items"] = with_ctes(_ORPHANS)
# The ledger's last build knew the orders placed before 2001.
ORACLE_SQL["test_revenue_reconciliation"] = with_ctes(_drift(
    "SELECT 'ledger' AS side, total_amount AS money FROM revenue_orders WHERE order_date < DATE '2001-01-01'"))
ORACLE_SQL["test_discount_below_one"] = with_ctes(_DISCOUNTS, faulty=True)

_SINGULAR = [
    ("stg_order_items", "no_orphaned_order_items", "order_id", _ORPHANS),
    ("revenue_ledger", "revenue_reconciliation", "gross_revenue",
     _drift("SELECT 'ledger' AS side, gross_revenue AS money FROM revenue_ledger")),
    ("fct_order_items", "discount_below_one", "discount_pct", _DISCOUNTS),
]
ORACLE_SQL["dq_summary"] = with_ctes(
    "SELECT *, if(failing_rows = 0, 'pass', 'fail') AS status FROM (\n"
    + _union(f"SELECT '{m}' AS model, '{test}' AS test_name, '{c}' AS column_name, COUNT(*) AS failing_rows FROM ({sql}) t"
             for m, test, c, sql in [entry for entries in TESTS.values() for entry in entries] + _SINGULAR)
    + "\n) s",
    faulty=True,
)


# --- freshness and run metadata ---------------------------------------------------
_RAW_SOURCES = ("customers", "products", "orders", "order_items", "sessions")
ORACLE_SQL["source_freshness"] = with_ctes(
    f"""SELECT source, max_loaded_at, age_in_seconds,
       CASE WHEN age_in_seconds IS NULL THEN 'error'
            WHEN age_in_seconds > 24 * 3600 THEN 'error'
            WHEN age_in_seconds > 6 * 3600 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT source, max_loaded_at, date_sub('second', max_loaded_at, {AS_OF}) AS age_in_seconds
      FROM ("""
    + _union(f"SELECT '{s}' AS source, MAX(_loaded_at) AS max_loaded_at FROM raw_{s}" for s in _RAW_SOURCES)
    + ") x) y"
)
_MARTS = ("dim_customer", "dim_product", "fct_orders", "fct_order_items", "revenue_ledger",
          "customer_ltv", "session_funnel")
ORACLE_SQL["last_refresh"] = with_ctes(
    _union(
        f"SELECT '{m}' AS model, MAX(_built_at) AS last_built_at, COUNT(*) AS row_count FROM {m}"
        for m in _MARTS
    )
)

# --- metrics ----------------------------------------------------------------------
from oracle.duckdb_sql import div9  # noqa: E402

_GROSS = "CAST(ROUND(SUM(order_total_amount), 4) AS DOUBLE)"
_NET = "CAST(ROUND(SUM(items_net_amount), 4) AS DOUBLE)"
_ORDERS = "COUNT(DISTINCT order_sk)"
_AOV = f"CAST(ROUND({div9('SUM(order_total_amount)', 'COUNT(DISTINCT order_sk)')}, 4) AS DOUBLE)"
_UPO = "SUM(total_quantity) / NULLIF(COUNT(DISTINCT order_sk), 0)"


def _daily(expr: str, name: str) -> str:
    return with_ctes(
        f"SELECT order_date AS order_date__day, {expr} AS {name} FROM fct_orders GROUP BY order_date"
    )


ORACLE_SQL["metric_gross_revenue"] = _daily(_GROSS, "gross_revenue")
ORACLE_SQL["metric_net_revenue"] = _daily(_NET, "net_revenue")
ORACLE_SQL["metric_orders"] = _daily(_ORDERS, "orders")
ORACLE_SQL["metric_item_quantity"] = _daily("CAST(SUM(total_quantity) AS BIGINT)", "item_quantity")
ORACLE_SQL["metric_average_order_value"] = _daily(_AOV, "average_order_value")
ORACLE_SQL["metric_units_per_order"] = _daily(_UPO, "units_per_order")
ORACLE_SQL["metric_revenue_by_country"] = with_ctes(
    f"""SELECT customer_country, customer_tier AS tier, {_GROSS} AS gross_revenue, {_NET} AS net_revenue,
       {_ORDERS} AS orders, {_AOV} AS average_order_value
FROM fct_orders GROUP BY customer_country, customer_tier"""
)
ORACLE_SQL["metric_revenue_by_status"] = with_ctes(
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_date__month, order_status,
       {_GROSS} AS gross_revenue, {_ORDERS} AS orders, {_UPO} AS units_per_order
FROM fct_orders GROUP BY CAST(date_trunc('month', order_date) AS DATE), order_status"""
)


def _by_period(grain: str, dimensions: dict[str, str], values: dict[str, str], where: str = "TRUE") -> str:
    keys = {f"order_date__{grain}": f"CAST(date_trunc('{grain}', order_date) AS DATE)", **dimensions}
    shown = ", ".join(f"{sql} AS {name}" for name, sql in {**keys, **values}.items())
    return with_ctes(f"SELECT {shown} FROM fct_orders WHERE {where} GROUP BY {', '.join(keys.values())}")


ORACLE_SQL["metric_weekly_gold"] = _by_period(
    "week", {}, {"net_revenue": _NET, "average_order_value": _AOV, "units_per_order": _UPO}, "customer_tier = 'gold'")
ORACLE_SQL["metric_tier_filter"] = _by_period(
    "month", {"order_status": "order_status"}, {"gross_revenue": _GROSS, "orders": _ORDERS, "units_per_order": _UPO},
    "customer_tier IN ('gold', 'platinum') AND currency = 'USD'")
ORACLE_SQL["metric_nested_derived"] = with_ctes(
    """SELECT order_status, CAST(bad AS BIGINT) AS mismatches,
       CASE WHEN bad * placed = 0 THEN NULL ELSE CAST(units AS DOUBLE) / (2.0 * CAST(bad AS DOUBLE) * CAST(placed AS DOUBLE)) END
           AS units_per_mismatch
FROM (SELECT order_status, count(DISTINCT order_sk) AS placed, sum(total_quantity) AS units,
             sum(CASE WHEN order_status = 'placed' OR NOT has_total_mismatch THEN 0 ELSE 1 END) AS bad
      FROM fct_orders WHERE customer_tier <> 'bronze' GROUP BY order_status)""")
ORACLE_SQL["metric_quarterly_by_country"] = _by_period(
    "quarter", {"customer_country": "customer_country"},
    {"gross_revenue": _GROSS, "orders": _ORDERS, "item_quantity": "CAST(SUM(total_quantity) AS BIGINT)"},
    "currency <> 'USD'")
ORACLE_SQL["metric_yearly_by_tier"] = _by_period(
    "year", {"tier": "customer_tier"}, {"gross_revenue": _GROSS, "average_order_value": _AOV})
ORACLE_SQL["time_spine"] = with_ctes(
    f"""SELECT s.date_day, COALESCE(d.orders, 0) AS orders,
       CAST(ROUND(COALESCE(d.gross, 0), 4) AS DOUBLE) AS gross_revenue
FROM (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM fct_orders) s
LEFT JOIN (SELECT order_date, {_ORDERS} AS orders, SUM(order_total_amount) AS gross
           FROM fct_orders GROUP BY order_date) d ON s.date_day = d.order_date"""
)


# --- incremental upsert (UNION ALL form of MERGE) ------------------------------------
# The columns of both facts, and those that a matched order updates.
FCT_ORDERS_COLUMNS = (
    "order_sk order_id order_status currency order_total_amount items_net_amount items_gross_amount line_item_count "
    "total_quantity distinct_product_count has_total_mismatch placed_at updated_at order_date customer_sk customer_id "
    "customer_email customer_country customer_tier _built_at").split()
FCT_ORDER_ITEMS_COLUMNS = (
    "order_item_sk order_id line_item_id product_id customer_id order_date quantity unit_price discount_pct "
    "line_gross_amount line_net_amount _built_at").split()
FCT_ORDERS_UPDATE_COLUMNS = (
    "order_status order_total_amount items_net_amount items_gross_amount line_item_count total_quantity "
    "has_total_mismatch updated_at _built_at").split()

_B1 = "TIMESTAMP '2001-01-01 00:00:00'"
_B2 = "TIMESTAMP '2001-08-02 00:00:00'"


def merge_sql(target: str, source: str, key: str, cols, update_cols=None) -> str:
    upd = set(cols) if update_cols is None else set(update_cols)
    matched = ", ".join(f"s.{c}" if c in upd else f"t.{c}" for c in cols)
    plain_t = ", ".join(f"t.{c}" for c in cols)
    plain_s = ", ".join(f"s.{c}" for c in cols)
    return f"""SELECT {matched} FROM {target} t JOIN {source} s ON t.{key} = s.{key}
UNION ALL
SELECT {plain_t} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.{key} = t.{key})
UNION ALL
SELECT {plain_s} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{key} = s.{key})"""


_UPSERT_CTES = {
    "orders_batch1": f"SELECT * REPLACE ({_B1} AS _built_at) FROM fct_orders WHERE order_date < DATE '2001-01-01'",
    "orders_batch2": f"""SELECT * REPLACE (
    CASE WHEN order_id % 20 = 0 THEN 'delivered' ELSE order_status END AS order_status,
    CAST(CASE WHEN order_id % 20 = 0 THEN order_total_amount + 1 ELSE order_total_amount END AS DECIMAL(18,4))
        AS order_total_amount,
    CASE WHEN order_id % 20 = 0 THEN {_B2} ELSE updated_at END AS updated_at,
    'ZZ' AS customer_country,
    {_B2} AS _built_at) FROM fct_orders""",
    "orders_source": """SELECT * FROM orders_batch2
WHERE updated_at > (SELECT MAX(_built_at) FROM orders_batch1) - INTERVAL 3 DAY""",
    "items_batch1": f"SELECT * REPLACE ({_B1} AS _built_at) FROM fct_order_items WHERE order_date < DATE '2001-01-01'",
    "items_batch2": f"""SELECT * REPLACE (
    CASE WHEN order_id % 20 = 0 AND line_item_id % 10 = 1 THEN quantity + 1 ELSE quantity END AS quantity,
    CASE WHEN order_id % 50 = 0 THEN order_date + 1 ELSE order_date END AS order_date,
    {_B2} AS _built_at) FROM fct_order_items""",
    "items_source": """SELECT * FROM items_batch2
WHERE order_date >= (SELECT MAX(order_date) FROM items_batch1) - 3""",
    "items_batch1_undated": """SELECT * REPLACE (CASE WHEN order_id % 70 = 0 THEN NULL ELSE order_date END AS order_date)
FROM items_batch1""",
    "items_source_undated": """SELECT * FROM items_batch2
WHERE order_date >= (SELECT MAX(order_date) FROM items_batch1_undated) - 3""",
}
_UPSERT_CTES["orders_merged"] = merge_sql(
    "orders_batch1", "orders_source", "order_sk", FCT_ORDERS_COLUMNS, FCT_ORDERS_UPDATE_COLUMNS
)
_UPSERT_CTES["items_merged"] = merge_sql("items_batch1", "items_source", "order_item_sk", FCT_ORDER_ITEMS_COLUMNS)

ORACLE_SQL["fct_orders_incremental"] = with_ctes(
    select_model("orders_merged", MONEY_COLUMNS["fct_orders"]), _UPSERT_CTES
)
ORACLE_SQL["fct_order_items_incremental"] = with_ctes(
    select_model("items_merged", MONEY_COLUMNS["fct_order_items"]), _UPSERT_CTES
)
_UPSERT_CTES["items_merged_undated"] = merge_sql(
    "items_batch1_undated", "items_source_undated", "order_item_sk", FCT_ORDER_ITEMS_COLUMNS)
ORACLE_SQL["fct_orders_published"] = ORACLE_SQL["fct_orders_incremental"]
ORACLE_SQL["fct_order_items_published"] = with_ctes(
    select_model("items_merged_undated", MONEY_COLUMNS["fct_order_items"]), _UPSERT_CTES
)


# --- SCD2 (UNION ALL form) ------------------------------------------------------------
_S1 = "TIMESTAMP '2001-01-01 00:00:00'"
_S2 = "TIMESTAMP '2001-02-01 00:00:00'"
_S3 = "TIMESTAMP '2001-03-01 00:00:00'"
_CUST_COLS = ("customer_id", "email", "country", "tier", "created_at", "updated_at")
_CUST_CHECK = ("email", "country", "tier")
_PROD_COLS = ("product_id", "sku", "product_name", "description", "category", "list_price", "is_active",
              "updated_at")
_PROD_CHECK = ("sku", "product_name", "category", "list_price", "is_active")


def _scd_id(key_expr: str, as_of: str) -> str:
    return f"sha256(COALESCE(CAST({key_expr} AS VARCHAR), '∅') || '||' || CAST({as_of} AS VARCHAR))"


def scd2_first_sql(current: str, key: str, cols, as_of: str) -> str:
    c = ", ".join(f"c.{x}" for x in cols)
    return f"SELECT {c}, {_scd_id('c.' + key, as_of)} AS scd_id, {as_of} AS valid_from, " \
           f"CAST(NULL AS TIMESTAMP) AS valid_to FROM {current} c WHERE c.{key} IS NOT NULL"


def scd2_next_sql(history: str, current: str, key: str, cols, check, as_of: str) -> str:
    same = " AND ".join(f"h.{x} IS NOT DISTINCT FROM c.{x}" for x in check)
    hc = ", ".join(f"h.{x}" for x in cols)
    cc = ", ".join(f"c.{x}" for x in cols)
    allc = ", ".join(cols)
    return f"""SELECT {allc}, scd_id, valid_from, valid_to FROM {history} WHERE valid_to IS NOT NULL
UNION ALL
SELECT {hc}, h.scd_id, h.valid_from,
       CASE WHEN c.{key} IS NULL THEN {as_of}
            WHEN NOT ({same}) THEN {as_of}
            ELSE NULL END AS valid_to
FROM (SELECT * FROM {history} WHERE valid_to IS NULL) h LEFT JOIN {current} c ON h.{key} = c.{key}
UNION ALL
SELECT {cc}, {_scd_id('c.' + key, as_of)} AS scd_id, {as_of} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
FROM {current} c LEFT JOIN (SELECT * FROM {history} WHERE valid_to IS NULL) h ON h.{key} = c.{key}
WHERE c.{key} IS NOT NULL AND (h.{key} IS NULL OR NOT ({same}))"""


_SCD_CTES = {
    "customers_v1": "SELECT customer_id, email, country, tier, created_at, updated_at FROM stg_customers",
    "customers_v2": """SELECT customer_id, email,
       CASE WHEN customer_id % 10 = 2 THEN NULL ELSE country END AS country,
       CASE WHEN customer_id % 10 = 1 THEN 'platinum' ELSE tier END AS tier,
       created_at,
       CASE WHEN customer_id % 10 = 3 THEN updated_at + INTERVAL '1' DAY ELSE updated_at END AS updated_at
FROM customers_v1 WHERE customer_id % 50 <> 0
UNION ALL
SELECT customer_id + 1000000, 'new' || email, country, tier, created_at, updated_at
FROM customers_v1 WHERE customer_id % 100 = 5""",
    "customers_v3": """SELECT * FROM customers_v2 WHERE customer_id % 7 <> 0
UNION ALL SELECT * FROM customers_v1 WHERE customer_id % 50 = 0""",
    "products_v1": "SELECT " + ", ".join(_PROD_COLS) + " FROM stg_products",
    "products_v2": """SELECT product_id, sku,
       CASE WHEN product_id % 10 = 1 THEN product_name || ' v2' ELSE product_name END AS product_name,
       CASE WHEN product_id % 10 = 4 THEN description || ' (revised)' ELSE description END AS description,
       category,
       CAST(CASE WHEN product_id % 10 = 2 THEN list_price + 1 ELSE list_price END AS DECIMAL(18,4)) AS list_price,
       CASE WHEN product_id % 10 = 3 THEN NOT is_active ELSE is_active END AS is_active,
       CASE WHEN product_id % 10 = 4 THEN updated_at + INTERVAL '1' DAY ELSE updated_at END AS updated_at
FROM products_v1 WHERE product_id % 25 <> 0
UNION ALL
SELECT product_id + 1000000, 'NEW-' || sku, product_name, description, category, list_price, is_active, updated_at
FROM products_v1 WHERE product_id % 100 = 7""",
}
_SCD_CTES["cust_h1"] = scd2_first_sql("customers_v1", "customer_id", _CUST_COLS, _S1)
_SCD_CTES["cust_h2"] = scd2_next_sql("cust_h1", "customers_v2", "customer_id", _CUST_COLS, _CUST_CHECK, _S2)
_SCD_CTES["cust_h3"] = scd2_next_sql("cust_h2", "customers_v3", "customer_id", _CUST_COLS, _CUST_CHECK, _S3)
_SCD_CTES["prod_h1"] = scd2_first_sql("products_v1", "product_id", _PROD_COLS, _S1)
_SCD_CTES["prod_h2"] = scd2_next_sql("prod_h1", "products_v2", "product_id", _PROD_COLS, _PROD_CHECK, _S2)

ORACLE_SQL["snap_customers_initial"] = with_ctes("SELECT * FROM cust_h1", _SCD_CTES)
ORACLE_SQL["snap_customers_changes"] = with_ctes("SELECT * FROM cust_h2", _SCD_CTES)
ORACLE_SQL["snap_customers_deletes"] = with_ctes("SELECT * FROM cust_h3", _SCD_CTES)
ORACLE_SQL["snap_products_changes"] = with_ctes(select_model("prod_h2", ("list_price",)), _SCD_CTES)

ORACLE_SQL["snap_period_overlaps"] = with_ctes(
    """SELECT customer_id, scd_id, valid_from, valid_to, prev_valid_from, prev_valid_to FROM (
  SELECT customer_id, scd_id, valid_from, valid_to,
         LAG(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from, scd_id) AS prev_valid_from,
         LAG(valid_to) OVER (PARTITION BY customer_id ORDER BY valid_from, scd_id) AS prev_valid_to
  FROM (SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN valid_to + INTERVAL 40 DAY ELSE valid_to END AS valid_to)
        FROM cust_h3)) x
WHERE prev_valid_from IS NOT NULL AND (prev_valid_to IS NULL OR prev_valid_to > valid_from)""",
    _SCD_CTES,
)
