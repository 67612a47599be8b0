"""Oracle SQL (DuckDB dialect) for every registered query.

Written from the model semantics as plain SQL over the driver's base tables,
independently of the DataFrame code: the raw mapping, staging and marts are
CTEs, and each query selects from them.  Compared outputs follow two rules on
both sides: money (decimal) columns are rounded to 4 digits and returned as
DOUBLE; averages of money are exact quotients rounded half-up to 4 digits.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
AS_OF_DATE = "DATE '2001-08-02'"
REVENUE = "('paid', 'shipped', 'delivered')"


def div9(num: str, den: str) -> str:
    """Exact num/den (num a decimal with <= 9 digits, den an integer) rounded
    half away from zero to 9 digits, as DECIMAL(38,9); NULL if den is 0/NULL."""
    s = f"CAST(({num}) * 1000000000 AS HUGEINT)"
    n = f"CAST(({den}) AS HUGEINT)"
    q = f"sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n}))"
    return (
        f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN NULL "
        f"ELSE {from_units(q)} END)"
    )


def from_units(q: str) -> str:
    """A count of ninth digits as DECIMAL(38,9)."""
    return f"CAST({q} AS DECIMAL(38,0)) * CAST(0.000000001 AS DECIMAL(9,9))"


def units(x: str) -> str:
    """A DECIMAL(38,9) as its count of ninth digits."""
    return f"CAST(replace(CAST({x} AS VARCHAR), '.', '') AS HUGEINT)"


def times(a: str, b: str) -> str:
    """Two counts of ninth digits multiplied to one, rounded half away from zero."""
    return f"(sign({a}) * sign({b}) * ((2 * abs(({a}) * ({b})) + 1000000000) // 2000000000))"


def avg9(x: str) -> str:
    return div9(f"SUM({x})", f"COUNT({x})")


def money(*cols: str) -> str:
    """``* REPLACE`` list turning decimal columns into rounded doubles."""
    return ", ".join(f"CAST(ROUND({c}, 4) AS DOUBLE) AS {c}" for c in cols)


# --- raw mapping (same text as the fixture definition) ---------------------
RAW = {
    "raw_customers": """
SELECT CAST(c_custkey AS STRING) AS customer_id,
       '  ' || c_name || '@EXAMPLE.com ' AS email,
       ' ' || c_mktsegment AS first_name,
       'CUSTOMER' || CAST(c_custkey AS STRING) AS last_name,
       lower(list_extract(['US', 'CA', 'MX', 'BR', 'AR', 'GB', 'DE', 'FR', 'IT', 'ES', 'NL', 'SE', 'IN', 'CN', 'JP', 'KR', 'SG', 'AU', 'NZ', 'ZA', 'EG', 'AE', 'SA'],
             c_nationkey % 23 + 1)) AS country,
       CASE c_custkey % 4 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'SILVER ' WHEN 2 THEN 'gold' ELSE 'Platinum' END AS tier,
       CAST('1994-01-01 00:00:00' AS TIMESTAMP) + (c_custkey % 365) * INTERVAL '1' DAY AS created_at,
       CAST('1995-01-01 00:00:00' AS TIMESTAMP) + (c_custkey % 30) * INTERVAL '1' DAY AS updated_at,
       CAST('2001-08-01 20:00:00' AS TIMESTAMP) - (c_custkey % 5) * INTERVAL '1' HOUR AS _loaded_at
FROM customer""",
    "raw_products": """
SELECT CAST(p_partkey AS STRING) AS product_id,
       ' SKU-' || CAST(p_partkey AS STRING) AS sku,
       p_name || ' ' AS name,
       p_type AS description,
       ' ' || p_brand AS category,
       CAST(p_retailprice AS STRING) AS price,
       CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN 'false' WHEN 2 THEN 'abc' ELSE 'true' END AS is_active,
       CAST('1995-01-01 00:00:00' AS TIMESTAMP) + (p_partkey % 30) * INTERVAL '1' DAY AS updated_at,
       CAST('2001-08-01 12:00:00' AS TIMESTAMP) - (p_partkey % 5) * INTERVAL '1' HOUR AS _loaded_at
FROM part""",
    "raw_orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id,
       CASE WHEN o_orderkey % 400 = 7 THEN '-1' ELSE CAST(o_custkey AS STRING) END AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN ' Delivered'
            WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'CANCELLED'
            WHEN o_orderstatus = 'O' THEN 'shipped '
            WHEN o_orderpriority = '1-URGENT' THEN 'Placed'
            ELSE 'PAID' END AS order_status,
       CASE o_custkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN ' eur' ELSE 'GBP' END AS currency,
       CAST(o_totalprice AS STRING) AS total_amount,
       CAST(o_orderdate AS TIMESTAMP) AS placed_at,
       CAST(o_orderdate AS TIMESTAMP) + (o_orderkey % 10) * INTERVAL '1' DAY AS updated_at,
       CAST('2001-08-01 23:00:00' AS TIMESTAMP) - (o_orderkey % 5) * INTERVAL '1' HOUR AS _loaded_at
FROM orders""",
    "raw_order_items": """
SELECT CAST(CASE WHEN l_orderkey % 500 = 3 THEN -l_orderkey ELSE l_orderkey END AS STRING) AS order_id,
       CAST(l_linenumber + 10 * (datediff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE))
            + 10000 * (l_suppkey + 1000000 * l_partkey)) AS STRING) AS line_item_id,
       CAST(l_partkey AS STRING) AS product_id,
       CASE WHEN l_orderkey % 700 = 5 THEN 'abc' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS quantity,
       CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS STRING) AS unit_price,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_discount AS STRING) END AS discount,
       CAST('2001-08-01 02:00:00' AS TIMESTAMP) - (l_orderkey % 5) * INTERVAL '1' HOUR AS _loaded_at
FROM lineitem""",
    "raw_sessions": """
SELECT CAST(event_id AS STRING) AS session_id,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS customer_id,
       CASE event_id % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN ' desktop' ELSE 'TABLET' END AS device_type,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE upper(event_type) END AS traffic_source,
       'Ref' || CAST(event_id % 5 AS STRING) || '.Example.com' AS referrer_host,
       CAST(ts AS TIMESTAMP) AS started_at,
       CASE WHEN event_id % 7 = 0 THEN NULL
            ELSE CAST(ts AS TIMESTAMP) + CAST(floor(value) AS BIGINT) * INTERVAL '1' SECOND END AS ended_at,
       CAST('2001-07-30 00:00:00' AS TIMESTAMP) - (event_id % 5) * INTERVAL '1' HOUR AS _loaded_at
FROM events WHERE event_type <> 'purchase'""",
    "funnel_orders": """
SELECT user_id AS customer_id, CAST(ts AS DATE) AS order_date,
       CAST(value AS DECIMAL(18,4)) AS order_total_amount
FROM events WHERE event_type = 'purchase'""",
}


# Faults for the data tests, planted by key (same values as tidemart/sources/faults.py).
FAULTS = {
    "raw_orders": """
SELECT * EXCLUDE (k, copy) REPLACE (CASE WHEN k % 211 = 0 THEN NULL ELSE order_id END AS order_id,
                  CASE WHEN k % 97 = 0 THEN 'Lost' ELSE order_status END AS order_status,
                  CASE WHEN k % 89 = 0 THEN '-5.00' ELSE total_amount END AS total_amount,
                  CASE WHEN k % 223 = 0 THEN NULL ELSE placed_at END AS placed_at)
FROM (SELECT *, CAST(order_id AS BIGINT) AS k, unnest(range(CASE WHEN k % 101 = 0 THEN 2 ELSE 1 END)) AS copy FROM clean_orders)""",
    "raw_order_items": """
SELECT * EXCLUDE (k, copy) REPLACE (CASE WHEN k % 227 = 0 THEN NULL ELSE line_item_id END AS line_item_id,
                  CASE WHEN k % 83 = 0 THEN '-3' WHEN k % 151 = 0 THEN '1000000000000' WHEN k % 157 = 0 THEN '99999999999999999999'
                       WHEN k % 163 = 0 THEN '1000000000000' ELSE quantity END AS quantity,
                  CASE WHEN k % 131 = 0 THEN '1000000000' WHEN k % 137 = 0 THEN '0.0000004'
                       WHEN k % 139 = 0 THEN '123456789012345678901234567890123' WHEN k % 163 = 0 THEN '900000000000000000.123456789'
                       WHEN k % 149 = 0 THEN '12345678901234.000000015' ELSE unit_price END AS unit_price,
                  CASE WHEN k % 79 = 0 THEN '1.5' WHEN k % 73 = 0 THEN '150' WHEN k % 167 = 0 THEN '1000'
                       WHEN k % 149 = 0 THEN '0.333333333' ELSE discount END AS discount)
FROM (SELECT *, CAST(order_id AS BIGINT) AS k, unnest(range(CASE WHEN k % 103 = 0 THEN 2 ELSE 1 END)) AS copy FROM clean_order_items)""",
    "raw_customers": """
SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 113 = 0 THEN NULL WHEN k % 53 = 0 THEN 'shared@example.com' ELSE email END AS email,
                  CASE WHEN k % 47 = 0 THEN NULL ELSE country END AS country,
                  CASE WHEN k % 43 = 0 THEN 'tin' ELSE tier END AS tier)
FROM (SELECT *, CAST(customer_id AS BIGINT) AS k FROM clean_customers)""",
    "raw_products": """
SELECT * EXCLUDE (k, copy) REPLACE (CASE WHEN k % 59 = 0 THEN 'SKU-0' ELSE sku END AS sku,
                  CASE WHEN k % 61 = 0 THEN '-1.25' ELSE price END AS price)
FROM (SELECT *, CAST(product_id AS BIGINT) AS k, unnest(range(CASE WHEN k % 67 = 0 THEN 2 ELSE 1 END)) AS copy FROM clean_products)""",
    "raw_sessions": """
SELECT * EXCLUDE (k, copy) REPLACE (CASE WHEN k % 127 = 0 THEN NULL ELSE started_at END AS started_at)
FROM (SELECT *, CAST(session_id AS BIGINT) AS k, unnest(range(CASE WHEN k % 109 = 0 THEN 2 ELSE 1 END)) AS copy FROM clean_sessions)""",
}


def _initcap(x: str) -> str:
    # one-word values: first letter upper, rest lower
    return f"(upper(substr(trim({x}), 1, 1)) || lower(substr(trim({x}), 2)))"


def _sk(*fields: str) -> str:
    parts = " || '||' || ".join(f"COALESCE(CAST({f} AS VARCHAR), '∅')" for f in fields)
    return f"sha256({parts})"


STAGING = {
    "stg_orders": f"""
SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
       TRY_CAST(customer_id AS BIGINT) AS customer_id,
       {_sk('order_id')} AS order_sk,
       lower(trim(order_status)) AS order_status,
       upper(trim(currency)) AS currency,
       TRY_CAST(total_amount AS DECIMAL(38,9)) AS total_amount,
       TRY_CAST(placed_at AS TIMESTAMP) AS placed_at,
       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
       CAST(TRY_CAST(placed_at AS TIMESTAMP) AS DATE) AS order_date,
       TRY_CAST(_loaded_at AS TIMESTAMP) AS _loaded_at,
       {AS_OF} AS _built_at
FROM raw_orders WHERE order_id IS NOT NULL""",
    "stg_customers": f"""
SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id,
       {_sk('customer_id')} AS customer_sk,
       lower(trim(email)) AS email,
       {_initcap('first_name')} AS first_name,
       {_initcap('last_name')} AS last_name,
       upper(trim(country)) AS country,
       lower(trim(tier)) AS tier,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at,
       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
       TRY_CAST(_loaded_at AS TIMESTAMP) AS _loaded_at,
       {AS_OF} AS _built_at
FROM raw_customers WHERE customer_id IS NOT NULL""",
    "stg_products": f"""
SELECT TRY_CAST(product_id AS BIGINT) AS product_id,
       {_sk('product_id')} AS product_sk,
       trim(sku) AS sku,
       trim(name) AS product_name,
       trim(description) AS description,
       lower(trim(category)) AS category,
       TRY_CAST(price AS DECIMAL(38,9)) AS list_price,
       COALESCE(TRY_CAST(is_active AS BOOLEAN), TRUE) AS is_active,
       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
       TRY_CAST(_loaded_at AS TIMESTAMP) AS _loaded_at,
       {AS_OF} AS _built_at
FROM raw_products WHERE product_id IS NOT NULL""",
    "stg_order_items": f"""
SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
       TRY_CAST(line_item_id AS BIGINT) AS line_item_id,
       TRY_CAST(product_id AS BIGINT) AS product_id,
       {_sk('order_id', 'line_item_id')} AS order_item_sk,
       TRY_CAST(quantity AS BIGINT) AS quantity,
       TRY_CAST(unit_price AS DECIMAL(38,9)) AS unit_price,
       COALESCE(TRY_CAST(discount AS DECIMAL(38,9)), 0) AS discount_pct,
       TRY({from_units("gross_units")}) AS line_gross_amount,
       TRY({from_units(times("gross_units", "left_units"))}) AS line_net_amount,
       TRY_CAST(_loaded_at AS TIMESTAMP) AS _loaded_at,
       {AS_OF} AS _built_at
FROM (SELECT *, TRY(CAST(TRY_CAST(quantity AS BIGINT) AS HUGEINT) * {units("TRY_CAST(unit_price AS DECIMAL(38,9))")}) AS gross_units,
             1000000000 - {units("COALESCE(TRY_CAST(discount AS DECIMAL(38,9)), 0)")} AS left_units
      FROM raw_order_items WHERE order_id IS NOT NULL AND line_item_id IS NOT NULL)""",
    "stg_sessions": f"""
SELECT TRY_CAST(session_id AS VARCHAR) AS session_id,
       TRY_CAST(customer_id AS BIGINT) AS customer_id,
       {_sk('session_id')} AS session_sk,
       lower(trim(device_type)) AS device_type,
       lower(trim(traffic_source)) AS traffic_source,
       lower(trim(referrer_host)) AS referrer_host,
       TRY_CAST(started_at AS TIMESTAMP) AS started_at,
       TRY_CAST(ended_at AS TIMESTAMP) AS ended_at,
       CAST(TRY_CAST(started_at AS TIMESTAMP) AS DATE) AS session_date,
       date_sub('second', TRY_CAST(started_at AS TIMESTAMP), TRY_CAST(ended_at AS TIMESTAMP))
           AS session_duration_seconds,
       TRY_CAST(_loaded_at AS TIMESTAMP) AS _loaded_at,
       {AS_OF} AS _built_at
FROM raw_sessions WHERE session_id IS NOT NULL""",
}

def _label(value: str, bounds: list[tuple[float, str]], otherwise: str) -> str:
    """Label of the first bound (upper limits, ascending) that holds ``value``."""
    table = ", ".join(f"({limit}, '{name}')" for limit, name in bounds)
    found = f"(SELECT min_by(b.name, b.edge) FROM (VALUES {table}) AS b(edge, name) WHERE {value} <= b.edge)"
    return f"coalesce({found}, '{otherwise}')"


def _highest(value: str, bounds: list[tuple[float, str]], otherwise: str) -> str:
    """Label of the highest bound (lower limits) that ``value`` reaches."""
    table = ", ".join(f"({limit}, '{name}')" for limit, name in bounds)
    found = f"(SELECT max_by(b.name, b.edge) FROM (VALUES {table}) AS b(edge, name) WHERE {value} >= b.edge)"
    return f"coalesce({found}, '{otherwise}')"


# The limits of the segments.
RECENCY_LIMITS = [(30, "active"), (90, "recent"), (365, "dormant")]
LTV_LIMITS = [(100, "mid_value"), (1000, "high_value"), (5000, "whale")]

INTERMEDIATE = {
    # Distinct products first, so that the order level is a plain count.
    "order_products": """
SELECT order_id, product_id, count(*) AS lines, sum(quantity) AS units,
       sum(line_gross_amount) AS gross, sum(line_net_amount) AS net
FROM stg_order_items GROUP BY ALL""",
    "order_items_rollup": """
SELECT order_id, CAST(sum(lines) AS BIGINT) AS line_item_count, CAST(sum(units) AS BIGINT) AS total_quantity,
       sum(gross) AS gross_amount_from_items, sum(net) AS net_amount_from_items,
       count(product_id) AS distinct_product_count
FROM order_products GROUP BY order_id""",
    # Each order looks its rollup and its customer up.
    "orders_looked_up": """
SELECT ord.*,
       (SELECT struct_pack(net := r.net_amount_from_items, gross := r.gross_amount_from_items, lines := r.line_item_count,
                           units := r.total_quantity, products := r.distinct_product_count)
        FROM order_items_rollup r WHERE r.order_id = ord.order_id) AS basket,
       (SELECT struct_pack(sk := b.customer_sk, id := b.customer_id, email := b.email, country := b.country, tier := b.tier)
        FROM stg_customers b WHERE b.customer_id = ord.customer_id) AS buyer
FROM stg_orders ord""",
    "int_orders_enriched": f"""
SELECT order_sk, order_id, order_status, currency, total_amount AS order_total_amount,
       basket.net AS items_net_amount, basket.gross AS items_gross_amount, basket.lines AS line_item_count,
       basket.units AS total_quantity, basket.products AS distinct_product_count,
       coalesce(total_amount > 0 AND abs(total_amount - basket.net) > total_amount * 0.01, FALSE) AS has_total_mismatch,
       placed_at, updated_at, order_date, buyer.sk AS customer_sk, buyer.id AS customer_id, buyer.email AS customer_email,
       buyer.country AS customer_country, buyer.tier AS customer_tier, {AS_OF} AS _built_at
FROM orders_looked_up""",
    "revenue_orders": f"SELECT * FROM stg_orders WHERE list_contains(list_value{REVENUE}, order_status)",
    "customer_rollup": f"""
SELECT customer_id, n AS lifetime_order_count, money AS lifetime_gross_revenue, {div9('money', 'priced')} AS avg_order_value,
       opened AS first_order_at, latest AS last_order_at,
       CAST(latest AS DATE) - CAST(opened AS DATE) AS active_days, {AS_OF_DATE} - CAST(latest AS DATE) AS days_since_last_order
FROM (SELECT customer_id, count(*) AS n, count(total_amount) AS priced, sum(total_amount) AS money,
             min(placed_at) AS opened, max(placed_at) AS latest
      FROM revenue_orders GROUP BY customer_id)""",
    "int_customer_lifetime_metrics": f"""
WITH buyers AS (
    SELECT who.*, (SELECT spent FROM customer_rollup spent WHERE spent.customer_id = who.customer_id) AS spent FROM stg_customers who)
SELECT customer_sk, customer_id, email, country, tier, created_at AS customer_created_at,
       ifnull(spent.lifetime_order_count, 0) AS lifetime_order_count,
       ifnull(spent.lifetime_gross_revenue, 0) AS lifetime_gross_revenue,
       spent.avg_order_value AS avg_order_value, spent.first_order_at AS first_order_at, spent.last_order_at AS last_order_at,
       spent.active_days AS active_days, spent.days_since_last_order AS days_since_last_order,
       if(spent.days_since_last_order IS NULL, 'never_ordered',
          {_label('spent.days_since_last_order', RECENCY_LIMITS, 'churned')}) AS recency_segment,
       {AS_OF} AS _built_at
FROM buyers""",
}

MARTS = {
    "dim_product": f"SELECT * EXCLUDE (_loaded_at) REPLACE ({AS_OF} AS _built_at) FROM stg_products",
    "dim_customer": f"""
SELECT m.* REPLACE ({AS_OF} AS _built_at), CAST(m.customer_created_at AS DATE) AS customer_created_date
FROM int_customer_lifetime_metrics m""",
    "customer_ltv": f"""
SELECT * EXCLUDE (customer_created_date, active_days) REPLACE ({AS_OF} AS _built_at),
       if(lifetime_gross_revenue >= 100, {_highest('lifetime_gross_revenue', LTV_LIMITS, 'non_buyer')},
          if(lifetime_gross_revenue > 0, 'low_value', 'non_buyer')) AS ltv_segment
FROM dim_customer""",
    "fct_orders": f"SELECT * REPLACE ({AS_OF} AS _built_at) FROM int_orders_enriched",
    "fct_order_items": f"""
WITH dated AS (SELECT order_id, list(struct_pack(customer_id := customer_id, order_date := order_date)) AS same FROM stg_orders GROUP BY order_id),
     spread AS (SELECT l.*, unnest(d.same) AS ord FROM stg_order_items l, dated d WHERE d.order_id = l.order_id)
SELECT order_item_sk, order_id, line_item_id, product_id, ord.customer_id AS customer_id, ord.order_date AS order_date, quantity,
       unit_price, discount_pct, line_gross_amount, line_net_amount, {AS_OF} AS _built_at
FROM spread""",
    "revenue_ledger": f"""
SELECT order_date AS revenue_date, currency, customer_country, customer_tier, count(*) AS order_count,
       ifnull(len(list_distinct(list(customer_id) FILTER (customer_id IS NOT NULL))), 0) AS unique_customer_count,
       sum(order_total_amount) AS gross_revenue, sum(items_net_amount) AS net_revenue,
       {avg9('order_total_amount')} AS avg_order_value,
       ifnull(sum(order_total_amount) FILTER (order_status = 'delivered'), 0) AS delivered_revenue,
       ifnull(sum(order_total_amount) FILTER (order_status = 'cancelled'), 0) AS cancelled_revenue,
       {AS_OF} AS _built_at
FROM fct_orders WHERE list_contains(list_value{REVENUE}, order_status) GROUP BY ALL""",
    # Sessions counted by customer and day, to which a customer's orders of the day are added once.
    "customer_day_sessions": """
SELECT session_date AS funnel_date, traffic_source, device_type, customer_id, count(*) AS visits,
       sum(session_duration_seconds) AS seconds, count(session_duration_seconds) AS timed
FROM stg_sessions GROUP BY ALL""",
    "customer_day_orders": """
SELECT customer_id, order_date, count(*) AS orders, sum(order_total_amount) AS spent FROM funnel_orders GROUP BY ALL""",
    "daily_sessions": """
SELECT funnel_date, traffic_source, device_type, CAST(sum(visits) AS BIGINT) AS session_count,
       count(customer_id) AS authenticated_customer_count,
       CAST(sum(seconds) AS DOUBLE) / nullif(sum(timed), 0) AS avg_session_duration_seconds
FROM customer_day_sessions GROUP BY ALL""",
    "daily_conversions": """
SELECT v.funnel_date, v.traffic_source, v.device_type, count(w.orders) AS converting_customers,
       ifnull(sum(v.visits * w.spent), 0) AS gross_revenue
FROM customer_day_sessions v
LEFT JOIN customer_day_orders w ON w.order_date = v.funnel_date AND w.customer_id = v.customer_id
GROUP BY ALL""",
    "session_funnel": f"""
WITH both_days AS (
    SELECT a.*, (SELECT b FROM daily_conversions b WHERE b.device_type = a.device_type
                 AND b.traffic_source = a.traffic_source AND b.funnel_date = a.funnel_date) AS won
    FROM daily_sessions a)
SELECT * EXCLUDE (won), won.converting_customers AS converting_customers, won.gross_revenue AS gross_revenue,
       won.converting_customers / nullif(authenticated_customer_count, 0) AS conversion_rate,
       {div9('won.gross_revenue', 'won.converting_customers')} AS avg_order_value, {AS_OF} AS _built_at
FROM both_days""",
}

# Every CTE in dependency order; unused ones are dropped by DuckDB.
CTES: dict[str, str] = {**RAW, **STAGING, **INTERMEDIATE, **MARTS}


def with_ctes(final_select: str, extra: dict[str, str] | None = None, faulty: bool = False) -> str:
    ctes = {}
    for name, text in CTES.items():
        if faulty and name in FAULTS:
            ctes[name.replace("raw_", "clean_")] = text
            text = FAULTS[name]
        ctes[name] = text
    ctes.update(extra or {})
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"WITH {body}\n{final_select}"


def select_model(model: str, money_cols: tuple[str, ...] = ()) -> str:
    replace = f" REPLACE ({money(*money_cols)})" if money_cols else ""
    return f"SELECT *{replace} FROM {model}"
