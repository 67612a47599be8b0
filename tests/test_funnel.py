"""The funnel's pre-aggregated form against the brute-force fan-out join
(every session paired with every same-day order of its customer)."""

import datetime as dt
from decimal import Decimal

from tidemart.plans.marts import daily_conversions, session_funnel

from helpers import rows

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SESS = "session_id string, customer_id bigint, traffic_source string, device_type string, session_date date, session_duration_seconds bigint"
ORD = "customer_id bigint, order_date date, order_total_amount decimal(18,4)"


def _data(spark):
    sessions = [("h%d" % i, 1, "ads", "mobile", D1, i) for i in range(40)]       # hot customer
    sessions += [("a1", None, "ads", "mobile", D1, 5), ("a2", None, "ads", "mobile", D1, None),
                 ("n1", 2, None, "desktop", D1, 7), ("n2", 2, "seo", None, D2, 3),
                 ("b1", 3, "seo", "desktop", D2, None), ("b2", 3, "seo", "desktop", D2, 9),
                 ("c1", 4, "seo", "desktop", D2, 1)]
    orders = [(1, D1, Decimal("10.5")), (1, D1, Decimal("2.25")), (1, D2, Decimal("99")),
              (2, D1, Decimal("4")), (3, D2, None), (3, D2, Decimal("1.0001")), (None, D2, Decimal("5")),
              (4, D1, Decimal("8"))]
    return spark.createDataFrame(sessions, SESS), spark.createDataFrame(orders, ORD)


BRUTE = """
WITH ds AS (
  SELECT session_date AS funnel_date, traffic_source, device_type, COUNT(*) AS session_count,
         COUNT(DISTINCT customer_id) AS authenticated_customer_count,
         AVG(session_duration_seconds) AS avg_session_duration_seconds
  FROM s GROUP BY session_date, traffic_source, device_type),
dc AS (
  SELECT s.session_date AS funnel_date, s.traffic_source, s.device_type,
         COUNT(DISTINCT o.customer_id) AS converting_customers,
         COALESCE(SUM(o.order_total_amount), 0) AS gross_revenue
  FROM s LEFT JOIN o ON s.customer_id = o.customer_id AND o.order_date = s.session_date
  GROUP BY s.session_date, s.traffic_source, s.device_type)
SELECT ds.funnel_date, ds.traffic_source, ds.device_type, ds.session_count, ds.authenticated_customer_count,
       ds.avg_session_duration_seconds, dc.converting_customers, dc.gross_revenue,
       try_divide(dc.converting_customers, ds.authenticated_customer_count) AS conversion_rate,
       round(try_divide(dc.gross_revenue, dc.converting_customers), 4) AS avg_order_value
FROM ds LEFT JOIN dc ON ds.funnel_date = dc.funnel_date AND ds.traffic_source = dc.traffic_source
 AND ds.device_type = dc.device_type
"""


def test_funnel_matches_fan_out(spark):
    s, o = _data(spark)
    s.createOrReplaceTempView("s")
    o.createOrReplaceTempView("o")
    brute = spark.sql(BRUTE)
    ours = session_funnel(s, o, "2024-01-03 00:00:00").drop("_built_at")
    def norm(df):
        q = Decimal("0.0001")
        return [tuple(x.quantize(q) if isinstance(x, Decimal) else x for x in r) for r in rows(df)]

    b, u = norm(brute), norm(ours)
    assert u == b
    # the hot customer's two same-day orders count once per session (40 sessions)
    hot = [r for r in rows(ours) if r[1] == "ads" and r[2] == "mobile"][0]
    assert hot[7] == Decimal("12.75") * 40 and hot[6] == 1


def test_daily_conversions_groups_null_keys(spark):
    s, o = _data(spark)
    out = {(r.funnel_date, r.traffic_source, r.device_type): r for r in daily_conversions(s, o).collect()}
    assert out[(D1, None, "desktop")].converting_customers == 1          # NULL source still its own group
    assert out[(D2, "seo", None)].gross_revenue == Decimal("0")
