import datetime as dt
from decimal import Decimal

from tidemart.plans import staging as S

AS_OF = "2001-08-02 00:00:00"
T = dt.datetime(2001, 1, 1, 10, 0, 0)


def test_stg_orders_filters_raw_key_and_keeps_uncastable_as_null(spark):
    raw = spark.createDataFrame(
        [("1", "7", " Delivered", " eur", "10.5", T, T, T),
         (None, "7", "paid", "usd", "1", T, T, T),
         ("x1", "abc", "PAID ", "usd", "oops", T, T, T)],
        "order_id string, customer_id string, order_status string, currency string, total_amount string,"
        " placed_at timestamp_ntz, updated_at timestamp_ntz, _loaded_at timestamp_ntz",
    )
    out = S.stg_orders(raw, AS_OF).orderBy("order_sk").collect()
    assert len(out) == 2  # NULL raw key dropped
    by_status = {r.order_status: r for r in out}
    assert by_status["delivered"].order_id == 1 and by_status["delivered"].currency == "EUR"
    assert by_status["delivered"].total_amount == Decimal("10.5000")
    bad = by_status["paid"]
    assert bad.order_id is None and bad.customer_id is None and bad.total_amount is None
    assert bad.order_date == dt.date(2001, 1, 1)


def test_stg_order_items_amounts_and_null_discount(spark):
    raw = spark.createDataFrame(
        [("1", "1", "5", "3", "10", "0.1", T), ("1", "2", "5", "2", "7", None, T),
         ("1", "3", "5", "abc", "7", "0.5", T), ("1", None, "5", "2", "7", "0", T)],
        "order_id string, line_item_id string, product_id string, quantity string, unit_price string,"
        " discount string, _loaded_at timestamp_ntz",
    )
    out = {r.line_item_id: r for r in S.stg_order_items(raw, AS_OF).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].line_gross_amount == Decimal("30") and out[1].line_net_amount == Decimal("27")
    assert out[2].discount_pct == Decimal("0") and out[2].line_net_amount == Decimal("14")
    assert out[3].quantity is None and out[3].line_gross_amount is None


def test_stg_products_is_active_default(spark):
    raw = spark.createDataFrame(
        [("1", " S1", "n ", "d", " Cat", "1.0", None, T, T), ("2", "S2", "n", "d", "c", "2", "abc", T, T),
         ("3", "S3", "n", "d", "c", "2", "false", T, T)],
        "product_id string, sku string, name string, description string, category string, price string,"
        " is_active string, updated_at timestamp_ntz, _loaded_at timestamp_ntz",
    )
    out = {r.product_id: r for r in S.stg_products(raw, AS_OF).collect()}
    assert out[1].is_active and out[2].is_active and out[3].is_active is False
    assert out[1].sku == "S1" and out[1].category == "cat" and out[1].product_name == "n"


def test_stg_sessions_open_and_anonymous(spark):
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 200000)
    raw = spark.createDataFrame(
        [("s1", None, " Mobile", "ADS", "X.com", start, start + dt.timedelta(seconds=61), T),
         ("s2", "5", "desktop", None, "x", start, None, T)],
        "session_id string, customer_id string, device_type string, traffic_source string,"
        " referrer_host string, started_at timestamp_ntz, ended_at timestamp_ntz, _loaded_at timestamp_ntz",
    )
    out = {r.session_id: r for r in S.stg_sessions(raw, AS_OF).collect()}
    assert out["s1"].customer_id is None and out["s1"].session_duration_seconds == 61
    assert out["s1"].device_type == "mobile" and out["s1"].traffic_source == "ads"
    assert out["s2"].session_duration_seconds is None and out["s2"].customer_id == 5
    assert out["s1"].session_date == dt.date(2024, 1, 1)


def test_stg_order_items_keeps_large_and_small_values(spark):
    raw = spark.createDataFrame(
        [("1", "1", "5", "1", "20", "100", T), ("1", "2", "5", "1", "20", "150", T), ("1", "3", "5", "20000000000", "2", "0", T),
         ("1", "4", "5", "1", "0.00004", "0.12345", T), ("1", "5", "5", "1", "7", "no number", T)],
        "order_id string, line_item_id string, product_id string, quantity string, unit_price string,"
        " discount string, _loaded_at timestamp_ntz",
    )
    out = {r.line_item_id: r for r in S.stg_order_items(raw, AS_OF).collect()}
    assert out[1].discount_pct == 100 and out[2].discount_pct == 150 and out[2].line_net_amount == -2980
    assert out[3].line_gross_amount == Decimal("40000000000")
    assert out[4].unit_price == Decimal("0.00004") and out[4].discount_pct == Decimal("0.12345")
    assert out[5].discount_pct == 0 and out[5].line_net_amount == 7


def test_text_is_trimmed_of_all_white_space(spark):
    raw = spark.createDataFrame(
        [("1", "7", "PAID\t", "usd\n", "1", T, T, T)],
        "order_id string, customer_id string, order_status string, currency string, total_amount string,"
        " placed_at timestamp_ntz, updated_at timestamp_ntz, _loaded_at timestamp_ntz",
    )
    r = S.stg_orders(raw, AS_OF).first()
    assert (r.order_status, r.currency) == ("paid", "USD")


def test_offsets_and_zoned_columns_become_utc(spark):
    from tidemart.functions.expressions import safe_cast

    texts = spark.createDataFrame(
        [(1, "2024-01-01T01:00:00+05:00"), (2, "2024-01-01 01:00:00"), (3, "2024-01-01"), (4, "2024-01-01T01:00:00.5Z"),
         (5, "soon"), (6, None)], "id bigint, t string")
    want = ["2023-12-31 20:00:00", "2024-01-01 01:00:00", "2024-01-01 00:00:00", "2024-01-01 01:00:00.5", None, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = texts.orderBy("id").select(safe_cast("t", "TIMESTAMP").cast("string").alias("t")).collect()
            assert [r.t for r in got] == want
            zoned = spark.sql("SELECT timestamp '2024-07-01 12:00:00+00:00' AS t")
            assert zoned.select(safe_cast("t", "TIMESTAMP").cast("string").alias("t")).first().t == "2024-07-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
