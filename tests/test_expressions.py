import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.functions import expressions as E


def test_safe_cast_never_throws(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,), ("1.5",)], "x string")
    out = [r[0] for r in df.select(E.safe_cast("x", "INT64")).collect()]
    assert out == [12, None, None, None]
    out = [r[0] for r in df.select(E.safe_cast("x", "NUMERIC")).collect()]
    assert out == [Decimal("12.0000"), None, None, Decimal("1.5000")]


def test_surrogate_key_matches_sha256(spark):
    df = spark.createDataFrame([("1", "2"), (None, "2")], "a string, b string")
    got = [r[0] for r in df.select(E.surrogate_key(["a", "b"])).collect()]
    assert got[0] == hashlib.sha256("1||2".encode()).hexdigest()
    assert got[1] == hashlib.sha256("∅||2".encode()).hexdigest()


def test_total_mismatch_flag_edges(spark):
    rows = [
        (Decimal("100"), Decimal("98.9")),   # 1.1 % off -> True
        (Decimal("100"), Decimal("99.0")),   # exactly 1 % -> False
        (Decimal("100"), None),              # no items -> False
        (Decimal("0"), Decimal("5")),        # zero total -> NULL ratio -> False
        (Decimal("-100"), Decimal("50")),    # negative total -> negative ratio -> False
        (None, Decimal("5")),
        # one per cent has eleven digits here; the limits lie between two values of nine digits
        (Decimal("0.000000149"), Decimal("0.000000148")),  # 1e-9 off, limit 1.49e-9 -> False
        (Decimal("0.000000149"), Decimal("0.000000147")),
        (Decimal("0.000000151"), Decimal("0.000000149")),  # 2e-9 off, limit 1.51e-9 (rounds to 2e-9) -> True
        (Decimal("0.000000200"), Decimal("0.000000198")),  # exactly 1 % -> False
        (Decimal("98765432109876543210987654321.000000151"), Decimal("97777777788777777778877777778")),
        (Decimal("100"), Decimal("-99999999999999999999999999999.9")),
    ]
    df = spark.createDataFrame(rows, "t decimal(38,9), n decimal(38,9)")
    got = [r[0] for r in df.select(E.total_mismatch_flag("t", "n")).collect()]
    want = [bool(n is not None and t is not None and t > 0 and abs(t - n) * 100 > t) for t, n in rows]
    assert got == want and want[6:9] == [False, True, True]


def test_recency_bucket_edges(spark):
    df = spark.createDataFrame([(None,), (30,), (31,), (90,), (91,), (365,), (366,)], "d bigint")
    got = [r[0] for r in df.select(E.recency_segment("d")).collect()]
    assert got == ["never_ordered", "active", "recent", "recent", "dormant", "dormant", "churned"]


def test_ltv_bucket_edges(spark):
    vals = ["5000", "4999.99", "1000", "999.99", "100", "99.99", "0.01", "0", "-5"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "r decimal(18,4)")
    got = [r[0] for r in df.select(E.ltv_segment("r")).collect()]
    assert got == ["whale", "high_value", "high_value", "mid_value", "mid_value", "low_value",
                   "low_value", "non_buyer", "non_buyer"]


def test_money_ratio_is_exact_half_up_and_safe(spark):
    df = spark.createDataFrame(
        [(Decimal("20.0003"), 2), (Decimal("1"), 0), (Decimal("1"), None), (Decimal("-20.0003"), 2)],
        "n decimal(18,4), d bigint",
    )
    got = [r[0] for r in df.select(E.money_ratio("n", "d")).collect()]
    assert got == [Decimal("10.00015"), None, None, Decimal("-10.00015")]
    thirds = spark.createDataFrame([(Decimal("2"), 3), (Decimal("-2"), 3)], "n decimal(38,9), d bigint")
    assert [r[0] for r in thirds.select(E.money_ratio("n", "d")).collect()] == [Decimal("0.666666667"), Decimal("-0.666666667")]


def test_initcap_and_trims(spark):
    df = spark.createDataFrame([("  jean-luc  ", " BUILDING ")], "a string, b string")
    r = df.select(E.initcap_trim("a"), E.initcap_trim("b"), E.upper_trim("a"), E.lower_trim("b")).first()
    assert tuple(r) == ("Jean-Luc", "Building", "JEAN-LUC", "building")


def test_ts_literal_is_zone_free(spark):
    r = spark.range(1).select(E.ts_literal("2001-08-02 00:00:00").alias("t")).first()
    assert r["t"] == dt.datetime(2001, 8, 2)


def test_value_literal_is_zone_free(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "t timestamp_ntz")
        assert df.filter(F.col("t") == E.value_literal(dt.datetime(2024, 1, 1, 12))).count() == 1
        assert df.filter(F.col("t") > E.value_literal(dt.datetime(2024, 1, 1, 11, 59))).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_order_items_rollup_null_group_is_exact(spark):
    from decimal import Decimal

    from tidemart.plans.intermediate import order_items_rollup

    items = spark.createDataFrame(
        [(None, 1, 2, Decimal(1), Decimal(1)), (None, 2, 1, Decimal(1), Decimal(1)),
         (0, 1, 1, Decimal(2), Decimal(2)), (5, None, 1, Decimal(1), Decimal(1))],
        "order_id bigint, product_id bigint, quantity bigint, line_gross_amount decimal(29,4),"
        " line_net_amount decimal(37,8)",
    )
    got = {r.order_id: (r.line_item_count, r.total_quantity, r.distinct_product_count)
           for r in order_items_rollup(items).collect()}
    assert got == {None: (2, 3, 2), 0: (1, 1, 1), 5: (1, 1, 0)}


def test_agg_with_distinct_count_null_groups(spark):
    from tidemart.functions.aggregates import agg_with_distinct_count

    df = spark.createDataFrame(
        [("a", None, 1, 10), ("a", None, 1, 11), ("a", "", 2, 10), (None, None, 3, None), (None, None, None, 12)],
        "k1 string, k2 string, v bigint, c bigint",
    )
    out = agg_with_distinct_count(
        df, [("k1", F.col("k1")), ("k2", F.col("k2"))], {"s": F.col("v")},
        {"n": F.lit(1), "nv": F.col("v")}, "c", "n_c",
    )
    got = sorted((tuple(r) for r in out.collect()), key=str)
    expect = sorted(
        (tuple(r) for r in df.groupBy("k1", "k2").agg(
            F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.count("v").alias("nv"),
            F.count_distinct("c").alias("n_c")).collect()),
        key=str,
    )
    assert got == expect and len(got) == 3
    assert out.schema["s"].dataType == df.select(F.sum("v")).schema[0].dataType
