"""NUMERIC arithmetic against Python's decimals."""

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tidemart.functions.numeric import difference, quotient, with_product

D = Decimal
UNIT, LIMIT = D(1).scaleb(-9), D(10) ** 28


def numbers(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        k = rng.choice([1, 3, 6, 9, 10, 11, 12, 19, 20, 27, 28, 29])
        yield D(rng.choice([1, -1])) * (D(rng.randrange(10**k)) + D(rng.randrange(10**9)).scaleb(-9) * rng.choice([0, 1]))


def test_all_sizes(spark):
    with localcontext() as c:
        c.prec = 120
        edge = [D(0), UNIT, -UNIT, D("0.5"), D("0.0000004"), D(10) ** 9, D(10) ** 12, D(1000), D(10) ** 10 - UNIT, D(10) ** 19,
                LIMIT - UNIT, LIMIT, -LIMIT, D(10) ** 29 - UNIT]
        rows = [(a, b) for a in edge for b in edge] + list(zip(numbers(1, 4000), numbers(2, 4000))) + [(None, D(1)), (D(1), None)]
        df = spark.createDataFrame(rows, "a decimal(38,9), b decimal(38,9)")
        n = (F.col("b") % 1_000_000).cast("bigint")
        out = with_product(df, "p", F.col("a"), F.col("b")).select("a", "b", "p", difference(F.col("a"), F.col("b")).alias("d"),
                        quotient(F.col("a"), n).alias("q"), n.alias("n"))
        fits = lambda x: x if abs(x) < LIMIT else None
        short = lambda x: x.quantize(UNIT, ROUND_HALF_UP)
        got = out.collect()
        assert len(got) == len(rows)
        for r in got:
            if r.a is None or r.b is None:
                assert r.p is None and r.d is None and r.q is None
                continue
            if max(abs(r.a), abs(r.b)) < LIMIT:
                assert r.p == fits(short(r.a * r.b)), (r.a, r.b)
            assert r.d == (r.a - r.b if abs(int(r.a) - int(r.b)) < LIMIT else None), (r.a, r.b)
            assert r.q == (None if r.n == 0 else short(r.a / r.n)), (r.a, r.n)


@pytest.mark.parametrize("qty, price, discount, gross, net", [
    ("7", "1000000000", "0", "7000000000", "7000000000"),
    ("2", "10", "1000", "20", "-19980"),
    ("1000000000000", "900000000000.123456789", "0.1", "900000000000123456789000", "810000000000111111110100"),
    ("1", "0.0000004", "0", "0.000000400", "0.000000400"),
    ("3", "0.000000001", "0.5", "0.000000003", "0.000000002"),
    ("1000000000000000000", "90000000000", "0", None, None),  # the amount doesn't fit
    ("99999999999999999999", "1", "0", None, None),  # the quantity doesn't
    ("1", "123456789012345678901234567890123", "0", None, None),  # the price doesn't
    ("5", "2", "1e40", "10", "10"),  # a discount that doesn't fit is none; fits_type reports it
])
def test_line_amounts(spark, qty, price, discount, gross, net):
    from tidemart.operators import quality as Q
    from tidemart.plans.staging import stg_order_items

    raw = spark.createDataFrame([("1", "1", "1", qty, price, discount, None)], "order_id string, line_item_id string, "
                                "product_id string, quantity string, unit_price string, discount string, _loaded_at timestamp_ntz")
    r = stg_order_items(raw, "2001-08-02 00:00:00").first()
    assert r.line_gross_amount == (None if gross is None else D(gross)) and r.line_net_amount == (None if net is None else D(net))
    lost = sum(Q.fits_type(raw, c, t).count() for c, t in (("quantity", "INT64"), ("unit_price", "NUMERIC"), ("discount", "NUMERIC")))
    lines = stg_order_items(raw, "2001-08-02 00:00:00")
    lost += Q.computed(lines, "line_gross_amount", ("quantity", "unit_price")).count()
    assert (lost > 0) == (gross is None or discount == "1e40")
