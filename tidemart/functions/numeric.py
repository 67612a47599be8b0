"""Exact arithmetic on NUMERIC, decimal(38,9), as Column expressions.

Spark has no decimal wider than 38 digits: a product of two NUMERIC columns
loses fractional digits, and even their difference loses the ninth.  Values of
usual size (up to ten integer digits) take one built-in operation on narrower
decimals, which is exact.  All others are split into limbs, the whole number
and the fraction; the limbs' products and sums fit 38 digits each, without
rounding, and their carries are added up in types that hold them.  Results of
10**28 and more are NULL, which the data tests report.  Everything is built
from small built-in expressions and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

NUMERIC = DecimalType(38, 9)
# Operands whose product (18 fractional digits), and whose difference, stay exact in Spark's own types.
_NARROW_LEFT, _NARROW_RIGHT, _SHORT = DecimalType(20, 9), DecimalType(17, 9), DecimalType(18, 9)
# Limbs, and sums of them to which another one can be added.
_WHOLE, _FRACTION, _SUM = DecimalType(28, 0), DecimalType(9, 9), DecimalType(37, 9)


def with_product(df: DataFrame, name: str, a: Column, b: Column) -> DataFrame:
    """``df`` with a * b as column ``name``, rounded half away from zero to nine
    fractional digits; NULL from 10**28.

    Projections of their own for the narrow product, the limbs of those rows
    that it doesn't hold, and their sum: each limb is computed once, and every
    step is a generated method small enough to be compiled to machine code.
    """
    narrow, a1, a0, b1, b0 = (f"__{name}_{part}" for part in ("narrow", "a1", "a0", "b1", "b0"))
    a, b = a.cast(NUMERIC), b.cast(NUMERIC)
    columns = [c for c in df.columns if c != name]
    df = df.withColumn(narrow, (a.try_cast(_NARROW_LEFT) * b.try_cast(_NARROW_RIGHT)).cast(NUMERIC))
    wide = F.col(narrow).isNull()
    df = df.withColumns({limb: F.when(wide, value) for c, high, low in ((a, a1, a0), (b, b1, b0)) for limb, value in (
        (high, (c - c % F.lit(1)).try_cast(_WHOLE)), (low, (c % F.lit(1)).cast(_FRACTION)))})
    a1, a0, b1, b0 = (F.col(c) for c in (a1, a0, b1, b0))
    # All limbs have the product's sign, so rounding the last one rounds the sum.
    mixed = ((a1 * b0).try_cast(_SUM) + (a0 * b1).try_cast(_SUM)).try_cast(_SUM)
    upper = (F.try_multiply(a1, b1).try_cast(_WHOLE) + mixed).try_cast(_SUM)
    total = (upper + F.round(a0 * b0, 9).cast(DecimalType(10, 9))).try_cast(_SUM).cast(NUMERIC)
    whole = F.col(f"__{name}_whole")
    df = df.withColumn(f"__{name}_whole", total)
    # Two uses of the sum keep it in a projection of its own.
    return df.select(*columns, F.when(whole.isNotNull(), whole).otherwise(F.col(narrow)).alias(name))


def difference(a: Column, b: Column) -> Column:
    """a - b, exact; NULL where the whole numbers differ by 10**28 or more (the operands may be larger)."""
    a, b = a.cast(NUMERIC), b.cast(NUMERIC)
    short = (a.try_cast(_SHORT) - b.try_cast(_SHORT)).cast(NUMERIC)
    (a1, a0), (b1, b0) = (((c - c % F.lit(1)).cast(DecimalType(29, 0)), (c % F.lit(1)).cast(_FRACTION)) for c in (a, b))
    return F.coalesce(short, ((a1 - b1).try_cast(_WHOLE) + (a0 - b0)).try_cast(NUMERIC))


def quotient(a: Column, b: Column) -> Column:
    """a / b at nine fractional digits, rounded half up; ``b`` is an integer.  NULL on a zero or NULL divisor."""
    divisor = F.nullif(b.cast(DecimalType(20, 0)), F.lit(0))
    return (a.cast(NUMERIC) / divisor).cast(NUMERIC)
