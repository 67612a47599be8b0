"""Column expressions shared by the models.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; there is no Python UDF in the package.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    TimestampNTZType,
)

from tidemart.functions.numeric import NUMERIC, quotient

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Order statuses that count as revenue.
REVENUE_STATUSES = ("paid", "shipped", "delivered")
# Accepted order statuses.
ORDER_STATUSES = ("placed", "paid", "shipped", "delivered", "cancelled")
# Accepted customer tiers.
CUSTOMER_TIERS = ("bronze", "silver", "gold", "platinum")
# Recency segments: <=30 active, <=90 recent, <=365 dormant, else churned;
# no order at all is never_ordered.
RECENCY_SEGMENTS = ("never_ordered", "active", "recent", "dormant", "churned")
RECENCY_BOUNDS = ((30, "active"), (90, "recent"), (365, "dormant"))
# Lifetime-value segments: >=5000 whale, >=1000 high_value, >=100 mid_value,
# >0 low_value, else non_buyer.
LTV_SEGMENTS = ("whale", "high_value", "mid_value", "low_value", "non_buyer")
LTV_BOUNDS = ((5000, "whale"), (1000, "high_value"), (100, "mid_value"))
# Relative tolerance of the order-total mismatch flag: one part in a hundred.
MISMATCH_PARTS = 100
# Null marker and separator of the surrogate key.
SURROGATE_NULL = "∅"
SURROGATE_SEPARATOR = "||"
# Lookback window of the incremental facts, in days.
LOOKBACK_DAYS = 3

# ---------------------------------------------------------------------------
# Types.  All money, prices and fractions are NUMERIC, decimal(38,9); products
# and differences of them are made in tidemart.functions.numeric.
# ---------------------------------------------------------------------------
TYPES: dict[str, DataType] = {
    "INT64": LongType(),
    "NUMERIC": NUMERIC,
    "STRING": StringType(),
    "BOOL": BooleanType(),
    "TIMESTAMP": TimestampNTZType(),
    "DATE": DateType(),
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, type_name: str | DataType) -> Column:
    """Cast that yields NULL instead of failing (ANSI mode stays on)."""
    target = TYPES[type_name] if isinstance(type_name, str) else type_name
    if target == BooleanType():  # only the two words, in any case
        word = F.lower(_col(c).cast("string"))
        return F.when(word == "true", True).when(word == "false", False)
    if target == TimestampNTZType():
        return _utc_wall_clock(_col(c))
    return _col(c).try_cast(target)


# Text that ends in a time with a zone or an offset.
_ZONED = r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*([Zz]|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)$"


def _utc_wall_clock(c: Column) -> Column:
    """Text, date or timestamp as UTC wall clock: an offset in the text and a
    zoned TIMESTAMP are converted, anything else is UTC already.  The session
    zone plays no part, and the type test folds away at planning, so filters
    on a TIMESTAMP_NTZ column still reach the scan."""
    zoned = (F.typeof(c) == "timestamp") | ((F.typeof(c) == "string") & F.trim(c.cast("string")).rlike(_ZONED))
    since_epoch = F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(c.try_cast("timestamp"))
    return F.when(zoned, ts_literal("1970-01-01 00:00:00") + since_epoch).otherwise(c.try_cast(TimestampNTZType()))


def surrogate_key(fields: Iterable[Column | str]) -> Column:
    """Lower-case hex SHA-256 of the fields as text, NULL as the null marker,
    joined by the separator."""
    parts: list[Column] = []
    for i, f in enumerate(fields):
        if i:
            parts.append(F.lit(SURROGATE_SEPARATOR))
        parts.append(F.coalesce(_col(f).cast("string"), F.lit(SURROGATE_NULL)))
    return F.sha2(F.concat(*parts), 256)


def trim_all(c: Column | str) -> Column:
    """Leading and trailing white space of any kind removed."""
    return F.trim(_col(c), F.lit(" \t\n\r\x0b\x0c"))


def lower_trim(c: Column | str) -> Column:
    return F.lower(trim_all(c))


def upper_trim(c: Column | str) -> Column:
    return F.upper(trim_all(c))


def initcap_trim(c: Column | str) -> Column:
    """First letter of every word in upper case, the rest in lower case; words
    end at white space and punctuation (not at an apostrophe)."""
    parts = F.split(trim_all(c), r"(?<=[\s\[\](){}/|<>!?@\"^#$&~_,.:;*%+\-])")
    return F.array_join(F.transform(parts, lambda w: F.concat(
        F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))), "")


def ts_literal(value: str) -> Column:
    """UTC wall-clock timestamp literal, e.g. ``'2001-08-02 00:00:00'``."""
    return F.lit(value).cast(TimestampNTZType())


def value_literal(value) -> Column:
    """Literal for a value collected from a DataFrame.  A ``datetime`` from
    a TIMESTAMP_NTZ column becomes an NTZ literal again (``F.lit`` of a
    naive datetime would yield a session-zone TIMESTAMP)."""
    import datetime as _dt

    if isinstance(value, _dt.datetime):
        return ts_literal(value.isoformat(sep=" "))
    return F.lit(value)


def is_revenue_status(status: Column | str) -> Column:
    return _col(status).isin(*REVENUE_STATUSES)


def total_mismatch_flag(total: Column | str, items_net: Column | str) -> Column:
    """|total - net| / total > 1 %, FALSE when net is NULL or total is not
    positive (a zero total gives a NULL ratio, a negative one a negative
    ratio).  Exact below 10**24, where a hundred times the difference fits
    a decimal; above, the eighth fractional digit is rounded."""
    total, items_net = _col(total).cast(NUMERIC), _col(items_net).cast(NUMERIC)
    short = DecimalType(33, 9)
    apart = F.abs(total.try_cast(short) - items_net.try_cast(short)) * F.lit(MISMATCH_PARTS).cast(DecimalType(3, 0))
    wide = F.abs(total - items_net) > total / F.lit(MISMATCH_PARTS)
    hit = items_net.isNotNull() & (total > 0) & F.coalesce(apart > total, wide)
    return F.when(hit, F.lit(True)).otherwise(F.lit(False))


def recency_segment(days_since_last: Column | str) -> Column:
    d = _col(days_since_last)
    expr = F.when(d.isNull(), F.lit("never_ordered"))
    for bound, label in RECENCY_BOUNDS:
        expr = expr.when(d <= bound, F.lit(label))
    return expr.otherwise(F.lit("churned"))


def ltv_segment(lifetime_revenue: Column | str) -> Column:
    r = _col(lifetime_revenue)
    expr = None
    for bound, label in LTV_BOUNDS:
        cond = r >= bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(r > 0, F.lit("low_value")).otherwise(F.lit("non_buyer"))


def money_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Decimal quotient at NUMERIC's nine fractional digits, rounded half up;
    NULL on a zero or NULL denominator (SAFE_DIVIDE)."""
    return quotient(_col(numerator), _col(denominator))


def exact_avg(c: Column | str) -> Column:
    """AVG of a decimal column as the quotient of its sum and count."""
    c = _col(c)
    return money_ratio(F.sum(c), F.count(c))
