from tidemart.functions.expressions import (  # noqa: F401
    CUSTOMER_TIERS,
    LOOKBACK_DAYS,
    LTV_SEGMENTS,
    ORDER_STATUSES,
    RECENCY_SEGMENTS,
    REVENUE_STATUSES,
    exact_avg,
    initcap_trim,
    is_revenue_status,
    lower_trim,
    ltv_segment,
    money_ratio,
    recency_segment,
    safe_cast,
    surrogate_key,
    total_mismatch_flag,
    ts_literal,
    upper_trim,
)
