from tidemark.functions.exprs import (  # noqa: F401
    CHURN_BANDS,
    DEFAULT_TIERS,
    FIXTURE_TIERS,
    OPEN_EXPIRY,
    TIER_ORDER,
    churn_segment,
    month_of,
    ratio_units_sql,
    round_ratio_decimal,
    round_ratio_half_up,
    to_date_lit,
    tier_of,
    tier_rank,
)
