from tillwork.functions.columns import (  # noqa: F401
    best_channel,
    capped,
    channel_label,
    channel_type,
    exact_round,
    ltv_segment,
    null_tokens_to_null,
    price_tier,
    region_of,
    safe_divide,
    state_code,
    stockout_flag,
    surrogate_key,
    to_cents,
    to_money,
    yes_flag,
)
