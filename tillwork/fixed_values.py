"""Fixed values that all models share. Results only agree if these stay as they are; there is no logic here."""

from dataclasses import dataclass

# --- fixed values: sales channels and the channels that have returns -----------------------------------------
CHANNELS = ("store", "web", "catalog")
RETURN_CHANNELS = ("store", "web")

# --- fixed values: price tiers as (exclusive upper bound, name); anything else, NULL included, is TOP_TIER ----
PRICE_TIERS = ((25, "budget"), (75, "mid"), (200, "premium"))
TOP_TIER = "luxury"

# --- fixed values: state to region. Customers and stores use different maps (stores lack NC, NJ and MI). ------
CUSTOMER_REGIONS = {
    "West": ("CA", "OR", "WA"),
    "South": ("TX", "FL", "GA", "NC"),
    "Northeast": ("NY", "PA", "MA", "NJ"),
    "Midwest": ("IL", "OH", "MI"),
}
STORE_REGIONS = {
    "West": ("CA", "OR", "WA"),
    "South": ("TX", "FL", "GA"),
    "Northeast": ("NY", "PA", "MA"),
    "Midwest": ("IL", "OH"),
}
OTHER_REGION = "Other"

# --- fixed values: promotion media, first match wins ----------------------------------------------------------
PROMOTION_MEDIA = ("email", "tv", "radio", "direct_mail", "event", "demo")
OTHER_MEDIUM = "other"

# --- fixed values: clickstream domains ------------------------------------------------------------------------
EVENT_TYPES = ("page_view", "add_to_cart", "purchase")
DEVICE_TYPES = ("desktop", "mobile", "tablet")
REFERRERS = ("organic", "paid_search", "email", "social", "direct")
NULL_TOKENS = ("null", "NULL", "")

# --- fixed values: text standing for NULL inside a hashed key -------------------------------------------------
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# --- fixed values: spend segments, best first, and stock-out risk levels, worst first ---------------------------
SEGMENTS = ("platinum", "gold", "silver", "bronze")
RISK_LEVELS = ("HIGH", "MEDIUM", "LOW")

# --- fixed values: windows, caps, micro-batch and freshness limits ----------------------------------------------
ROLLING_ROWS = 30
BASELINE_DAYS = 30
STOCKOUT_CAP_DAYS = 999
BATCH_MESSAGES = 100
FLUSH_SECONDS = 30
FRESH_WARN_HOURS = 25
FRESH_ERROR_HOURS = 49


@dataclass(frozen=True)
class Thresholds:
    """Limits the business may change without touching a model."""

    stockout_high_days: int = 7
    stockout_medium_days: int = 14
    ltv_platinum: int = 10000
    ltv_gold: int = 5000
    ltv_silver: int = 1000
