"""Reusable column expressions. Every one stays inside whole-stage codegen; there are no UDFs in this package."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork import fixed_values as fixed


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the '-'-joined text of the parts; NULL has its own text, so NULL and '' give different keys."""
    as_text = [
        F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(fixed.NULL_KEY_PART)) for p in parts
    ]
    return F.md5(F.concat_ws("-", *as_text))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; NULL, not an error, when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_round(value: Column, places: int) -> Column:
    """Half-up rounding on a decimal, so that binary noise in the last bit cannot flip a digit."""
    return F.round(value.cast("decimal(38,12)"), places).cast("double")


def capped(value: Column, limit: int) -> Column:
    """Smaller of value and limit. Spark's least() skips NULL; here NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(value, F.lit(limit).cast("double")))


def to_cents(amount: Column) -> Column:
    """Money as whole cents. Sums of integers run in generated code; sums of wide decimals go through objects.

    A sum holds up to 9.2e16 currency units per group; beyond that, ANSI mode raises instead of wrapping round.
    """
    return (amount.cast("decimal(16,2)") * F.lit(100)).cast("bigint")


def to_money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def price_tier(price: Column) -> Column:
    tiers = reduce(
        lambda chain, tier: chain.when(price < tier[0], tier[1]),
        fixed.PRICE_TIERS[1:],
        F.when(price < fixed.PRICE_TIERS[0][0], fixed.PRICE_TIERS[0][1]),
    )
    return tiers.otherwise(fixed.TOP_TIER)


def state_code(raw: Column) -> Column:
    return F.upper(F.trim(raw))


def region_of(state: Column, regions: dict[str, tuple[str, ...]]) -> Column:
    """Region of a normalised state code; unknown and NULL states are 'Other'."""
    known = [F.when(state.isin(*states), name) for name, states in regions.items()]
    return F.coalesce(*known, F.lit(fixed.OTHER_REGION))


def yes_flag(raw: Column) -> Column:
    """'Y'/'N' text to boolean; NULL stays NULL."""
    return raw == F.lit("Y")


def channel_type(flags: dict[str, Column]) -> Column:
    """The first medium, in the order of PROMOTION_MEDIA, whose flag is 'Y'."""
    hits = [F.when(yes_flag(flags[medium]), medium) for medium in fixed.PROMOTION_MEDIA]
    return F.coalesce(*hits, F.lit(fixed.OTHER_MEDIUM))


def channel_label(name: str) -> Column:
    """Literal channel tag; an unknown name fails while the plan is built, not while it runs."""
    if name not in fixed.CHANNELS:
        raise ValueError(f"Unknown channel: {name}")
    return F.lit(name)


def ltv_segment(spend: Column, limits: fixed.Thresholds) -> Column:
    floors = (limits.ltv_platinum, limits.ltv_gold, limits.ltv_silver)
    named = [F.when(spend >= floor, name) for floor, name in zip(floors, fixed.SEGMENTS)]
    return F.coalesce(*named, F.lit(fixed.SEGMENTS[-1]))


def stockout_flag(days_of_supply: Column, limits: fixed.Thresholds) -> Column:
    """No known supply counts as the highest risk."""
    high, medium, low = fixed.RISK_LEVELS
    return (
        F.when(days_of_supply.isNull() | (days_of_supply < limits.stockout_high_days), high)
        .when(days_of_supply < limits.stockout_medium_days, medium)
        .otherwise(low)
    )


def null_tokens_to_null(raw: Column) -> Column:
    return F.when(~raw.isin(*fixed.NULL_TOKENS), raw)


def best_channel(spend: dict[str, Column], lines: dict[str, Column]) -> Column:
    """Channel with the highest spend, from one spend and one line-count column per channel.

    A channel without lines does not compete. An unknown (NULL) spend ranks above any amount, and equal amounts go
    to the channel that comes first alphabetically, so the answer does not depend on row order.
    """
    last_to_first = sorted(spend, reverse=True)
    candidates = [
        F.when(
            lines[name] > 0,
            F.struct(
                spend[name].isNull().alias("unknown"),
                spend[name].alias("spend"),
                F.lit(last_to_first.index(name)).alias("priority"),
                F.lit(name).alias("channel"),
            ),
        )
        for name in spend
    ]
    return F.greatest(*candidates)["channel"]
