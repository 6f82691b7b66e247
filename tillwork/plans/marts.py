"""The five business answers. Each takes sales lines (see operators.sales) or snapshots and needs one wide shuffle.

The frames are unsorted, ready for a clustered write; ``present`` puts them in reading order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork import fixed_values as fixed
from tillwork import functions as fn
from tillwork.operators.inventory import latest_with_average, of_known_items
from tillwork.operators.lookup import lookup

# Columns of the sales lines that marts read.
LINE_COLUMNS = (
    "ticket_number",
    "sale_date",
    "channel",
    "state_code",
    "region",
    "customer_id",
    "promotion_id",
    "copies",
    "returned_copies",
    "line_units",
    "gross_cents",
    "refund_cents",
    "net_cents",
)

# Columns that a mart is clustered by when written, followed by a key that splits large equal ranges.
CLUSTERED_BY = {
    "mart_daily_revenue": ("sale_date", "channel", "state_code"),
    "mart_returns_analysis": ("category", "price_tier", "item_id"),
    "mart_inventory_health": ("stockout_risk_flag", "category", "item_id"),
    "mart_customer_ltv": ("ltv_segment", "state_code", "customer_id"),
    "mart_promotion_effectiveness": ("promotion_id",),
}


def present(mart: str, df: DataFrame) -> DataFrame:
    """Reading order of a mart. The trailing keys make it total, so equal values cannot pile up in one range."""
    order = {
        "mart_daily_revenue": [],
        "mart_returns_analysis": [F.desc_nulls_first("return_rate_pct"), "item_id", "was_promoted"],
        "mart_inventory_health": [F.asc_nulls_first("days_of_supply"), "item_id", "warehouse_id"],
        "mart_customer_ltv": [F.desc_nulls_first("total_lifetime_spend"), "customer_id", "state_code"],
        "mart_promotion_effectiveness": [F.desc_nulls_last("revenue_lift_pct"), "promotion_id"],
    }[mart]
    return df.orderBy(*order) if order else df


# --- daily revenue -------------------------------------------------------------------------------------------------

REVENUE_KEYS = ("sale_date", "channel", "state_code", "region")
CALENDAR_COLUMNS = ("calendar_year", "month_of_year", "fiscal_year", "fiscal_quarter", "is_holiday", "is_weekend")


def daily_revenue(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Net revenue by day, channel and place. Returns count on the day of the sale.

    The calendar has one row per day, so its columns are attached to the finished groups instead of being carried
    through the shuffles of the lines.
    """
    sums = lines.groupBy(*REVENUE_KEYS).agg(
        fn.to_money(F.sum("gross_cents")).alias("gross_revenue"),
        fn.to_money(F.sum("refund_cents")).alias("total_return_amount"),
        fn.to_money(F.sum("net_cents")).alias("net_revenue"),
        F.sum("copies").alias("transaction_count"),
        F.sum("line_units").alias("total_units_sold"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.max(F.when(F.col("promotion_id").isNotNull(), 1).otherwise(0)).cast("bigint").alias("promo_transaction_count"),
        F.sum("returned_copies").alias("returned"),
    )
    calendar = dates.select(F.col("calendar_date").alias("_day"), *CALENDAR_COLUMNS)
    return lookup(sums, calendar, {"sale_date": "_day"}, "inner").select(
        *REVENUE_KEYS,
        *CALENDAR_COLUMNS,
        "gross_revenue",
        "total_return_amount",
        "net_revenue",
        "transaction_count",
        "total_units_sold",
        "unique_customers",
        "promo_transaction_count",
        fn.safe_divide(F.col("net_revenue"), F.col("transaction_count")).alias("avg_order_value"),
        fn.safe_divide(F.col("returned"), F.col("transaction_count")).alias("return_rate"),
    )


# --- returns analysis -----------------------------------------------------------------------------------------------


def sales_by_promo_flag(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Units and revenue per item, with and without promotion. Summed first, described afterwards."""
    sums = sales.groupBy("item_id", F.col("promotion_id").isNotNull().alias("was_promoted")).agg(
        F.sum("quantity_sold").alias("units_sold"),
        fn.to_money(F.sum(fn.to_cents(F.col("gross_amount")))).alias("gross_revenue"),
        F.count("*").alias("transaction_count"),
    )
    described = items.select(F.col("item_id").alias("_item_id"), "category", "price_tier", "item_description")
    return lookup(sums, described, {"item_id": "_item_id"}, "inner").drop("_item_id")


def returns_by_promo_flag(returns: DataFrame, sales: DataFrame, items: DataFrame) -> DataFrame:
    """Units and value returned per item, with and without promotion; a return counts once per sale of its key.

    Per (ticket, item) it is enough to know how many sales had a promotion and how many had none.
    """
    sold = sales.select(
        "ticket_number",
        "item_id",
        F.when(F.col("promotion_id").isNotNull(), 1).otherwise(0).cast("bigint").alias("promoted"),
        F.when(F.col("promotion_id").isNull(), 1).otherwise(0).cast("bigint").alias("plain"),
    )
    back = returns.select(
        "ticket_number",
        "item_id",
        F.lit(1).cast("bigint").alias("back"),
        "quantity_returned",
        fn.to_cents(F.col("return_amount")).alias("cents"),
    )
    per_key = (
        sold.unionByName(back, allowMissingColumns=True)
        .groupBy("ticket_number", "item_id")
        .agg(
            F.coalesce(F.sum("promoted"), F.lit(0)).alias("promoted"),
            F.coalesce(F.sum("plain"), F.lit(0)).alias("plain"),
            F.sum("back").alias("back"),
            F.sum("quantity_returned").alias("units"),
            F.sum("cents").alias("cents"),
        )
        .where(F.col("back") > 0)
        # A return without a sale still counts once, as not promoted.
        .withColumn("plain", F.when(F.col("promoted") + F.col("plain") == 0, 1).otherwise(F.col("plain")))
    )
    flags = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(n).alias("n")) for f, n in _FLAGS]))
    times = F.col("times.n").cast("bigint")
    sums = (
        per_key.withColumn("times", flags)
        .where(times > 0)
        .groupBy("item_id", F.col("times.flag").alias("was_promoted"))
        .agg(
            F.sum(F.col("units") * times).alias("units_returned"),
            fn.to_money(F.sum(F.col("cents") * times)).alias("gross_return_value"),
        )
    )
    described = items.select(F.col("item_id").alias("_item_id"), "category", "price_tier")
    return lookup(sums, described, {"item_id": "_item_id"}).drop("_item_id")


_FLAGS = ((True, "promoted"), (False, "plain"))


def returns_analysis(returns: DataFrame, sales: DataFrame, items: DataFrame) -> DataFrame:
    """Return rate per item, with and without promotion."""
    sold = sales_by_promo_flag(sales, items)
    back = returns_by_promo_flag(returns, sales, items).select(
        F.col("item_id").alias("_item_id"),
        F.col("was_promoted").alias("_was_promoted"),
        "units_returned",
        "gross_return_value",
    )
    both = sold.join(
        back, (F.col("item_id") == F.col("_item_id")) & (F.col("was_promoted") == F.col("_was_promoted")), "left"
    )
    units = F.coalesce("units_returned", F.lit(0).cast("bigint"))
    rate = fn.safe_divide(units * F.lit(100), F.col("units_sold"))
    return both.select(
        "item_id",
        "item_description",
        "category",
        "price_tier",
        "was_promoted",
        "units_sold",
        "gross_revenue",
        "transaction_count",
        units.alias("units_returned"),
        F.coalesce("gross_return_value", F.lit(0).cast("decimal(38,2)")).alias("gross_return_value"),
        fn.exact_round(rate, 2).alias("return_rate_pct"),
    )


# --- inventory health -----------------------------------------------------------------------------------------------


def inventory_health(
    snapshots: DataFrame, units: DataFrame, items: DataFrame, limits: fixed.Thresholds
) -> DataFrame:
    """Latest stock per item and warehouse with the risk of running out."""
    latest = of_known_items(latest_with_average(snapshots, units), items)
    supply = fn.safe_divide(F.col("quantity_on_hand"), F.col("avg_daily_sales_30d"))
    known = F.col("days_of_supply")
    return latest.withColumn("days_of_supply", supply).select(
        "item_id",
        "item_description",
        "category",
        "price_tier",
        "warehouse_id",
        F.col("inv_date").alias("snapshot_date"),
        "quantity_on_hand",
        "avg_daily_sales_30d",
        "days_of_supply",
        fn.stockout_flag(known, limits).alias("stockout_risk_flag"),
        fn.capped(fn.exact_round(known, 1), fixed.STOCKOUT_CAP_DAYS).alias("days_until_stockout"),
    )


# --- customer lifetime value ------------------------------------------------------------------------------------------


def _channel_sums() -> list[Column]:
    sums = []
    for name in fixed.CHANNELS:
        here = F.col("channel") == name
        sums.append(F.sum(F.when(here, F.col("net_cents"))).alias(f"spend_{name}"))
        sums.append(F.count(F.when(here, 1)).alias(f"lines_{name}"))
    return sums


def customer_totals(lines: DataFrame, as_of: dt.date, *extra: Column) -> DataFrame:
    """Spend, orders and recency per customer and place; sales without a customer are left out."""
    known = lines.where(F.col("customer_id").isNotNull())
    totals = known.groupBy("customer_id", "state_code", "region").agg(
        fn.to_money(F.sum("net_cents")).alias("total_lifetime_spend"),
        F.countDistinct("ticket_number").alias("order_count"),
        F.sum("copies").alias("transaction_count"),
        F.min("sale_date").alias("first_order_date"),
        F.max("sale_date").alias("last_order_date"),
        *extra,
    )
    return totals.withColumn("days_since_last_order", F.datediff(F.lit(as_of), "last_order_date").cast("bigint"))


def preferred_channel(lines: DataFrame) -> DataFrame:
    """The channel each customer spends most in."""
    known = lines.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(*_channel_sums())
    spend = {name: F.col(f"spend_{name}") for name in fixed.CHANNELS}
    count = {name: F.col(f"lines_{name}") for name in fixed.CHANNELS}
    best = fn.best_channel(spend, count)
    amount = F.coalesce(*[F.when(best == name, spend[name]) for name in fixed.CHANNELS])
    return known.select(
        "customer_id", best.alias("preferred_channel"), fn.to_money(amount).alias("preferred_channel_spend")
    )


def customer_ltv(lines: DataFrame, customers: DataFrame, as_of: dt.date, limits: fixed.Thresholds) -> DataFrame:
    """Lifetime value per customer and place, with the customer's preferred channel over all places.

    The lines are read and shuffled once: channel sums ride along with the totals and are added up per customer over
    the few rows (one per place) that are left of each customer.
    """
    totals = customer_totals(lines, as_of, *_channel_sums())
    everywhere = Window.partitionBy("customer_id")
    spend = {name: F.sum(f"spend_{name}").over(everywhere) for name in fixed.CHANNELS}
    count = {name: F.sum(f"lines_{name}").over(everywhere) for name in fixed.CHANNELS}
    chosen = totals.withColumn("preferred_channel", fn.best_channel(spend, count))
    people = customers.select(F.col("customer_id").alias("_customer_id"), "first_name", "last_name")
    return lookup(chosen, people, {"customer_id": "_customer_id"}).select(
        "customer_id",
        "first_name",
        "last_name",
        "state_code",
        "region",
        "total_lifetime_spend",
        "order_count",
        "transaction_count",
        fn.safe_divide(F.col("total_lifetime_spend"), F.col("order_count")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        "days_since_last_order",
        "preferred_channel",
        fn.ltv_segment(F.col("total_lifetime_spend"), limits).alias("ltv_segment"),
    )


# --- promotion effectiveness ------------------------------------------------------------------------------------------


def promo_windows(promotions: DataFrame, dates: DataFrame) -> DataFrame:
    """Start and end dates of each promotion and the days before it that it is compared with."""

    def calendar(name: str) -> DataFrame:
        return dates.select(F.col("date_sk").alias(f"_{name}_sk"), F.col("calendar_date").alias(f"promo_{name}_date"))

    dated = promotions.where(F.col("start_date_sk").isNotNull() & F.col("end_date_sk").isNotNull())
    dated = lookup(dated, calendar("start"), {"start_date_sk": "_start_sk"})
    dated = lookup(dated, calendar("end"), {"end_date_sk": "_end_sk"})
    first, last = F.col("promo_start_date"), F.col("promo_end_date")
    return dated.select(
        "promotion_id",
        "promotion_code",
        "promotion_name",
        "channel_type",
        "is_discount_active",
        "promo_start_date",
        "promo_end_date",
        F.datediff(last, first).cast("bigint").alias("promo_duration_days"),
        F.date_sub(first, fixed.BASELINE_DAYS).alias("baseline_start_date"),
        F.date_sub(first, 1).alias("baseline_end_date"),
    )


def _measures() -> list[Column]:
    return [
        F.sum("copies").alias("transactions"),
        F.sum("gross_cents").alias("gross"),
        F.sum("net_cents").alias("net"),
        F.sum("refund_cents").alias("refunds"),
        F.sum("returned_copies").alias("returned"),
    ]


_SUMMED = ("transactions", "gross", "net", "refunds", "returned", "customers")


def _with_window(lines: DataFrame, windows: DataFrame) -> DataFrame:
    """Adds to each promoted line the window of its promotion (NULL if that has none)."""
    own = windows.select(
        F.col("promotion_id").alias("_promotion_id"),
        F.col("promo_start_date").alias("_from"),
        F.col("promo_end_date").alias("_to"),
    )
    return lookup(lines, own, {"promotion_id": "_promotion_id"})


def _grouped_lines(lines: DataFrame, windows: DataFrame) -> DataFrame:
    """Sums per promotion (inside its window) and, for sales without promotion, per day; read in one pass."""
    plain = F.col("promotion_id").isNull()
    inside = F.col("sale_date").between(F.col("_from"), F.col("_to"))
    return (
        _with_window(lines, windows)
        .where(plain | inside)
        .groupBy("promotion_id", F.when(plain, F.col("sale_date")).alias("day"))
        .agg(*_measures(), F.countDistinct(F.when(~plain, F.col("customer_id"))).alias("customers"))
    )


def _per_promotion(grouped: DataFrame, windows: DataFrame) -> DataFrame:
    """Hands each day of sales without promotion to the promotions that are compared with it, then adds up.

    The range join becomes an equi-join on the day: a promotion is listed under each of its 30 baseline days, and the
    sales are already summed per day, so both sides have at most one row per day of the calendar (and promotion).
    """
    listed = windows.select(
        F.col("promotion_id").alias("_target"),
        F.explode(F.sequence("baseline_start_date", "baseline_end_date")).alias("_day"),
    )
    compared = grouped.join(listed, F.col("day") == F.col("_day"), "left")
    target = F.coalesce("promotion_id", "_target")
    own = F.col("promotion_id").isNotNull()
    return (
        compared.where(target.isNotNull())
        .groupBy(target.alias("_promotion_id"))
        .agg(
            *[F.sum(F.when(own, F.col(c))).alias(f"promo_{c}") for c in _SUMMED],
            *[F.sum(F.when(~own, F.col(c))).alias(f"baseline_{c}") for c in _SUMMED[:-1]],
        )
    )


def promo_period_sales(lines: DataFrame, windows: DataFrame) -> DataFrame:
    """Sales with a promotion inside its window."""
    promoted = lines.where(F.col("promotion_id").isNotNull())
    inside = F.col("sale_date").between(F.col("_from"), F.col("_to"))
    sums = (
        _with_window(promoted, windows)
        .where(inside)
        .groupBy("promotion_id")
        .agg(*_measures(), F.countDistinct("customer_id").alias("customers"))
    )
    return sums.select(
        "promotion_id",
        F.col("transactions").alias("promo_transaction_count"),
        fn.to_money(F.col("gross")).alias("promo_gross_revenue"),
        fn.to_money(F.col("net")).alias("promo_net_revenue"),
        fn.to_money(F.col("refunds")).alias("promo_return_amount"),
        fn.safe_divide(F.col("returned"), F.col("transactions")).alias("promo_return_rate"),
        F.col("customers").alias("promo_unique_customers"),
    )


def baseline_sales(lines: DataFrame, windows: DataFrame) -> DataFrame:
    """Sales without promotion in the 30 days before each promotion: summed per day first, then per promotion."""
    daily = (
        lines.where(F.col("promotion_id").isNull())
        .groupBy("promotion_id", F.col("sale_date").alias("day"))
        .agg(*_measures(), F.lit(0).cast("bigint").alias("customers"))
    )
    sums = _per_promotion(daily, windows)
    return sums.select(
        F.col("_promotion_id").alias("promotion_id"),
        F.col("baseline_transactions").alias("baseline_transaction_count"),
        fn.to_money(F.col("baseline_gross")).alias("baseline_gross_revenue"),
        fn.to_money(F.col("baseline_net")).alias("baseline_net_revenue"),
        fn.safe_divide(F.col("baseline_returned"), F.col("baseline_transactions")).alias("baseline_return_rate"),
    )


def promotion_effectiveness(lines: DataFrame, promotions: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue and returns of each promotion against sales without promotion in the 30 days before it."""
    windows = promo_windows(promotions, dates)
    sums = _per_promotion(_grouped_lines(lines, windows), windows)
    both = lookup(windows, sums, {"promotion_id": "_promotion_id"}, limit=0)

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint"))

    def money(name: str) -> Column:
        return fn.to_money(F.coalesce(name, F.lit(0).cast("bigint")))

    def rate(period: str) -> Column:
        share = fn.safe_divide(F.col(f"{period}_returned"), F.col(f"{period}_transactions"))
        return F.coalesce(share, F.lit(0.0))

    lift = fn.safe_divide((money("promo_net") - money("baseline_net")) * 100, money("baseline_net"))
    return both.select(
        "promotion_id",
        "promotion_code",
        "promotion_name",
        "channel_type",
        "promo_start_date",
        "promo_end_date",
        "promo_duration_days",
        count("promo_transactions").alias("promo_transaction_count"),
        money("promo_gross").alias("promo_gross_revenue"),
        money("promo_net").alias("promo_net_revenue"),
        rate("promo").alias("promo_return_rate"),
        count("promo_customers").alias("promo_unique_customers"),
        count("baseline_transactions").alias("baseline_transaction_count"),
        money("baseline_net").alias("baseline_net_revenue"),
        rate("baseline").alias("baseline_return_rate"),
        fn.exact_round(lift, 2).alias("revenue_lift_pct"),
        fn.exact_round(rate("promo") - rate("baseline"), 4).alias("return_rate_delta"),
    )
