"""Sales of all channels in one frame, returns next to them, and net sales.

Net sales join returns to sales on (ticket, item). Ticket numbers of different channels collide, and returns are
themselves joined to sales first (to learn about promotions), so k sales and r returns of one key become k * k * r
rows. ``net_sales`` gives exactly those rows. The marts only need sums over them, so they use ``sales_lines``: one row
per sale with the number of copies and the sums over its returns, which grows with the input and not with its square.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork import fixed_values as fixed
from tillwork import functions as fn
from tillwork.operators.lookup import Hot, fanout_left_join, lookup, spread_join

SALE_KEY = ("ticket_number", "item_id")

SALES_COLUMNS = (
    "sale_sk",
    "date_sk",
    "item_id",
    "customer_id",
    "store_id",
    "promotion_id",
    "ticket_number",
    "quantity_sold",
    "list_price",
    "sales_price",
    "gross_amount",
    "gross_amount_inc_tax",
    "net_profit",
    "channel",
)

RETURN_COLUMNS = (
    "return_sk",
    "item_id",
    "ticket_number",
    "return_date_sk",
    "customer_id",
    "return_reason_id",
    "quantity_returned",
    "return_amount",
    "net_loss",
    "return_channel",
)

# What sales are joined to by ticket and item: single returns, or totals of them.
RETURNED = ("return_amount", "quantity_returned")
TOTALS = ("matches", "returned", "refund")

UNIFIED_COLUMNS = (
    "sale_sk",
    "channel",
    "ticket_number",
    "quantity_sold",
    "gross_amount",
    "gross_amount_inc_tax",
    "net_profit",
    "promotion_id",
    "sale_date",
    "calendar_year",
    "month_of_year",
    "fiscal_year",
    "fiscal_quarter",
    "is_holiday",
    "is_weekend",
    "item_id",
    "item_description",
    "category",
    "item_class",
    "brand",
    "current_price",
    "price_tier",
    "customer_id",
    "first_name",
    "last_name",
    "state_code",
    "region",
)


def sales_union(store: DataFrame, web: DataFrame, catalog: DataFrame) -> DataFrame:
    """All sales, tagged with their channel; duplicates stay. Only store sales know a store."""
    tagged = []
    for name, sales in zip(fixed.CHANNELS, (store, web, catalog)):
        if "store_id" not in sales.columns:
            sales = sales.withColumn("store_id", F.lit(None).cast("bigint"))
        tagged.append(sales.withColumn("channel", fn.channel_label(name)).select(*SALES_COLUMNS))
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def returns_union(store: DataFrame, web: DataFrame) -> DataFrame:
    return store.select(*RETURN_COLUMNS).unionByName(web.select(*RETURN_COLUMNS))


def _calendar(dates: DataFrame) -> DataFrame:
    return dates.select(
        F.col("date_sk").alias("_date_sk"),
        F.col("calendar_date").alias("sale_date"),
        "calendar_year",
        "month_of_year",
        "fiscal_year",
        "fiscal_quarter",
        "is_holiday",
        "is_weekend",
    )


def _prefixed(df: DataFrame, key: str, *others: str) -> DataFrame:
    return df.select(F.col(key).alias(f"_{key}"), *others)


def sales_spine(sales: DataFrame, dates: DataFrame, items: DataFrame) -> DataFrame:
    """Sales that have a known date and a known item: the rows of unified sales, without customer and place."""
    dated = lookup(sales, _calendar(dates), {"date_sk": "_date_sk"}, "inner").drop("_date_sk")
    described = _prefixed(
        items, "item_id", "item_description", "category", "item_class", "brand", "current_price", "price_tier"
    )
    return lookup(dated, described, {"item_id": "_item_id"}, "inner").drop("_item_id")


def customer_places(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customers with their address attached, so that facts are shuffled for them once and not twice."""
    places = addresses.select(
        F.col("address_id").alias("_address_id"),
        F.col("state_code").alias("home_state"),
        F.col("region").alias("home_region"),
    )
    people = customers.select(
        F.col("customer_id").alias("known_customer_id"), "first_name", "last_name", "current_address_id"
    )
    return lookup(people, places, {"current_address_id": "_address_id"}).drop("current_address_id", "_address_id")


def unified_sales(
    sales: DataFrame,
    dates: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    addresses: DataFrame,
    stores: DataFrame,
    hot_customers: Hot = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Sales with date, item, customer and place; ``extra`` columns of the sales stay.

    The customer id is the dimension's, so a sale of an unknown customer has none. State and region are taken from the
    store if it has them and from the customer otherwise, each on its own.
    """
    spine = sales_spine(sales, dates, items)
    branches = stores.select(
        F.col("store_id").alias("_store_id"),
        F.col("state_code").alias("store_state"),
        F.col("region").alias("store_region"),
    )
    bought = lookup(
        spine,
        customer_places(customers, addresses),
        {"customer_id": "known_customer_id"},
        spread_by=SALE_KEY,
        hot=hot_customers,
    )
    placed = lookup(bought, branches, {"store_id": "_store_id"})  # afterwards: its names stay out of the shuffle for customers
    return (
        placed.withColumn("customer_id", F.col("known_customer_id"))
        .withColumn("state_code", F.coalesce("store_state", "home_state"))
        .withColumn("region", F.coalesce("store_region", "home_region"))
        .select(*UNIFIED_COLUMNS, *extra)
    )


def unified_returns(
    returns: DataFrame, dates: DataFrame, items: DataFrame, spine: DataFrame, hot_sales: Hot = None
) -> DataFrame:
    """Returns with date, item and whether a sale of the same (ticket, item) was promoted.

    A return that matches k sales gives k rows, as many as the sales have.
    """
    dated = lookup(
        returns,
        dates.select(
            F.col("date_sk").alias("_date_sk"),
            F.col("calendar_date").alias("return_date"),
            F.col("calendar_year").alias("return_year"),
            F.col("month_of_year").alias("return_month"),
        ),
        {"return_date_sk": "_date_sk"},
    )
    described = lookup(dated, _prefixed(items, "item_id", "category", "price_tier"), {"item_id": "_item_id"})
    sold = spine.select(
        F.col("ticket_number").alias("_ticket"),
        F.col("item_id").alias("_sold_item"),
        "promotion_id",
        F.xxhash64("sale_date", "customer_id", "quantity_sold").alias("_sold_row"),
    )
    matched = fanout_left_join(
        described,
        sold,
        {"ticket_number": "_ticket", "item_id": "_sold_item"},
        spread_left=("customer_id", "return_date", "quantity_returned"),
        spread_right=("_sold_row",),
        show=("promotion_id",),
        hot=hot_sales,
    )
    return matched.select(
        "return_sk",
        "return_channel",
        "ticket_number",
        "item_id",
        "customer_id",
        "quantity_returned",
        "return_amount",
        "net_loss",
        "return_date",
        "return_year",
        "return_month",
        "category",
        "price_tier",
        F.col("promotion_id").isNotNull().alias("was_promoted"),
    )


def without_key(sales: DataFrame) -> DataFrame:
    """Sales as they are shuffled: their long hashed key follows from two other columns, see ``with_key``."""
    return sales.drop("sale_sk")


def with_key(sales: DataFrame) -> DataFrame:
    return sales.withColumn("sale_sk", fn.surrogate_key(*SALE_KEY))


def with_returns(
    sold: DataFrame,
    returns: DataFrame,
    match_channel: bool = False,
    hot_sales: Hot = None,
    spread_by: Sequence[str] = ("customer_id", "date_sk", "gross_amount"),
) -> DataFrame:
    """Sales, described or not, with ``return_amount`` and ``quantity_returned`` of each matching unified return."""
    back = returns.select(
        F.col("ticket_number").alias("_ticket"),
        F.col("item_id").alias("_item"),
        F.col("return_channel"),
        "return_amount",
        "quantity_returned",
    )
    on = {"ticket_number": "_ticket", "item_id": "_item"}
    if match_channel:
        on["channel"] = "return_channel"
    joined = fanout_left_join(
        sold,
        back,
        on,
        spread_left=spread_by,
        spread_right=("return_amount", "quantity_returned"),
        show=RETURNED,
        hot=hot_sales,
        hot_on=SALE_KEY,
    )
    return joined.select(*sold.columns, *RETURNED)


def net_columns(unified: DataFrame) -> DataFrame:
    """Columns of net sales from unified sales that have their returns (``with_returns``)."""
    dropped = {"gross_amount_inc_tax", "net_profit"}
    return unified.select(
        *[c for c in UNIFIED_COLUMNS if c not in dropped],
        *RETURNED,
        (F.col("gross_amount") - F.coalesce("return_amount", F.lit(0))).alias("net_amount"),
        F.col("return_amount").isNotNull().alias("was_returned"),
    )


def net_sales(unified: DataFrame, returns: DataFrame, match_channel: bool = False, hot_sales: Hot = None) -> DataFrame:
    """Sales with each matching return; ``returns`` are unified returns.

    By default returns match on (ticket, item) alone, so a return of one channel can reach a sale of another. With
    ``match_channel`` the channel must agree too.
    """
    spread_by = ("customer_id", "sale_date", "gross_amount")
    return net_columns(with_returns(unified, returns, match_channel, hot_sales, spread_by))


def return_totals(spine: DataFrame, returns: DataFrame, match_channel: bool = False) -> DataFrame:
    """Per (ticket, item) with returns: how many rows net sales has for each sale, and the sums over them.

    One aggregation over the union of both sides: each task first combines its own rows, so a hot key costs one row
    per task, and no pairs are formed. Every return appears once for each of the ``sold`` sales of its key.
    """
    by_channel = ["return_channel"] if match_channel else []
    sold = spine.select(
        *SALE_KEY, *[F.lit(None).cast("string").alias(c) for c in by_channel], F.lit(1).cast("bigint").alias("sold")
    )
    back = returns.select(
        *SALE_KEY,
        *by_channel,
        F.lit(1).cast("bigint").alias("back"),
        fn.to_cents(F.col("return_amount")).alias("cents"),
    )
    both = sold.unionByName(back, allowMissingColumns=True)
    if not match_channel:
        per_key = both.groupBy(*SALE_KEY).agg(
            F.sum("sold").alias("sold"),
            F.sum("back").alias("back"),
            F.sum("cents").alias("cents"),
            F.count("cents").alias("amounts"),
        )
        return _copies(per_key)
    hit = {name: F.col("return_channel") == name for name in fixed.RETURN_CHANNELS}
    wide = both.groupBy(*SALE_KEY).agg(
        F.sum("sold").alias("sold"),
        *[F.sum(F.when(h, F.col("back"))).alias(f"back_{n}") for n, h in hit.items()],
        *[F.sum(F.when(h, F.col("cents"))).alias(f"cents_{n}") for n, h in hit.items()],
        *[F.count(F.when(h, F.col("cents"))).alias(f"amounts_{n}") for n, h in hit.items()],
    )
    per_channel = F.array(
        *[
            F.struct(
                F.lit(n).alias("return_channel"),
                F.col(f"back_{n}").alias("back"),
                F.col(f"cents_{n}").alias("cents"),
                F.col(f"amounts_{n}").alias("amounts"),
            )
            for n in hit
        ]
    )
    return _copies(wide.select(*SALE_KEY, "sold", F.inline(per_channel)), "return_channel")


def _copies(per_key: DataFrame, *extra: str) -> DataFrame:
    return per_key.where((F.col("back") > 0) & (F.col("sold") > 0)).select(
        *[F.col(c).alias(f"_{c}") for c in (*SALE_KEY, *extra)],
        (F.col("sold") * F.col("back")).alias("matches"),
        (F.col("sold") * F.col("amounts")).alias("returned"),
        (F.col("sold") * F.col("cents")).alias("refund"),
    )


def with_totals(
    sold: DataFrame,
    totals: DataFrame,
    match_channel: bool = False,
    hot_sales: Hot = None,
    spread_by: Sequence[str] = ("customer_id", "date_sk", "gross_amount"),
) -> DataFrame:
    """Sales, described or not, with the ``return_totals`` of their key; null where there are none."""
    on = {"ticket_number": "_ticket_number", "item_id": "_item_id"}
    if match_channel:
        on["channel"] = "_return_channel"
    joined = spread_join(sold, totals, on, spread_by=spread_by, hot=hot_sales, hot_on=SALE_KEY)
    return joined.select(*sold.columns, *TOTALS)


def weights(unified: DataFrame) -> DataFrame:
    """Sales lines from unified sales that have their totals (``with_totals``)."""
    copies = F.coalesce("matches", F.lit(1).cast("bigint"))
    gross = fn.to_cents(F.col("gross_amount")) * copies
    refund = F.coalesce("refund", F.lit(0).cast("bigint"))
    return unified.select(
        *UNIFIED_COLUMNS,
        copies.alias("copies"),
        F.coalesce("returned", F.lit(0).cast("bigint")).alias("returned_copies"),
        (F.col("quantity_sold") * copies).alias("line_units"),
        gross.alias("gross_cents"),
        refund.alias("refund_cents"),
        (gross - refund).alias("net_cents"),
    )


def sales_lines(unified: DataFrame, totals: DataFrame, match_channel: bool = False, hot_sales: Hot = None) -> DataFrame:
    """One row per sale with weights that stand for its net-sales rows.

    ``copies`` rows of net sales come from the line and ``returned_copies`` of them count as returned. The sums over
    them are ``line_units`` and, in whole cents, ``gross_cents``, ``refund_cents`` (0 if none) and ``net_cents``.
    """
    spread_by = ("customer_id", "sale_date", "gross_amount")
    return weights(with_totals(unified, totals, match_channel, hot_sales, spread_by))
