"""Cleaned copies of the raw tables: rename, drop rows without their keys, derive light columns. No joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork import fixed_values as fixed
from tillwork import functions as fn


# Columns that must be present for a row to be kept, per raw table.
REQUIRED: dict[str, tuple[str, ...]] = {
    "store_sales": ("ss_item_sk", "ss_ticket_number", "ss_sold_date_sk"),
    "web_sales": ("ws_item_sk", "ws_order_number", "ws_sold_date_sk"),
    "catalog_sales": ("cs_item_sk", "cs_order_number", "cs_sold_date_sk"),
    "store_returns": ("sr_item_sk", "sr_ticket_number"),
    "web_returns": ("wr_item_sk", "wr_order_number"),
    "inventory": ("inv_item_sk", "inv_warehouse_sk"),
    "item": ("i_item_sk",),
    "customer": ("c_customer_sk",),
    "customer_address": ("ca_address_sk",),
    "date_dim": ("d_date_sk",),
    "promotion": ("p_promo_sk",),
    "store": ("s_store_sk",),
    "raw_clickstream": ("event_timestamp", "session_id"),
}


def keep_rule(table: str) -> str:
    """The predicate that staging applies to a raw table. It names plain columns only, so the scan can use it."""
    rules = [f"{column} is not null" for column in REQUIRED[table]]
    if table == "raw_clickstream":
        rules.insert(0, f"event_type in {fixed.EVENT_TYPES}")
    return " and ".join(rules)


def quarantine(table: str, bronze: DataFrame) -> DataFrame:
    """Raw rows that staging leaves out; together with the staged rows they are the whole raw table."""
    return bronze.where(f"not coalesce({keep_rule(table)}, false)")


def _stage(table: str, bronze: DataFrame, names: dict[str, str], **derived: Column) -> DataFrame:
    kept = bronze.where(keep_rule(table))
    if derived:
        kept = kept.withColumns(derived)
    return kept.selectExpr(*[f"{raw} as {clean}" for raw, clean in names.items()], *derived)


def _sales(table: str, bronze: DataFrame, p: str, number: str, customer: str, **place: str) -> DataFrame:
    names = {f"{p}_sold_date_sk": "date_sk", f"{p}_item_sk": "item_id", f"{p}_{customer}": "customer_id"}
    names |= {f"{p}_{raw}": clean for clean, raw in place.items()}
    names |= {
        f"{p}_promo_sk": "promotion_id",
        f"{p}_{number}": "ticket_number",
        f"{p}_quantity": "quantity_sold",
        f"{p}_list_price": "list_price",
        f"{p}_sales_price": "sales_price",
        f"{p}_net_paid": "gross_amount",
        f"{p}_net_paid_inc_tax": "gross_amount_inc_tax",
        f"{p}_net_profit": "net_profit",
    }
    return _stage(table, bronze, names, sale_sk=fn.surrogate_key(f"{p}_{number}", f"{p}_item_sk"))


def stg_store_sales(bronze: DataFrame) -> DataFrame:
    return _sales("store_sales", bronze, "ss", "ticket_number", "customer_sk", store_id="store_sk")


def stg_web_sales(bronze: DataFrame) -> DataFrame:
    return _sales("web_sales", bronze, "ws", "order_number", "bill_customer_sk", ship_address_id="ship_addr_sk")


def stg_catalog_sales(bronze: DataFrame) -> DataFrame:
    return _sales("catalog_sales", bronze, "cs", "order_number", "bill_customer_sk")


def _returns(channel: str, bronze: DataFrame, p: str, number: str, customer: str, reason: str) -> DataFrame:
    names = {
        f"{p}_item_sk": "item_id",
        f"{p}_{number}": "ticket_number",
        f"{p}_returned_date_sk": "return_date_sk",
        f"{p}_{customer}": "customer_id",
        f"{p}_{reason}": "return_reason_id",
        f"{p}_return_quantity": "quantity_returned",
        f"{p}_return_amt": "return_amount",
        f"{p}_net_loss": "net_loss",
    }
    key = fn.surrogate_key(f"{p}_{number}", f"{p}_item_sk")
    return _stage(f"{channel}_returns", bronze, names, return_sk=key, return_channel=fn.channel_label(channel))


def stg_store_returns(bronze: DataFrame) -> DataFrame:
    return _returns("store", bronze, "sr", "ticket_number", "customer_sk", "return_reason_sk")


def stg_web_returns(bronze: DataFrame) -> DataFrame:
    return _returns("web", bronze, "wr", "order_number", "returning_customer_sk", "reason_sk")


def stg_inventory(bronze: DataFrame) -> DataFrame:
    names = {
        "inv_date_sk": "date_sk",
        "inv_item_sk": "item_id",
        "inv_warehouse_sk": "warehouse_id",
        "inv_quantity_on_hand": "quantity_on_hand",
    }
    key = fn.surrogate_key("inv_item_sk", "inv_warehouse_sk", "inv_date_sk")
    return _stage("inventory", bronze, names, inventory_sk=key)


def stg_item(bronze: DataFrame) -> DataFrame:
    names = {
        "i_item_sk": "item_id",
        "i_item_id": "item_code",
        "i_item_desc": "item_description",
        "i_current_price": "current_price",
        "i_category": "category",
        "i_class": "item_class",
        "i_brand": "brand",
        "i_units": "unit_of_measure",
        "i_size": "item_size",
        "i_color": "color",
    }
    return _stage("item", bronze, names, price_tier=fn.price_tier(F.col("i_current_price")))


def stg_customer(bronze: DataFrame) -> DataFrame:
    names = {
        "c_customer_sk": "customer_id",
        "c_customer_id": "customer_code",
        "c_first_name": "first_name",
        "c_last_name": "last_name",
        "c_email_address": "email",
        "c_current_addr_sk": "current_address_id",
        "c_preferred_cust_flag": "is_preferred_customer",
        "c_login": "login_name",
    }
    decade = (F.floor(F.col("c_birth_year") / 10) * 10).cast("bigint")
    return _stage("customer", bronze, names, birth_decade=decade)


def stg_customer_address(bronze: DataFrame) -> DataFrame:
    names = {
        "ca_address_sk": "address_id",
        "ca_address_id": "address_code",
        "ca_city": "city",
        "ca_zip": "zip_code",
        "ca_country": "country",
    }
    state = fn.state_code(F.col("ca_state"))
    region = fn.region_of(state, fixed.CUSTOMER_REGIONS)
    return _stage("customer_address", bronze, names, state_code=state, region=region)


def stg_date_dim(bronze: DataFrame) -> DataFrame:
    names = {
        "d_date_sk": "date_sk",
        "d_date": "calendar_date",
        "d_day_name": "day_name",
        "d_month_seq": "month_seq",
        "d_year": "calendar_year",
        "d_moy": "month_of_year",
        "d_dom": "day_of_month",
        "d_dow": "day_of_week",
        "d_fiscal_year_sk": "fiscal_year_sk",
        "d_fy_year": "fiscal_year",
        "d_fy_quarter_seq": "fiscal_quarter_seq",
        "d_qoy": "fiscal_quarter",
    }
    flags = {"is_holiday": fn.yes_flag(F.col("d_holiday")), "is_weekend": fn.yes_flag(F.col("d_weekend"))}
    return _stage("date_dim", bronze, names, **flags)


def stg_promotion(bronze: DataFrame) -> DataFrame:
    names = {
        "p_promo_sk": "promotion_id",
        "p_promo_id": "promotion_code",
        "p_promo_name": "promotion_name",
        "p_start_date_sk": "start_date_sk",
        "p_end_date_sk": "end_date_sk",
        "p_cost": "promotion_cost",
        "p_response_target": "response_target",
        "p_discount_active": "is_discount_active",
    }
    flags = {medium: F.col(f"p_channel_{medium}") for medium in fixed.PROMOTION_MEDIA}
    return _stage("promotion", bronze, names, channel_type=fn.channel_type(flags))


def stg_store(bronze: DataFrame) -> DataFrame:
    names = {
        "s_store_sk": "store_id",
        "s_store_id": "store_code",
        "s_store_name": "store_name",
        "s_number_employees": "employee_count",
        "s_city": "city",
        "s_country": "country",
        "s_market_id": "market_id",
        "s_market_desc": "market_description",
        "s_geography_class": "geography_class",
    }
    state = fn.state_code(F.col("s_state"))
    return _stage("store", bronze, names, state_code=state, region=fn.region_of(state, fixed.STORE_REGIONS))


def stg_clickstream(bronze: DataFrame) -> DataFrame:
    """Also runs unchanged on a streaming frame."""
    names = {
        "session_id": "session_id",
        "user_id": "customer_id",
        "item_id": "item_id",
        "event_type": "event_type",
        "event_timestamp": "event_timestamp",
        "device_type": "device_type",
        "referrer_source": "referrer_source",
        "_ingested_at": "_ingested_at",
    }
    return _stage("raw_clickstream", bronze, names, event_sk=fn.surrogate_key("session_id", "event_timestamp"))


STAGING: dict[str, Callable[[DataFrame], DataFrame]] = {
    "store_sales": stg_store_sales,
    "web_sales": stg_web_sales,
    "catalog_sales": stg_catalog_sales,
    "store_returns": stg_store_returns,
    "web_returns": stg_web_returns,
    "inventory": stg_inventory,
    "item": stg_item,
    "customer": stg_customer,
    "customer_address": stg_customer_address,
    "date_dim": stg_date_dim,
    "promotion": stg_promotion,
    "store": stg_store,
    "raw_clickstream": stg_clickstream,
}
