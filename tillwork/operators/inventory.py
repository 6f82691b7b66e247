"""Stock levels with sales rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork import fixed_values as fixed
from tillwork import functions as fn
from tillwork.operators.lookup import lookup, spread_join

# Order of the snapshots of one item and warehouse; the last two columns only settle ties.
NEWEST_LAST = ("inv_date", "date_sk", "quantity_on_hand")


def item_daily_units(spine: DataFrame) -> DataFrame:
    """Units sold per item and day over all channels; combined within each task before the shuffle."""
    return spine.groupBy("item_id", "sale_date").agg(F.sum("quantity_sold").alias("units_sold_that_day"))


def dated_inventory(inventory: DataFrame, dates: DataFrame) -> DataFrame:
    """Snapshots with a known date."""
    calendar = dates.select(
        F.col("date_sk").alias("_date_sk"), F.col("calendar_date").alias("inv_date"), "calendar_year", "month_of_year"
    )
    return lookup(inventory, calendar, {"date_sk": "_date_sk"}, "inner").drop("_date_sk")


def of_known_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """Keeps rows of known items and describes them.

    Averages and ranks never mix items, so this may come last; descriptions then stay out of the shuffles.
    """
    described = items.select(F.col("item_id").alias("_item_id"), "category", "price_tier", "item_description")
    return lookup(df, described, {"item_id": "_item_id"}, "inner", spread_by=("warehouse_id",)).drop("_item_id")


def with_daily_units(snapshots: DataFrame, units: DataFrame) -> DataFrame:
    """Adds the units that the item sold on the day of the snapshot, in all warehouses together; 0 if none."""
    sold = units.select(
        F.col("item_id").alias("_item_id"),
        F.col("sale_date").alias("_sale_date"),
        F.col("units_sold_that_day").alias("_units"),
    )
    joined = spread_join(snapshots, sold, {"item_id": "_item_id", "inv_date": "_sale_date"}, spread_by=("warehouse_id",))
    return joined.withColumn("units_sold_that_day", F.coalesce("_units", F.lit(0).cast("bigint"))).drop(*sold.columns)


def rolling_average(snapshots: DataFrame) -> DataFrame:
    """Mean units over the last 30 snapshots (rows, not days) of each item and warehouse, and the supply it leaves.

    A window partition is one item in one warehouse with one row per day, so its size is bounded by the calendar and
    not by the volume of data.
    """
    recent = (
        Window.partitionBy("item_id", "warehouse_id").orderBy(*NEWEST_LAST).rowsBetween(1 - fixed.ROLLING_ROWS, 0)
    )
    averaged = snapshots.withColumn("avg_daily_sales_30d", F.avg("units_sold_that_day").over(recent))
    supply = fn.safe_divide(F.col("quantity_on_hand"), F.col("avg_daily_sales_30d"))
    return averaged.withColumn("days_of_supply", supply)


INVENTORY_KEY = ("item_id", "warehouse_id", "date_sk")
INVENTORY_COLUMNS = (
    "inventory_sk",
    "item_id",
    "warehouse_id",
    "quantity_on_hand",
    "inv_date",
    "calendar_year",
    "month_of_year",
    "category",
    "price_tier",
    "item_description",
    "units_sold_that_day",
    "avg_daily_sales_30d",
    "days_of_supply",
)


def inventory_daily(inventory: DataFrame, dates: DataFrame, items: DataFrame, spine: DataFrame) -> DataFrame:
    """All snapshots with sales rates. Their long hashed key follows from other columns and stays out of the shuffles."""
    bare = dated_inventory(inventory.drop("inventory_sk"), dates)
    averaged = rolling_average(with_daily_units(bare, item_daily_units(spine)))
    keyed = averaged.withColumn("inventory_sk", fn.surrogate_key(*INVENTORY_KEY))
    return of_known_items(keyed, items).select(*INVENTORY_COLUMNS)


def latest_snapshots(snapshots: DataFrame, rows: int = 1) -> DataFrame:
    """The newest ``rows`` snapshots of each item and warehouse, ranked 1, 2, ... in ``recency``.

    Spark prunes to ``rows`` per group in every task before the shuffle, so a hot group stays small.
    """
    newest_first = Window.partitionBy("item_id", "warehouse_id").orderBy(*[F.desc(c) for c in NEWEST_LAST])
    return snapshots.withColumn("recency", F.row_number().over(newest_first)).where(F.col("recency") <= rows)


def latest_with_average(snapshots: DataFrame, units: DataFrame) -> DataFrame:
    """Latest snapshot per item and warehouse with its 30-row average, without averaging all the others.

    Equal to the newest row of ``inventory_daily``: only the 30 newest snapshots of each group are kept and looked up.
    """
    recent = with_daily_units(latest_snapshots(snapshots, fixed.ROLLING_ROWS), units)
    newest = F.col("recency") == 1
    kept = ("inv_date", "quantity_on_hand")
    return recent.groupBy("item_id", "warehouse_id").agg(
        *[F.max(F.when(newest, F.col(c))).alias(c) for c in kept],
        F.avg("units_sold_that_day").alias("avg_daily_sales_30d"),
    )
