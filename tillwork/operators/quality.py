"""Data-quality checks. A check is a frame of failing rows; an empty frame passes. NULL only fails ``not_null``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork import fixed_values as fixed
from tillwork.operators.staging import keep_rule


class CheckFailed(ValueError):
    """A layer has failing rows."""


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. Counted within each task first, so a hot value costs one row per task."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counted.where(F.col("n_records") > 1)


def dq_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their number of rows."""
    outside = df.where(~F.col(column).isin(*values))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def _outside(column: str, low=None, high=None) -> Column:
    tests = []
    if low is not None:
        tests.append(F.col(column) < low)
    if high is not None:
        tests.append(F.col(column) > high)
    return reduce(lambda a, b: a | b, tests)


def dq_between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.where(_outside(column, low, high))


def dq_freshness(df: DataFrame, column: str, as_of: dt.datetime) -> DataFrame:
    """Age of the newest row in hours, and whether that is a pass, a warning or an error. No rows is an error."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("newest"), now) / 3600
    status = (
        F.when(age <= fixed.FRESH_WARN_HOURS, "pass").when(age <= fixed.FRESH_ERROR_HOURS, "warn").otherwise("error")
    )
    newest = df.agg(F.max(column).alias("newest"))
    return newest.select("newest", age.alias("age_hours"), status.alias("status"))


def dq_net_revenue_not_negative(daily_revenue: DataFrame) -> DataFrame:
    return daily_revenue.where(F.col("net_revenue") < 0).select("sale_date", "channel", "net_revenue")


def dq_all_channels_present(daily_revenue: DataFrame, expected: Iterable[str] = fixed.CHANNELS) -> DataFrame:
    """Expected channels that the mart lacks."""
    spark = daily_revenue.sparkSession
    wanted = spark.createDataFrame([(name,) for name in expected], "expected_channel string")
    present = daily_revenue.select("channel").distinct()
    return wanted.join(present, F.col("expected_channel") == F.col("channel"), "left_anti")


# --- declared checks ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str  # not_null, unique, accepted_values or between
    values: tuple = ()
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}.{self.model}.{self.column}"

    def failing(self) -> Column:
        """Condition for a failing row; not for ``unique``, which needs groups."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(*self.values)
        return _outside(self.column, self.low, self.high)


def _keys(model: str, column: str) -> list[Check]:
    return [Check(model, column, "not_null"), Check(model, column, "unique")]


TIERS = ("budget", "mid", "premium", "luxury")

# --- fixed values: the checks declared for each layer ------------------------------------------------------------------
STAGING_CHECKS: tuple[Check, ...] = (
    *_keys("stg_store_sales", "sale_sk"),
    Check("stg_store_sales", "item_id", "not_null"),
    Check("stg_store_sales", "ticket_number", "not_null"),
    Check("stg_store_sales", "gross_amount", "not_null"),
    Check("stg_store_sales", "gross_amount", "between", low=0, high=500000),
    *_keys("stg_web_sales", "sale_sk"),
    Check("stg_web_sales", "item_id", "not_null"),
    *_keys("stg_catalog_sales", "sale_sk"),
    Check("stg_catalog_sales", "item_id", "not_null"),
    *_keys("stg_store_returns", "return_sk"),
    Check("stg_store_returns", "return_channel", "accepted_values", ("store",)),
    *_keys("stg_web_returns", "return_sk"),
    Check("stg_web_returns", "return_channel", "accepted_values", ("web",)),
    *_keys("stg_inventory", "inventory_sk"),
    Check("stg_inventory", "quantity_on_hand", "between", low=0),
    *_keys("stg_item", "item_id"),
    Check("stg_item", "price_tier", "not_null"),
    Check("stg_item", "price_tier", "accepted_values", TIERS),
    *_keys("stg_customer", "customer_id"),
    *_keys("stg_customer_address", "address_id"),
    *_keys("stg_date_dim", "date_sk"),
    Check("stg_date_dim", "is_holiday", "accepted_values", (True, False)),
    Check("stg_date_dim", "is_weekend", "accepted_values", (True, False)),
    *_keys("stg_promotion", "promotion_id"),
    *_keys("stg_store", "store_id"),
    *_keys("stg_clickstream", "event_sk"),
    Check("stg_clickstream", "event_type", "not_null"),
    Check("stg_clickstream", "event_type", "accepted_values", fixed.EVENT_TYPES),
    Check("stg_clickstream", "device_type", "accepted_values", fixed.DEVICE_TYPES),
)
MART_CHECKS: tuple[Check, ...] = (
    Check("mart_daily_revenue", "sale_date", "not_null"),
    Check("mart_daily_revenue", "channel", "not_null"),
    Check("mart_daily_revenue", "channel", "accepted_values", fixed.CHANNELS),
    Check("mart_daily_revenue", "net_revenue", "not_null"),
    Check("mart_daily_revenue", "net_revenue", "between", low=0),
    Check("mart_daily_revenue", "gross_revenue", "not_null"),
    Check("mart_daily_revenue", "avg_order_value", "between", low=0),
    Check("mart_returns_analysis", "item_id", "not_null"),
    Check("mart_returns_analysis", "return_rate_pct", "between", low=0, high=100),
    Check("mart_returns_analysis", "price_tier", "accepted_values", TIERS),
    Check("mart_inventory_health", "item_id", "not_null"),
    Check("mart_inventory_health", "warehouse_id", "not_null"),
    Check("mart_inventory_health", "stockout_risk_flag", "not_null"),
    Check("mart_inventory_health", "stockout_risk_flag", "accepted_values", fixed.RISK_LEVELS),
    Check("mart_inventory_health", "quantity_on_hand", "between", low=0),
    *_keys("mart_customer_ltv", "customer_id"),
    Check("mart_customer_ltv", "ltv_segment", "not_null"),
    Check("mart_customer_ltv", "ltv_segment", "accepted_values", fixed.SEGMENTS),
    Check("mart_customer_ltv", "total_lifetime_spend", "between", low=0),
    Check("mart_customer_ltv", "preferred_channel", "accepted_values", fixed.CHANNELS),
    *_keys("mart_promotion_effectiveness", "promotion_id"),
    Check("mart_promotion_effectiveness", "promo_net_revenue", "between", low=0),
)


def _counted(df: DataFrame, by_row: list[Check], unique: Check | None) -> DataFrame:
    """One row with a failure count per check, from one pass: row-level counts ride along with the groups of a key."""
    columns = [F.count_if(check.failing()).alias(f"_{i}") for i, check in enumerate(by_row)]
    if unique is None:
        return df.agg(*columns)
    repeated = F.col(unique.column).isNotNull() & (F.col("_rows") > 1)
    groups = df.groupBy(unique.column).agg(F.count("*").alias("_rows"), *columns)
    sums = [F.coalesce(F.sum(f"_{i}"), F.lit(0).cast("bigint")).alias(f"_{i}") for i in range(len(by_row))]
    return groups.agg(F.count_if(repeated).alias("_unique"), *sums)


def run_checks(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Number of failures per check (rows; for ``unique``, repeated values).

    All checks of a model share one pass over it; only a second ``unique`` column would take another.
    """
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)
    parts = []
    for model, declared in by_model.items():
        by_row = [c for c in declared if c.kind != "unique"]
        keys = [c for c in declared if c.kind == "unique"]
        passes = [(by_row, keys[0] if keys else None)] + [([], key) for key in keys[1:]]
        for rows, key in passes:
            counts = [F.struct(F.lit(c.name).alias("check_name"), F.col(f"_{i}").alias("failures"))
                      for i, c in enumerate(rows)]
            if key:
                counts.append(F.struct(F.lit(key.name).alias("check_name"), F.col("_unique").alias("failures")))
            parts.append(_counted(models[model], rows, key).select(F.inline(F.array(*counts))))
    return reduce(DataFrame.unionByName, parts)


def dq_checkpoint(models: Mapping[str, DataFrame], checks: Iterable[Check], layer: str) -> DataFrame:
    """Runs the checks of a layer and raises if any has failures; otherwise gives the report back."""
    report = run_checks(models, checks)
    failed = report.where(F.col("failures") > 0).collect()  # one small row per declared check
    if failed:
        names = ", ".join(sorted(f"{row['check_name']} ({row['failures']})" for row in failed))
        raise CheckFailed(f"{layer} checks failed: {names}")
    return report


def left_out(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per raw table, and how many of them staging leaves out; one pass per table."""
    kept = {table: F.expr(f"coalesce({keep_rule(table)}, false)") for table in bronze}
    return reduce(
        DataFrame.unionByName,
        [
            bronze[table]
            .agg(F.count("*").alias("n_rows"), F.count_if(~rule).alias("n_left_out"))
            .select(F.lit(table).alias("table_name"), "n_rows", "n_left_out")
            for table, rule in kept.items()
        ],
    )
