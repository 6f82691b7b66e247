"""All models over one set of raw tables, built lazily: nothing runs until a frame is written or collected."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from tillwork.fixed_values import Thresholds
from tillwork.operators import history, inventory, sales
from tillwork.operators.staging import STAGING
from tillwork.plans import marts

MART_NAMES = tuple(marts.CLUSTERED_BY)


class Warehouse:
    """Staged tables, intermediate models and marts of one set of raw tables.

    ``lines`` replaces the computed sales lines by a stored copy of ``mart_lines``, which several marts can then share.
    """

    def __init__(
        self,
        bronze: Mapping[str, DataFrame],
        *,
        as_of: dt.date,
        limits: Thresholds | None = None,
        match_channel: bool = False,
        lines: DataFrame | None = None,
    ):
        self.bronze, self.as_of, self.match_channel = bronze, as_of, match_channel
        self.limits = limits or Thresholds()
        self._staged: dict[str, DataFrame] = {}
        self._lines = lines

    def staged(self, table: str) -> DataFrame:
        """Staged frame of a raw table."""
        if table not in self._staged:
            self._staged[table] = STAGING[table](self.bronze[table])
        return self._staged[table]

    def hot_keys(self, name: str) -> DataFrame | None:
        """Hot keys by the summaries stored with the raw tables; no job runs for them. None where there are none."""
        stored = getattr(self.bronze, "hot_keys", None)
        return stored(name) if stored else None

    # --- intermediate models -------------------------------------------------------------------------------------

    @cached_property
    def sales_union(self) -> DataFrame:
        return sales.sales_union(*[self.staged(t) for t in ("store_sales", "web_sales", "catalog_sales")])

    @cached_property
    def returns_union(self) -> DataFrame:
        return sales.returns_union(self.staged("store_returns"), self.staged("web_returns"))

    @cached_property
    def sales_spine(self) -> DataFrame:
        return sales.sales_spine(self.sales_union, self.staged("date_dim"), self.staged("item"))

    @cached_property
    def unified_sales(self) -> DataFrame:
        return self._unified(self.sales_union)

    def _unified(self, sold: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        dims = ("date_dim", "item", "customer", "customer_address", "store")
        return sales.unified_sales(
            sold, *[self.staged(t) for t in dims], hot_customers=self.hot_keys("customer"), extra=extra
        )

    @cached_property
    def unified_returns(self) -> DataFrame:
        return sales.unified_returns(
            self.returns_union, self.staged("date_dim"), self.staged("item"), self.sales_spine, self.hot_keys("sale")
        )

    @cached_property
    def net_sales(self) -> DataFrame:
        """``sales.net_sales``, but returns are joined to bare sales, so that descriptions stay out of that shuffle."""
        sold = sales.without_key(self.sales_union)
        met = sales.with_returns(sold, self.unified_returns, self.match_channel, self.hot_keys("sale"))
        return sales.net_columns(self._unified(sales.with_key(met), sales.RETURNED))

    @cached_property
    def sales_lines(self) -> DataFrame:
        """``sales.sales_lines``, but totals are joined to bare sales, so that descriptions stay out of that shuffle."""
        if self._lines is not None:
            return self._lines
        totals = sales.return_totals(self.sales_spine, self.returns_union, self.match_channel)
        sold = sales.without_key(self.sales_union)
        met = sales.with_totals(sold, totals, self.match_channel, self.hot_keys("sale"))
        return sales.weights(self._unified(sales.with_key(met), sales.TOTALS))

    @property
    def mart_lines(self) -> DataFrame:
        """The sales lines with the columns that marts read, to be stored for them."""
        return self.sales_lines.select(*marts.LINE_COLUMNS)

    @cached_property
    def dated_inventory(self) -> DataFrame:
        return inventory.dated_inventory(self.staged("inventory"), self.staged("date_dim"))

    @cached_property
    def item_daily_units(self) -> DataFrame:
        return inventory.item_daily_units(self.sales_spine)

    @cached_property
    def inventory_daily(self) -> DataFrame:
        return inventory.inventory_daily(
            self.staged("inventory"), self.staged("date_dim"), self.staged("item"), self.sales_spine
        )

    @cached_property
    def snapshot_input(self) -> DataFrame:
        return history.snapshot_input(self.staged("customer"), self.staged("customer_address"))

    # --- marts -----------------------------------------------------------------------------------------------------

    @cached_property
    def mart_daily_revenue(self) -> DataFrame:
        return marts.daily_revenue(self.sales_lines, self.staged("date_dim"))

    @cached_property
    def mart_returns_analysis(self) -> DataFrame:
        return marts.returns_analysis(self.returns_union, self.sales_spine, self.staged("item"))

    @cached_property
    def mart_inventory_health(self) -> DataFrame:
        return marts.inventory_health(
            self.dated_inventory, self.item_daily_units, self.staged("item"), self.limits
        )

    @cached_property
    def mart_customer_ltv(self) -> DataFrame:
        return marts.customer_ltv(self.sales_lines, self.staged("customer"), self.as_of, self.limits)

    @cached_property
    def promo_windows(self) -> DataFrame:
        return marts.promo_windows(self.staged("promotion"), self.staged("date_dim"))

    @cached_property
    def mart_promotion_effectiveness(self) -> DataFrame:
        return marts.promotion_effectiveness(self.sales_lines, self.staged("promotion"), self.staged("date_dim"))

    def mart(self, name: str) -> DataFrame:
        if name not in MART_NAMES:
            raise KeyError(name)
        return getattr(self, name)
