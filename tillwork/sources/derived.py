"""Raw tables derived from order-style parquet files (lineitem, orders, part, ...) by plain column expressions.

Ticket numbers collide between channels on purpose, some keys are missing, and some returns have no sale, so that
the models meet the same irregularities as real retail data. The rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillwork.session import shared_folder
from tillwork.sources.bronze import BRONZE_TABLES
from tillwork.sources.files import listed_files

# Schemas of the files, so that opening one starts no job to infer them.
FILES = {
    "region": "r_regionkey bigint, r_name string",
    "nation": "n_nationkey bigint, n_name string, n_regionkey bigint",
    "customer": "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size bigint, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

SPANS: dict[tuple[str, str], tuple[str, str]] = {}
SIZES: dict[tuple[str, str], int] = {}

PART_BYTES = 8_000_000  # of the large files, as stored, for one shuffle partition
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Columns of orders and their lines that the raw tables are derived from.
JOINED = (
    "o_orderkey",
    "o_custkey",
    "o_orderdate",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"

# --- fixed values: state of each nation key, untidy spellings and one missing state included --------------------
STATES = (
    "CA", "OR", "WA", "TX", "FL", "GA", "NC", "NY", "PA", "MA", "NJ", "IL", "OH",
    "MI", " ca ", "tx", "NV", "AZ", "CO", "VA", None, "MN", "WI", "UT", "ny ",
)

# --- fixed values: least span of the calendar and the number that date keys start from ---------------------------
CALENDAR = ("1990-01-01", "2005-12-31")
DATE_KEY_EPOCH = "1900-01-01"
DATE_KEY_OFFSET = 2415021
FIRST_PROMOTION = "1995-03-01"


def date_key(day: str) -> str:
    return f"cast(datediff({day}, date'{DATE_KEY_EPOCH}') + {DATE_KEY_OFFSET} as bigint)"


def _state(nation_key: str) -> str:
    states = ", ".join("cast(null as string)" if s is None else f"'{s}'" for s in STATES)
    return f"get(array({states}), cast({nation_key} as int))"


def _code(key: str) -> str:
    return f"lpad(cast({key} as string), 16, '0')"


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} as {name}" for name, expression in columns.items()])


class DerivedBronze(Mapping):
    """The thirteen raw tables for one folder of order-style parquet files, each built on first use.

    The session's shuffles start with as many partitions as the files need, so that a task's share does not grow with
    them; adaptive execution joins small ones."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(PARTITIONS, str(max(least, -(-self._bytes() // PART_BYTES))))
        self._files: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}
        self._joined: DataFrame | None = None

    def settled(self) -> DerivedBronze:
        """The same tables over order lines that are joined once and stored, with the inventory stored as well. For
        queries that read most tables, or read them more than once: each reading would join or group all lines anew."""
        root, settled = shared_folder(self._spark, "order-lines"), DerivedBronze(self._spark, self._folder)
        lines = self._order_lines().selectExpr(*JOINED, "o_orderkey % 3 as channel")
        lines.write.partitionBy("channel").parquet(f"{root}/lines")
        settled._joined = self._spark.read.schema(lines.schema).parquet(f"{root}/lines")
        counted = settled["inventory"]
        counted.write.parquet(f"{root}/inventory")
        settled._built["inventory"] = self._spark.read.schema(counted.schema).parquet(f"{root}/inventory")
        return settled

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def __iter__(self):
        return iter((*BRONZE_TABLES, "raw_clickstream"))

    def __contains__(self, name):
        return name in (*BRONZE_TABLES, "raw_clickstream")

    def __len__(self):
        return len(BRONZE_TABLES) + 1

    def file(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self._spark.read.schema(FILES[name]).parquet(f"{self._folder}/{name}.parquet")
        return self._files[name]

    def _bytes(self) -> int:
        """Size of the two large files. Listed once per session and folder."""
        known = (self._spark.sparkContext.applicationId, self._folder)
        if known not in SIZES:
            listed = [listed_files(self._spark, f"{self._folder}/{name}.parquet") for name in ("lineitem", "orders")]
            SIZES[known] = listed[0].union(listed[1]).selectExpr("coalesce(sum(length), 0)").first()[0]
        return SIZES[known]

    # --- facts ---------------------------------------------------------------------------------------------

    def _order_lines(self) -> DataFrame:
        if self._joined is not None:
            return self._joined
        lines, orders = self.file("lineitem"), self.file("orders")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])

    def _lines(self, channel: int) -> DataFrame:
        """Order lines of one channel; the filter on the order key reaches both scans, or picks the stored lines."""
        price, net = f"cast(l_extendedprice as {MONEY})", f"(1 - cast(l_discount as {RATE}))"
        of_channel = "o_orderkey % 3" if self._joined is None else "channel"
        return (
            self._order_lines()
            .where(f"{of_channel} = {channel}")
            .selectExpr(
                "*",
                f"{price} as price",
                f"cast({price} * {net} as {MONEY}) as net",
                "o_orderkey div 3 as ticket",
                "cast(l_shipdate as date) as shipped",
                "cast(l_quantity as bigint) as quantity",
            )
        )

    def _sales(self, channel: int, prefix: str, customer: str, number: str, **extra: str) -> DataFrame:
        columns = {
            "sold_date_sk": f"case when o_orderkey % 47 <> 0 then {date_key('shipped')} end",
            "item_sk": "l_partkey",
            customer: "case when o_orderkey % 53 <> 0 then o_custkey end",
            **extra,
            "promo_sk": "case when l_discount >= 0.075D then l_suppkey % 25 end",
            number: "ticket",
            "quantity": "quantity",
            "list_price": "price",
            "sales_price": "price",
            "net_paid": "net",
            "net_paid_inc_tax": f"cast(net * (1 + cast(l_tax as {RATE})) as {MONEY})",
            "net_profit": f"cast(net * 0.10 as {MONEY})",
        }
        return _select(self._lines(channel), {f"{prefix}_{name}": value for name, value in columns.items()})

    def _store_sales(self) -> DataFrame:
        return self._sales(0, "ss", "customer_sk", "ticket_number", store_sk="l_suppkey")

    def _web_sales(self) -> DataFrame:
        return self._sales(1, "ws", "bill_customer_sk", "order_number", ship_addr_sk="o_custkey")

    def _catalog_sales(self) -> DataFrame:
        return self._sales(2, "cs", "bill_customer_sk", "order_number")

    def _returns(self, channel: int, prefix: str, number: str, customer: str, reason: str) -> DataFrame:
        paid_back = "case when l_linestatus = 'F' then 1.00 else 0.50 end"
        columns = {
            "item_sk": "l_partkey",
            number: "ticket",
            "returned_date_sk": date_key("date_add(shipped, 5)"),
            customer: "o_custkey",
            reason: "l_linenumber",
            "return_quantity": "quantity",
            "return_amt": f"case when l_linenumber <> 7 then cast(net * {paid_back} as {MONEY}) end",
            "net_loss": f"cast(net * 0.05 as {MONEY})",
        }
        returned = self._lines(channel).where("l_returnflag = 'R'")
        return _select(returned, {f"{prefix}_{name}": value for name, value in columns.items()})

    def _store_returns(self) -> DataFrame:
        return self._returns(0, "sr", "ticket_number", "customer_sk", "return_reason_sk")

    def _web_returns(self) -> DataFrame:
        return self._returns(1, "wr", "order_number", "returning_customer_sk", "reason_sk")

    def _inventory(self) -> DataFrame:
        counted_on = "cast(case when l_linenumber <= 4 then l_shipdate else o_orderdate end as date)"
        counted = _select(
            self._order_lines(),
            {
                "inv_date_sk": date_key(counted_on),
                "inv_item_sk": "l_partkey",
                "inv_warehouse_sk": "l_suppkey % 4",
                "l_quantity": "l_quantity",
            },
        )
        grouped = counted.groupBy("inv_date_sk", "inv_item_sk", "inv_warehouse_sk").agg({"l_quantity": "sum"})
        return grouped.selectExpr(
            "inv_date_sk",
            "inv_item_sk",
            "inv_warehouse_sk",
            "cast(`sum(l_quantity)` as bigint) * (1 + inv_item_sk % 20) as inv_quantity_on_hand",
        )

    # --- dimensions ------------------------------------------------------------------------------------------

    def _placed(self, table: str, nation_key: str) -> DataFrame:
        """Rows of a table with the names of their nation and region."""
        nation, region = self.file("nation"), self.file("region")
        places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        return self.file(table).join(places, self.file(table)[nation_key] == places["n_nationkey"])

    def _item(self) -> DataFrame:
        columns = {
            "i_item_sk": "p_partkey",
            "i_item_id": _code("p_partkey"),
            "i_item_desc": "p_name",
            "i_current_price": "case when p_partkey % 97 <> 13 then cast((p_partkey * 7) % 300 as decimal(7,2)) end",
            "i_category": "p_type",
            "i_class": "p_brand",
            "i_brand": "p_brand",
            "i_units": "'Each'",
            "i_size": "cast(p_size as string)",
            "i_color": "split_part(p_name, ' ', 1)",
        }
        return _select(self.file("part"), columns)

    def _customer(self) -> DataFrame:
        columns = {
            "c_customer_sk": "c_custkey",
            "c_customer_id": _code("c_custkey"),
            "c_first_name": "c_name",
            "c_last_name": "c_mktsegment",
            "c_email_address": "cast(null as string)",
            "c_current_addr_sk": "c_custkey",
            "c_birth_year": "1940 + c_custkey % 60",
            "c_preferred_cust_flag": "case when c_custkey % 2 = 0 then 'Y' else 'N' end",
            "c_login": "cast(null as string)",
        }
        return _select(self.file("customer"), columns)

    def _customer_address(self) -> DataFrame:
        columns = {
            "ca_address_sk": "c_custkey",
            "ca_address_id": _code("c_custkey"),
            "ca_city": "n_name",
            "ca_state": _state("c_nationkey"),
            "ca_zip": "lpad(cast(c_custkey as string), 9, '0')",
            "ca_country": "r_name",
        }
        return _select(self._placed("customer", "c_nationkey"), columns)

    def _store(self) -> DataFrame:
        columns = {
            "s_store_sk": "s_suppkey",
            "s_store_id": _code("s_suppkey"),
            "s_store_name": "s_name",
            "s_number_employees": "s_suppkey % 300",
            "s_city": "n_name",
            "s_state": _state("s_nationkey"),
            "s_country": "r_name",
            "s_market_id": "s_suppkey % 10",
            "s_market_desc": "concat('Market ', cast(s_suppkey % 10 as string))",
            "s_geography_class": "'Unknown'",
        }
        return _select(self._placed("supplier", "s_nationkey"), columns)

    def _promotion(self) -> DataFrame:
        first = f"date'{FIRST_PROMOTION}'"
        media = {
            "email": "n_nationkey % 7 = 0",
            "tv": "n_nationkey % 7 = 1 or n_nationkey = 14",
            "radio": "n_nationkey % 7 = 2",
            "direct_mail": "n_nationkey % 7 = 3",
            "event": "n_nationkey % 7 = 4",
            "demo": "n_nationkey % 7 = 5",
        }
        columns = {
            "p_promo_sk": "n_nationkey",
            "p_promo_id": _code("n_nationkey"),
            "p_promo_name": "n_name",
            "p_start_date_sk": date_key(f"date_add({first}, cast(90 * n_nationkey as int))"),
            "p_end_date_sk": date_key(f"date_add({first}, cast(91 * n_nationkey + 30 as int))"),
            "p_cost": f"cast(1000 as {MONEY})",
            "p_response_target": "cast(1 as bigint)",
            "p_discount_active": "case when n_nationkey % 2 = 0 then 'Y' else 'N' end",
            **{f"p_channel_{name}": f"case when {hit} then 'Y' else 'N' end" for name, hit in media.items()},
        }
        return _select(self.file("nation"), columns)

    def _span(self) -> tuple[str, str]:
        """First and last day of the calendar: whole years around every date in the files, CALENDAR at least. Looked up
        once per session and folder, from two columns, so that the calendar itself stays a short list of days."""
        known = (self._spark.sparkContext.applicationId, self._folder)
        if known not in SPANS:
            placed = self.file("orders").selectExpr("cast(o_orderdate as date) as d")
            shipped = self.file("lineitem").selectExpr("cast(l_shipdate as date) as d")
            ends = placed.union(shipped).selectExpr(
                f"least(date'{CALENDAR[0]}', cast(trunc(min(d), 'year') as date)) as first",
                f"greatest(date'{CALENDAR[1]}', date_sub(trunc(date_add(max(d), 5 + 366), 'year'), 1)) as last",
            ).first()  # goods come back five days after they were shipped
            SPANS[known] = (str(ends["first"]), str(ends["last"]))
        return SPANS[known]

    def _date_dim(self) -> DataFrame:
        first, last = (f"date'{day}'" for day in self._span())
        days = self._spark.range(1).selectExpr(f"explode(sequence({first}, {last})) as d_date")
        as_long = {
            "d_month_seq": "(year(d_date) - 1900) * 12 + month(d_date) - 1",
            "d_year": "year(d_date)",
            "d_moy": "month(d_date)",
            "d_dom": "day(d_date)",
            "d_dow": "dayofweek(d_date) - 1",
            "d_fiscal_year_sk": "year(d_date)",
            "d_fy_year": "year(d_date)",
            "d_fy_quarter_seq": "(year(d_date) - 1900) * 4 + quarter(d_date) - 1",
            "d_qoy": "quarter(d_date)",
        }
        columns = {
            "d_date_sk": date_key("d_date"),
            "d_date": "d_date",
            "d_day_name": "date_format(d_date, 'EEEE')",
            **{name: f"cast({value} as bigint)" for name, value in as_long.items()},
            "d_holiday": "case when date_format(d_date, 'MM-dd') in ('01-01', '07-04', '12-25') then 'Y' else 'N' end",
            "d_weekend": "case when dayofweek(d_date) in (1, 7) then 'Y' else 'N' end",
        }
        return _select(days, columns)

    # --- event stream ------------------------------------------------------------------------------------------

    def _raw_clickstream(self) -> DataFrame:
        second = "ts - make_dt_interval(0, 0, 0, extract(second from ts) % 1)"
        columns = {
            "session_id": "concat('s', cast(user_id as string), '-', date_format(cast(ts as date), 'yyyyMMdd'))",
            "user_id": "user_id",
            "item_id": "cast(get_json_object(props, '$.k') as bigint)",
            "event_type": "case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart' "
            "else event_type end",
            "event_timestamp": second,
            "device_type": "get(array('desktop', 'mobile', 'tablet'), cast(event_id % 3 as int))",
            "referrer_source": "get(array('organic', 'paid_search', 'email', 'social', 'direct'), "
            "cast(event_id % 5 as int))",
            "_ingested_at": f"{second} + interval 1 hour",
        }
        return _select(self.file("events"), columns)
