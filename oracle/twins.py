"""A DuckDB query for each registered Spark query, put together from the named queries in ``base`` and ``models``."""

from __future__ import annotations

import re

from oracle.base import RAW, STAGED
from oracle.models import MODELS

NAMED = {**RAW, **STAGED, **MODELS}
EVENT = "session_id, user_id, item_id, event_type, event_timestamp, device_type, referrer_source"


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """``with`` every named query that ``final`` needs, directly or not, in the order they build on each other."""
    named = {**NAMED, **(extra or {})}
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"\b(?:from|join)\s+([a-z_0-9]+)", sql):
            if name in named and name not in ordered:
                need(named[name])
                ordered.append(name)

    need(final)
    parts = [f"{name} as ({named[name].strip()})" for name in ordered]
    return (f"with {', '.join(parts)} " if parts else "") + final.strip()


def doubles(source: str, *money: str) -> str:
    """All columns of a named query, with the given decimal ones as double."""
    if not money:
        return f"select * from {source}"
    casts = ", ".join(f"cast({m} as double) as {m}" for m in money)
    return f"select * replace ({casts}) from {source}"


SALES_MONEY = ("list_price", "sales_price", "gross_amount", "gross_amount_inc_tax", "net_profit")
RETURN_MONEY = ("return_amount", "net_loss")
RAW_SALES_MONEY = ("list_price", "sales_price", "net_paid", "net_paid_inc_tax", "net_profit")


def _raw(prefix: str, names: tuple[str, ...]) -> list[str]:
    return [f"{prefix}_{n}" for n in names]


MARTS = ("daily_revenue", "returns_analysis", "inventory_health", "customer_ltv", "promotion_effectiveness")

# --- customer history: three loads, merged step by step -----------------------------------------------------------------
CUSTOMER_COLUMNS = (
    "customer_id, customer_code, first_name, last_name, email, is_preferred_customer, address_code, city, state_code, "
    "zip_code, country, region"
)


def _new_version(at: str) -> str:
    return (
        f"md5(cast(customer_id as varchar) || '|' || '{at} 00:00:00') as dbt_scd_id, timestamp '{at}' as dbt_updated_at, "
        f"timestamp '{at}' as dbt_valid_from, cast(null as timestamp) as dbt_valid_to"
    )


def _merge(old: str, new: str, at: str) -> str:
    same = " and ".join(f"o.{c} is not distinct from n.{c}" for c in ("state_code", "zip_code", "city"))
    return f"""
        select o.* replace (case when o.dbt_valid_to is not null then o.dbt_valid_to
                                 when n.customer_id is null or not ({same}) then timestamp '{at}' end as dbt_valid_to)
        from {old} o left join {new} n on n.customer_id = o.customer_id
        union all
        select {CUSTOMER_COLUMNS}, {_new_version(at)} from {new} n
        where not exists (select 1 from {old} o where o.customer_id = n.customer_id and o.dbt_valid_to is null and {same})"""


HISTORY = {
    "load_moved": """
        select * replace (if(customer_id % 10 = 3, city || ' (new)', city) as city,
                          if(customer_id % 10 = 4, first_name || ' Jr', first_name) as first_name)
        from m_customers""",
    "load_one": "select * from m_customers where customer_id % 50 <> 9",
    "load_two": "select * from load_moved where customer_id % 50 <> 7",
    "load_three": "select * from load_moved where customer_id % 50 <> 9",
    "history_one": f"select {CUSTOMER_COLUMNS}, {_new_version('2024-01-01')} from load_one",
    "history_two": _merge("history_one", "load_two", "2024-02-01"),
    "history_three": _merge("history_two", "load_three", "2024-03-01"),
}

# --- untidy events --------------------------------------------------------------------------------------------------------
UNTIDY = {
    "untidy": """
        select if(event_id % 11 = 0, null, 's' || user_id) as session_id,
               if(event_id % 7 = 0, 'unknown', cast(user_id as varchar)) as user_id,
               if(event_id % 5 < 2, null, cast(event_id as varchar)) as item_id,
               event_type,
               if(event_id % 13 = 0, 'yesterday', strftime(ts, '%Y-%m-%d %H:%M:%S')) as event_timestamp,
               if(event_id % 3 = 0, 'mobile', null) as device_type, 'email' as referrer_source
        from events""",
    "untidy_good": """
        select session_id, try_cast(user_id as bigint) as user_id, try_cast(item_id as bigint) as item_id, event_type,
               try_cast(event_timestamp as timestamp) as event_timestamp, device_type, referrer_source
        from untidy
        where session_id is not null and user_id <> 'unknown' and event_timestamp <> 'yesterday'""",
    "untidy_bad": """
        select * from untidy
        where session_id is null or user_id = 'unknown' or event_timestamp = 'yesterday'""",
}

# --- checks: failures per declared check -----------------------------------------------------------------------------------
TIERS = "'budget', 'mid', 'premium', 'luxury'"
STAGING_CHECKS = (
    ("stg_store_sales", "sale_sk", "not_null"),
    ("stg_store_sales", "sale_sk", "unique"),
    ("stg_store_sales", "item_id", "not_null"),
    ("stg_store_sales", "ticket_number", "not_null"),
    ("stg_store_sales", "gross_amount", "not_null"),
    ("stg_store_sales", "gross_amount", "between", "0", "500000"),
    ("stg_web_sales", "sale_sk", "not_null"),
    ("stg_web_sales", "sale_sk", "unique"),
    ("stg_web_sales", "item_id", "not_null"),
    ("stg_catalog_sales", "sale_sk", "not_null"),
    ("stg_catalog_sales", "sale_sk", "unique"),
    ("stg_catalog_sales", "item_id", "not_null"),
    ("stg_store_returns", "return_sk", "not_null"),
    ("stg_store_returns", "return_sk", "unique"),
    ("stg_store_returns", "return_channel", "accepted_values", "'store'"),
    ("stg_web_returns", "return_sk", "not_null"),
    ("stg_web_returns", "return_sk", "unique"),
    ("stg_web_returns", "return_channel", "accepted_values", "'web'"),
    ("stg_inventory", "inventory_sk", "not_null"),
    ("stg_inventory", "inventory_sk", "unique"),
    ("stg_inventory", "quantity_on_hand", "between", "0", None),
    ("stg_item", "item_id", "not_null"),
    ("stg_item", "item_id", "unique"),
    ("stg_item", "price_tier", "not_null"),
    ("stg_item", "price_tier", "accepted_values", TIERS),
    ("stg_customer", "customer_id", "not_null"),
    ("stg_customer", "customer_id", "unique"),
    ("stg_customer_address", "address_id", "not_null"),
    ("stg_customer_address", "address_id", "unique"),
    ("stg_date_dim", "date_sk", "not_null"),
    ("stg_date_dim", "date_sk", "unique"),
    ("stg_date_dim", "is_holiday", "accepted_values", "true, false"),
    ("stg_date_dim", "is_weekend", "accepted_values", "true, false"),
    ("stg_promotion", "promotion_id", "not_null"),
    ("stg_promotion", "promotion_id", "unique"),
    ("stg_store", "store_id", "not_null"),
    ("stg_store", "store_id", "unique"),
    ("stg_clickstream", "event_sk", "not_null"),
    ("stg_clickstream", "event_sk", "unique"),
    ("stg_clickstream", "event_type", "not_null"),
    ("stg_clickstream", "event_type", "accepted_values", "'page_view', 'add_to_cart', 'purchase'"),
    ("stg_clickstream", "device_type", "accepted_values", "'desktop', 'mobile', 'tablet'"),
)
MART_CHECKS = (
    ("mart_daily_revenue", "sale_date", "not_null"),
    ("mart_daily_revenue", "channel", "not_null"),
    ("mart_daily_revenue", "channel", "accepted_values", "'store', 'web', 'catalog'"),
    ("mart_daily_revenue", "net_revenue", "not_null"),
    ("mart_daily_revenue", "net_revenue", "between", "0", None),
    ("mart_daily_revenue", "gross_revenue", "not_null"),
    ("mart_daily_revenue", "avg_order_value", "between", "0", None),
    ("mart_returns_analysis", "item_id", "not_null"),
    ("mart_returns_analysis", "return_rate_pct", "between", "0", "100"),
    ("mart_returns_analysis", "price_tier", "accepted_values", TIERS),
    ("mart_inventory_health", "item_id", "not_null"),
    ("mart_inventory_health", "warehouse_id", "not_null"),
    ("mart_inventory_health", "stockout_risk_flag", "not_null"),
    ("mart_inventory_health", "stockout_risk_flag", "accepted_values", "'HIGH', 'MEDIUM', 'LOW'"),
    ("mart_inventory_health", "quantity_on_hand", "between", "0", None),
    ("mart_customer_ltv", "customer_id", "not_null"),
    ("mart_customer_ltv", "customer_id", "unique"),
    ("mart_customer_ltv", "ltv_segment", "not_null"),
    ("mart_customer_ltv", "ltv_segment", "accepted_values", "'platinum', 'gold', 'silver', 'bronze'"),
    ("mart_customer_ltv", "total_lifetime_spend", "between", "0", None),
    ("mart_customer_ltv", "preferred_channel", "accepted_values", "'store', 'web', 'catalog'"),
    ("mart_promotion_effectiveness", "promotion_id", "not_null"),
    ("mart_promotion_effectiveness", "promotion_id", "unique"),
    ("mart_promotion_effectiveness", "promo_net_revenue", "between", "0", None),
)


def _check_rows(check: tuple) -> str:
    model, column, kind, *limits = check
    source = model.replace("stg_", "s_").replace("mart_", "m_")
    if kind == "unique":
        source = f"(select {column} from {source} where {column} is not null group by {column} having count(*) > 1)"
        condition = "true"
    elif kind == "not_null":
        condition = f"{column} is null"
    elif kind == "accepted_values":
        condition = f"{column} not in ({limits[0]})"
    else:
        low, high = limits
        condition = f"{column} < {low}" + (f" or {column} > {high}" if high else "")
    return f"select '{kind}.{model}.{column}' as check_name, count(*) as failures from {source} where {condition}"


def report(checks: tuple) -> str:
    return " union all ".join(_check_rows(check) for check in checks)


def _contents(tables: tuple[str, ...]) -> str:
    """Rows and values per column; the column ``*`` stands for whole rows."""
    return " union all ".join(
        f"""
            select '{t}' as table_name, field.key as column_name, count(*) as n_rows,
                   count(*) filter (field.type <> 'NULL') as n_values, true as same
            from b_{t} as whole, json_each(to_json(whole)) as field group by field.key
            union all select '{t}', '*', count(*), count(*), true from b_{t}"""
        for t in tables
    )


RAW_TABLES = (
    "store_sales", "web_sales", "catalog_sales", "store_returns", "web_returns", "inventory", "item", "customer",
    "customer_address", "date_dim", "promotion", "store",
)
CAPTURED = {
    "store_sales": ("ss_item_sk", *_raw("ss", RAW_SALES_MONEY)),
    "web_sales": ("ws_item_sk", *_raw("ws", RAW_SALES_MONEY)),
    "catalog_sales": ("cs_item_sk", *_raw("cs", RAW_SALES_MONEY)),
    "store_returns": ("sr_item_sk", "sr_return_amt", "sr_net_loss"),
    "web_returns": ("wr_item_sk", "wr_return_amt", "wr_net_loss"),
    "inventory": ("inv_item_sk",),
    "raw_clickstream": ("item_id",),
}
TASKS = {
    "refresh_sales_task": ("store_sales", "web_sales", "catalog_sales"),
    "refresh_returns_task": ("store_returns", "web_returns"),
    "refresh_inventory_task": ("inventory",),
    "refresh_clickstream_task": ("raw_clickstream",),
}


def _task_counts(condition: str = "true") -> str:
    """Rows per refresh task; ``{item}`` in the condition stands for the item column of each table."""
    per_table = " union all ".join(
        f"select '{task}' as task_name, count(*) as n from b_{t} where {condition.format(item=CAPTURED[t][0])}"
        for task, tables in TASKS.items()
        for t in tables
    )
    return f"select task_name, cast(sum(n) as bigint) as rows_processed from ({per_table}) group by task_name"


KEPT = {
    "store_sales": "ss_item_sk is not null and ss_ticket_number is not null and ss_sold_date_sk is not null",
    "web_sales": "ws_item_sk is not null and ws_order_number is not null and ws_sold_date_sk is not null",
    "catalog_sales": "cs_item_sk is not null and cs_order_number is not null and cs_sold_date_sk is not null",
    "store_returns": "sr_item_sk is not null and sr_ticket_number is not null",
    "web_returns": "wr_item_sk is not null and wr_order_number is not null",
    "inventory": "inv_item_sk is not null and inv_warehouse_sk is not null",
    "item": "i_item_sk is not null",
    "customer": "c_customer_sk is not null",
    "customer_address": "ca_address_sk is not null",
    "date_dim": "d_date_sk is not null",
    "promotion": "p_promo_sk is not null",
    "store": "s_store_sk is not null",
    "raw_clickstream": "session_id is not null and event_timestamp is not null "
    "and event_type in ('page_view', 'add_to_cart', 'purchase')",
}


def oracle_sql() -> dict[str, str]:
    raw_money = {
        "store_sales": _raw("ss", RAW_SALES_MONEY),
        "web_sales": _raw("ws", RAW_SALES_MONEY),
        "catalog_sales": _raw("cs", RAW_SALES_MONEY),
        "store_returns": ["sr_return_amt", "sr_net_loss"],
        "web_returns": ["wr_return_amt", "wr_net_loss"],
        "item": ["i_current_price"],
        "promotion": ["p_cost"],
    }
    staged_money = {
        "store_sales": SALES_MONEY,
        "web_sales": SALES_MONEY,
        "catalog_sales": SALES_MONEY,
        "store_returns": RETURN_MONEY,
        "web_returns": RETURN_MONEY,
        "item": ("current_price",),
        "promotion": ("promotion_cost",),
    }
    net_money = ("gross_amount", "return_amount", "net_amount", "current_price")
    same_channel = """
        select s.* exclude (gross_amount_inc_tax, net_profit), return_amount, quantity_returned,
               gross_amount - coalesce(return_amount, 0) as net_amount, return_amount is not null as was_returned
        from m_unified_sales s
        left join m_unified_returns r
          on r.item_id = s.item_id and r.ticket_number = s.ticket_number and r.return_channel = s.channel"""
    event_times = "timestamp '2024-02-01 00:00:00'"
    plain: dict[str, str] = {
        **{f"bronze_{t}": doubles(f"b_{t}", *raw_money.get(t, ())) for t in RAW_TABLES},
        "raw_clickstream": "select * from b_raw_clickstream",
        **{f"stg_{t}": doubles(f"s_{t}", *staged_money.get(t, ())) for t in RAW_TABLES},
        "stg_clickstream": "select * from s_clickstream",
        "sales_union": doubles("m_sales", *SALES_MONEY),
        "returns_union": doubles("m_returns", *RETURN_MONEY),
        "int_unified_sales": doubles(
            "m_unified_sales", "gross_amount", "gross_amount_inc_tax", "net_profit", "current_price"
        ),
        "int_unified_returns": doubles("m_unified_returns", *RETURN_MONEY),
        "int_net_sales": doubles("m_net_sales", *net_money),
        "int_inventory_daily": "select * from m_inventory_daily",
        "item_daily_units": "select * from m_item_daily_units",
        "rolling_avg_30": "select item_id, warehouse_id, inv_date, avg_daily_sales_30d from m_inventory_daily",
        "latest_snapshot": """
            select inventory_sk, item_id, warehouse_id, inv_date, quantity_on_hand from m_snapshots
            qualify row_number() over (partition by item_id, warehouse_id
                                       order by inv_date desc, inventory_sk desc, quantity_on_hand desc) = 1""",
        "sales_by_promo_flag": "select * from m_sales_by_flag",
        "returns_by_promo_flag": "select * from m_returns_by_flag",
        "customer_totals": "select * from m_totals",
        "preferred_channel": "select * from m_preferred",
        "promo_windows": "select * from m_windows",
        "promo_period_sales": "select * from m_promo_sales",
        "baseline_sales": "select * from m_baseline",
        **{f"mart_{m}": f"select * from m_{m}" for m in MARTS},
        "snapshot_input": "select * from m_customers",
        "bronze_copy": _contents((*RAW_TABLES, "raw_clickstream")),
        "key_summaries": """
            select customer_id, count(*) as n, any_value(n_rows) as n_rows
            from (
              select customer_id, count(*) over () as n_rows
              from (
                select ss_customer_sk as customer_id from b_store_sales
                union all select ws_bill_customer_sk from b_web_sales
                union all select cs_bill_customer_sk from b_catalog_sales) buyers
              where customer_id is not null) known
            group by customer_id having count(*) * 1000 > any_value(n_rows)""",
        "materialize_view": """
            select channel, count(*) as n_rows, cast(sum(gross_amount) as double) as gross
            from m_unified_sales group by channel""",
        "materialize_table": "select * from m_returns_analysis",
        **{f"mv_{m}": f"select * from m_{m}" for m in MARTS},
        "dq_not_null": doubles("(select * from s_store_sales where customer_id is null)", *SALES_MONEY),
        "dq_unique": "select sale_sk, count(*) as n_records from m_sales group by sale_sk having count(*) > 1",
        "dq_accepted_values": """
            select event_type as value_field, count(*) as n_records from b_raw_clickstream
            where event_type not in ('page_view', 'purchase') group by event_type""",
        "dq_between": doubles(
            "(select * from s_store_sales where gross_amount < 1000 or gross_amount > 90000)", *SALES_MONEY
        ),
        "dq_freshness": f"""
            select newest, age_hours,
                   case when age_hours <= 25 then 'pass' when age_hours <= 49 then 'warn' else 'error' end as status
            from (select max(_ingested_at) as newest,
                         date_diff('second', max(_ingested_at), {event_times}) / 3600 as age_hours
                  from b_raw_clickstream)""",
        "dq_net_revenue_not_negative": """
            select sale_date, channel, net_revenue from m_daily_revenue where net_revenue < 0""",
        "dq_all_channels_present": """
            select expected_channel from (values ('store'), ('web'), ('catalog'), ('phone')) v(expected_channel)
            where expected_channel not in (select channel from m_daily_revenue)""",
        "dq_staging_report": report(STAGING_CHECKS),
        "dq_mart_report": report(MART_CHECKS),
        "dq_checkpoint": report(
            tuple(
                c
                for c in STAGING_CHECKS
                if c[0] in ("stg_item", "stg_customer", "stg_customer_address", "stg_store", "stg_promotion")
            )
        ),
        "dq_quarantine": doubles(
            f"(select * from b_store_sales where not ({KEPT['store_sales']}))", *_raw("ss", RAW_SALES_MONEY)
        ),
        "dq_left_out": " union all ".join(
            f"select '{t}' as table_name, count(*) as n_rows, count(*) filter (not ({rule})) as n_left_out from b_{t}"
            for t, rule in KEPT.items()
        ),
        "safe_divide": """
            select l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
                   l_extendedprice / nullif(l_linenumber - 1, 0) as ratio from lineitem""",
        "surrogate_key": """
            select o_orderkey,
                   md5(cast(o_orderkey as varchar) || '-' || if(o_orderkey % 53 = 0, '_dbt_utils_surrogate_key_null_',
                       cast(o_custkey as varchar)) || '-' || o_orderstatus) as row_sk
            from orders""",
        "price_tier": "select item_id as i_item_sk, price_tier from s_item",
        "channel_label": """
            select o_orderkey, ['store', 'web', 'catalog'][o_orderkey % 3 + 1] as channel from orders""",
        "region_map": """
            select ca_address_sk, upper(trim(ca_state)) as state_code, coalesce(c.area, 'Other') as customer_region,
                   coalesce(s.area, 'Other') as store_region
            from b_customer_address
            left join customer_regions c on c.code = upper(trim(ca_state))
            left join store_regions s on s.code = upper(trim(ca_state))""",
        "channel_type": "select promotion_id, channel_type from s_promotion",
        "ltv_segment": """
            select c_custkey, case when c_acctbal >= 10000 then 'platinum' when c_acctbal >= 5000 then 'gold'
                                   when c_acctbal >= 1000 then 'silver' else 'bronze' end as ltv_segment
            from customer""",
        "stockout_flag": """
            select p_partkey, days_of_supply,
                   case when days_of_supply >= 14 then 'LOW' when days_of_supply >= 7 then 'MEDIUM' else 'HIGH' end
                       as stockout_risk_flag,
                   cast(round(cast(days_of_supply as decimal(38,12)), 1) as double) as days_until_stockout
            from (select p_partkey, p_size / nullif(p_partkey % 4, 0) as days_of_supply from part)""",
        "ndjson_sink": f"select {EVENT} from b_raw_clickstream",
        "landing_zone": """
            select cast(user_id % 2 as varchar) as batch, count(*) as n_rows from b_raw_clickstream group by 1""",
        "incremental_ingest": f"select {EVENT}, user_id % 2 as batch from b_raw_clickstream",
        "micro_batch": """
            select user_id % 2 as batch, event_type, count(*) as n_rows from b_raw_clickstream group by 1, 2""",
        "commit_after_write": f"select {EVENT} from b_raw_clickstream",
        "replayed_load": f"select {EVENT} from b_raw_clickstream",
        "kafka_decode": f"select {EVENT} from b_raw_clickstream",
        "keyed_publish": "select session_id as key, event_type, user_id from b_raw_clickstream",
        "dedup_events": """
            select distinct event_sk, session_id, customer_id, event_type from s_clickstream
            qualify row_number() over (partition by event_sk order by event_type) = 1""",
        **{
            f"append_stream_{t.removeprefix('raw_')}": doubles(f"(select *, {item} % 2 as found_by from b_{t})", *money)
            for t, (item, *money) in CAPTURED.items()
        },
        "has_data": """
            select cast(refresh_no as bigint) as refresh_no, refresh_no <> 2 as found_rows
            from range(1, 4) r(refresh_no) where (select count(*) from lineitem) > 0""",
        "refresh_counts": f"""
            select *, 'first' as run from ({_task_counts("{item} % 2 = 0")})
            union all select *, 'second' as run from ({_task_counts("{item} % 2 = 1")})""",
        "run_log": f"""
            select task_name, rows_processed, 'SUCCESS' as status, cast(null as varchar) as error_message
            from ({_task_counts()})
            union all select 'root_refresh_task', null, 'RUNNING', null
            union all select 'log_completion_task — pipeline complete', null, 'SUCCESS', null""",
        "failure_row": """
            select 'refresh_returns_task' as task_name, 'FAILED' as status, true as has_message
            where exists (select 1 from lineitem where l_returnflag = 'R')""",
        "refresh_after_failure": f"""
            select 'first' as run, task_name, 'SUCCESS' as status, rows_processed
            from ({_task_counts("{item} % 2 = 0")}) where task_name = 'refresh_sales_task'
            union all select 'first', 'refresh_returns_task', 'FAILED', null
            union all
            select 'third', task_name, 'SUCCESS', rows_processed
            from ({_task_counts("{item} % 2 = 1")}) where task_name = 'refresh_sales_task'
            union all
            select 'third', task_name, 'SUCCESS', rows_processed
            from ({_task_counts()}) where task_name <> 'refresh_sales_task'
            union all select unnest(['first', 'third']), 'root_refresh_task', 'RUNNING', null
            union all select 'third', 'log_completion_task — pipeline complete', 'SUCCESS', null""",
        "layered_run_published": " union all ".join(
            f"select 'mv_{m}' as view_name, count(*) as n_rows from m_{m}" for m in MARTS
        ),
        "layered_run": f"""
            select 'bronze' as layer, unnest({[f"same_contents.{t}" for t in (*RAW_TABLES, "raw_clickstream")]}) as check_name,
                   0 as failures
            union all
            select 'silver', 'freshness.raw_clickstream._ingested_at',
                   cast(date_diff('second', max(_ingested_at), timestamp '2024-02-01') / 3600 > 49 as bigint) from b_raw_clickstream
            union all
            select 'silver' as layer, check_name, failures from ({report(STAGING_CHECKS)})
            union all
            select 'gold', check_name, failures from ({report(MART_CHECKS)})
            union all
            select 'gold', 'assert_net_revenue_not_negative', count(*) from m_daily_revenue where net_revenue < 0
            union all
            select 'gold', 'assert_all_channels_present', 3 - count(distinct channel) from m_daily_revenue""",
    }
    twins = {name: compose(sql) for name, sql in plain.items()}
    twins["int_net_sales_same_channel"] = compose(
        doubles("same_channel", *net_money), {"same_channel": same_channel}
    )
    twins["mart_daily_revenue_same_channel"] = compose(
        "select * from m_daily_revenue", {"m_net_sales": same_channel}
    )
    history = {
        "scd2_merge": "select * from history_three",
        "scd2_stored": "select * from history_three",
        "scd2_current": "select * from history_three where dbt_valid_to is null",
        "scd2_as_of": """
            select * from history_three
            where dbt_valid_from <= timestamp '2024-02-15'
              and (dbt_valid_to is null or dbt_valid_to > timestamp '2024-02-15')""",
        "scd2_facts_as_of": """
            select event_sk, e.customer_id as buyer, event_timestamp, city
            from s_clickstream e
            left join history_three h on h.customer_id = e.customer_id and h.dbt_valid_from <= event_timestamp
                 and (h.dbt_valid_to is null or h.dbt_valid_to > event_timestamp)""",
    }
    twins |= {name: compose(sql, HISTORY) for name, sql in history.items()}
    untidy = {
        "ndjson_read": "select * from untidy",
        "json_extract_cast": "select * from untidy_good",
        "json_rejects": "select * from untidy_bad",
        "incremental_ingest_rejects": "select * from untidy_bad",
    }
    twins |= {name: compose(sql, UNTIDY) for name, sql in untidy.items()}
    return twins
