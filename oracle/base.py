"""Raw tables and staged tables for DuckDB, written independently of the Spark code. One named query each."""

# Raw tables, derived from the order-style tables by the rules in FIXTURES.md.
RAW = {
    "lines": """
        select l.*, o.o_custkey, o.o_orderdate,
               l.l_orderkey % 3 as leg,
               l.l_orderkey // 3 as ticket,
               cast(l.l_quantity as bigint) as qty,
               cast(l.l_shipdate as date) as shipped,
               cast(l.l_extendedprice as decimal(12,2)) as price,
               cast(cast(l.l_extendedprice as decimal(12,2)) * (1 - cast(l.l_discount as decimal(4,2))) as decimal(12,2)) as net
        from lineitem l join orders o on o.o_orderkey = l.l_orderkey""",
    "selling": """
        select leg, ticket, l_partkey as item, l_suppkey as supplier, o_custkey as shopper,
               if(l_orderkey % 47 = 0, null, date_diff('day', date '1900-01-01', shipped) + 2415021) as day_sk,
               if(l_orderkey % 53 = 0, null, o_custkey) as buyer,
               if(l_discount >= 0.075, l_suppkey % 25, null) as promo,
               qty, price, net,
               cast(net * (1 + cast(l_tax as decimal(4,2))) as decimal(12,2)) as taxed,
               cast(net * cast(0.10 as decimal(4,2)) as decimal(12,2)) as profit
        from lines""",
    "b_store_sales": """
        select day_sk as ss_sold_date_sk, item as ss_item_sk, buyer as ss_customer_sk, supplier as ss_store_sk,
               promo as ss_promo_sk, ticket as ss_ticket_number, qty as ss_quantity, price as ss_list_price,
               price as ss_sales_price, net as ss_net_paid, taxed as ss_net_paid_inc_tax, profit as ss_net_profit
        from selling where leg = 0""",
    "b_web_sales": """
        select day_sk as ws_sold_date_sk, item as ws_item_sk, buyer as ws_bill_customer_sk,
               shopper as ws_ship_addr_sk, promo as ws_promo_sk, ticket as ws_order_number, qty as ws_quantity,
               price as ws_list_price, price as ws_sales_price, net as ws_net_paid, taxed as ws_net_paid_inc_tax,
               profit as ws_net_profit
        from selling where leg = 1""",
    "b_catalog_sales": """
        select day_sk as cs_sold_date_sk, item as cs_item_sk, buyer as cs_bill_customer_sk, promo as cs_promo_sk,
               ticket as cs_order_number, qty as cs_quantity, price as cs_list_price, price as cs_sales_price,
               net as cs_net_paid, taxed as cs_net_paid_inc_tax, profit as cs_net_profit
        from selling where leg = 2""",
    "sent_back": """
        select leg, ticket, l_partkey as item, o_custkey as shopper, qty, cast(l_linenumber as bigint) as reason,
               date_diff('day', date '1900-01-01', shipped) + 5 + 2415021 as day_sk,
               case when l_linenumber = 7 then null
                    when l_linestatus = 'F' then net
                    else cast(net * cast(0.50 as decimal(4,2)) as decimal(12,2)) end as amount,
               cast(net * cast(0.05 as decimal(4,2)) as decimal(12,2)) as loss
        from lines where l_returnflag = 'R'""",
    "b_store_returns": """
        select item as sr_item_sk, ticket as sr_ticket_number, day_sk as sr_returned_date_sk,
               shopper as sr_customer_sk, reason as sr_return_reason_sk, qty as sr_return_quantity,
               amount as sr_return_amt, loss as sr_net_loss
        from sent_back where leg = 0""",
    "b_web_returns": """
        select item as wr_item_sk, ticket as wr_order_number, day_sk as wr_returned_date_sk,
               shopper as wr_returning_customer_sk, reason as wr_reason_sk, qty as wr_return_quantity,
               amount as wr_return_amt, loss as wr_net_loss
        from sent_back where leg = 1""",
    "b_inventory": """
        select date_diff('day', date '1900-01-01', cast(if(l_linenumber <= 4, l_shipdate, o_orderdate) as date)) + 2415021
                   as inv_date_sk,
               l_partkey as inv_item_sk, l_suppkey % 4 as inv_warehouse_sk,
               cast(sum(l_quantity) as bigint) * (1 + l_partkey % 20) as inv_quantity_on_hand
        from lines group by 1, 2, 3""",
    "b_item": """
        select p_partkey as i_item_sk, lpad(cast(p_partkey as varchar), 16, '0') as i_item_id, p_name as i_item_desc,
               if(p_partkey % 97 = 13, null, cast((p_partkey * 7) % 300 as decimal(7,2))) as i_current_price,
               p_type as i_category, p_brand as i_class, p_brand as i_brand, 'Each' as i_units,
               cast(p_size as varchar) as i_size, split_part(p_name, ' ', 1) as i_color
        from part""",
    "b_customer": """
        select c_custkey as c_customer_sk, lpad(cast(c_custkey as varchar), 16, '0') as c_customer_id,
               c_name as c_first_name, c_mktsegment as c_last_name, cast(null as varchar) as c_email_address,
               c_custkey as c_current_addr_sk, 1940 + c_custkey % 60 as c_birth_year,
               if(c_custkey % 2 = 0, 'Y', 'N') as c_preferred_cust_flag, cast(null as varchar) as c_login
        from customer""",
    "states": """
        select unnest(range(25)) as nation,
               unnest(['CA','OR','WA','TX','FL','GA','NC','NY','PA','MA','NJ','IL','OH','MI',' ca ','tx','NV','AZ','CO',
                       'VA',null,'MN','WI','UT','ny ']) as state""",
    "places": """
        select n_nationkey as nation, n_name, r_name, state
        from nation join region on r_regionkey = n_regionkey join states on states.nation = n_nationkey""",
    "b_customer_address": """
        select c_custkey as ca_address_sk, lpad(cast(c_custkey as varchar), 16, '0') as ca_address_id,
               n_name as ca_city, state as ca_state, lpad(cast(c_custkey as varchar), 9, '0') as ca_zip,
               r_name as ca_country
        from customer join places on nation = c_nationkey""",
    "b_store": """
        select s_suppkey as s_store_sk, lpad(cast(s_suppkey as varchar), 16, '0') as s_store_id, s_name as s_store_name,
               s_suppkey % 300 as s_number_employees, n_name as s_city, state as s_state, r_name as s_country,
               s_suppkey % 10 as s_market_id, 'Market ' || (s_suppkey % 10) as s_market_desc,
               'Unknown' as s_geography_class
        from supplier join places on nation = s_nationkey""",
    "b_promotion": """
        select cast(n_nationkey as bigint) as p_promo_sk, lpad(cast(n_nationkey as varchar), 16, '0') as p_promo_id,
               n_name as p_promo_name,
               date_diff('day', date '1900-01-01', date '1995-03-01') + 90 * n_nationkey + 2415021 as p_start_date_sk,
               date_diff('day', date '1900-01-01', date '1995-03-01') + 91 * n_nationkey + 30 + 2415021 as p_end_date_sk,
               cast(1000 as decimal(12,2)) as p_cost, cast(1 as bigint) as p_response_target,
               if(n_nationkey % 2 = 0, 'Y', 'N') as p_discount_active,
               if(n_nationkey % 7 = 0, 'Y', 'N') as p_channel_email,
               if(n_nationkey % 7 = 1 or n_nationkey = 14, 'Y', 'N') as p_channel_tv,
               if(n_nationkey % 7 = 2, 'Y', 'N') as p_channel_radio,
               if(n_nationkey % 7 = 3, 'Y', 'N') as p_channel_direct_mail,
               if(n_nationkey % 7 = 4, 'Y', 'N') as p_channel_event,
               if(n_nationkey % 7 = 5, 'Y', 'N') as p_channel_demo
        from nation""",
    "days": """
        select cast(unnest(generate_series(
                 least(date '1990-01-01', cast(date_trunc('year', min(d)) as date)),
                 greatest(date '2005-12-31', cast(date_trunc('year', max(d) + interval 371 day) - interval 1 day as date)),
                 interval 1 day)) as date) as d
        from (select cast(o_orderdate as date) as d from orders union all select cast(l_shipdate as date) from lineitem)""",
    "b_date_dim": """
        select date_diff('day', date '1900-01-01', d) + 2415021 as d_date_sk, d as d_date, dayname(d) as d_day_name,
               (year(d) - 1900) * 12 + month(d) - 1 as d_month_seq, year(d) as d_year, month(d) as d_moy,
               day(d) as d_dom, dayofweek(d) as d_dow, year(d) as d_fiscal_year_sk, year(d) as d_fy_year,
               (year(d) - 1900) * 4 + quarter(d) - 1 as d_fy_quarter_seq, quarter(d) as d_qoy,
               if(strftime(d, '%m-%d') in ('01-01', '07-04', '12-25'), 'Y', 'N') as d_holiday,
               if(dayofweek(d) in (0, 6), 'Y', 'N') as d_weekend
        from days""",
    "b_raw_clickstream": """
        select 's' || user_id || '-' || strftime(ts, '%Y%m%d') as session_id, user_id,
               cast(json_extract_string(props, '$.k') as bigint) as item_id,
               case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart' else event_type end
                   as event_type,
               date_trunc('second', ts) as event_timestamp,
               ['desktop', 'mobile', 'tablet'][event_id % 3 + 1] as device_type,
               ['organic', 'paid_search', 'email', 'social', 'direct'][event_id % 5 + 1] as referrer_source,
               date_trunc('second', ts) + interval 1 hour as _ingested_at
        from events""",
}


def _key(*parts: str) -> str:
    texts = [f"coalesce(cast({p} as varchar), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


STAGED = {
    "s_store_sales": f"""
        select {_key("ss_ticket_number", "ss_item_sk")} as sale_sk, ss_sold_date_sk as date_sk, ss_item_sk as item_id,
               ss_customer_sk as customer_id, ss_store_sk as store_id, ss_promo_sk as promotion_id,
               ss_ticket_number as ticket_number, ss_quantity as quantity_sold, ss_list_price as list_price,
               ss_sales_price as sales_price, ss_net_paid as gross_amount,
               ss_net_paid_inc_tax as gross_amount_inc_tax, ss_net_profit as net_profit
        from b_store_sales
        where ss_item_sk is not null and ss_ticket_number is not null and ss_sold_date_sk is not null""",
    "s_web_sales": f"""
        select {_key("ws_order_number", "ws_item_sk")} as sale_sk, ws_sold_date_sk as date_sk, ws_item_sk as item_id,
               ws_bill_customer_sk as customer_id, ws_ship_addr_sk as ship_address_id, ws_promo_sk as promotion_id,
               ws_order_number as ticket_number, ws_quantity as quantity_sold, ws_list_price as list_price,
               ws_sales_price as sales_price, ws_net_paid as gross_amount,
               ws_net_paid_inc_tax as gross_amount_inc_tax, ws_net_profit as net_profit
        from b_web_sales
        where ws_item_sk is not null and ws_order_number is not null and ws_sold_date_sk is not null""",
    "s_catalog_sales": f"""
        select {_key("cs_order_number", "cs_item_sk")} as sale_sk, cs_sold_date_sk as date_sk, cs_item_sk as item_id,
               cs_bill_customer_sk as customer_id, cs_promo_sk as promotion_id, cs_order_number as ticket_number,
               cs_quantity as quantity_sold, cs_list_price as list_price, cs_sales_price as sales_price,
               cs_net_paid as gross_amount, cs_net_paid_inc_tax as gross_amount_inc_tax, cs_net_profit as net_profit
        from b_catalog_sales
        where cs_item_sk is not null and cs_order_number is not null and cs_sold_date_sk is not null""",
    "s_store_returns": f"""
        select {_key("sr_ticket_number", "sr_item_sk")} as return_sk, sr_item_sk as item_id,
               sr_ticket_number as ticket_number, sr_returned_date_sk as return_date_sk, sr_customer_sk as customer_id,
               sr_return_reason_sk as return_reason_id, sr_return_quantity as quantity_returned,
               sr_return_amt as return_amount, sr_net_loss as net_loss, 'store' as return_channel
        from b_store_returns
        where sr_item_sk is not null and sr_ticket_number is not null""",
    "s_web_returns": f"""
        select {_key("wr_order_number", "wr_item_sk")} as return_sk, wr_item_sk as item_id,
               wr_order_number as ticket_number, wr_returned_date_sk as return_date_sk,
               wr_returning_customer_sk as customer_id, wr_reason_sk as return_reason_id,
               wr_return_quantity as quantity_returned, wr_return_amt as return_amount, wr_net_loss as net_loss,
               'web' as return_channel
        from b_web_returns
        where wr_item_sk is not null and wr_order_number is not null""",
    "s_inventory": f"""
        select {_key("inv_item_sk", "inv_warehouse_sk", "inv_date_sk")} as inventory_sk, inv_date_sk as date_sk,
               inv_item_sk as item_id, inv_warehouse_sk as warehouse_id, inv_quantity_on_hand as quantity_on_hand
        from b_inventory
        where inv_item_sk is not null and inv_warehouse_sk is not null""",
    "s_item": """
        select i_item_sk as item_id, i_item_id as item_code, i_item_desc as item_description,
               i_current_price as current_price, i_category as category, i_class as item_class, i_brand as brand,
               i_units as unit_of_measure, i_size as item_size, i_color as color,
               case when i_current_price < 25 then 'budget' when i_current_price < 75 then 'mid'
                    when i_current_price < 200 then 'premium' else 'luxury' end as price_tier
        from b_item where i_item_sk is not null""",
    "s_customer": """
        select c_customer_sk as customer_id, c_customer_id as customer_code, c_first_name as first_name,
               c_last_name as last_name, c_email_address as email, c_current_addr_sk as current_address_id,
               c_birth_year - c_birth_year % 10 as birth_decade, c_preferred_cust_flag as is_preferred_customer,
               c_login as login_name
        from b_customer where c_customer_sk is not null""",
    "customer_regions": """
        select unnest(['CA','OR','WA','TX','FL','GA','NC','NY','PA','MA','NJ','IL','OH','MI']) as code,
               unnest(['West','West','West','South','South','South','South','Northeast','Northeast','Northeast',
                       'Northeast','Midwest','Midwest','Midwest']) as area""",
    "store_regions": """
        select * from customer_regions where code not in ('NC', 'NJ', 'MI')""",
    "s_customer_address": """
        select ca_address_sk as address_id, ca_address_id as address_code, ca_city as city,
               upper(trim(ca_state)) as state_code, ca_zip as zip_code, ca_country as country,
               coalesce(area, 'Other') as region
        from b_customer_address left join customer_regions on code = upper(trim(ca_state))
        where ca_address_sk is not null""",
    "s_store": """
        select s_store_sk as store_id, s_store_id as store_code, s_store_name as store_name,
               s_number_employees as employee_count, s_city as city, upper(trim(s_state)) as state_code,
               s_country as country, s_market_id as market_id, s_market_desc as market_description,
               s_geography_class as geography_class, coalesce(area, 'Other') as region
        from b_store left join store_regions on code = upper(trim(s_state))
        where s_store_sk is not null""",
    "s_date_dim": """
        select d_date_sk as date_sk, d_date as calendar_date, d_day_name as day_name, d_month_seq as month_seq,
               d_year as calendar_year, d_moy as month_of_year, d_dom as day_of_month, d_dow as day_of_week,
               d_holiday = 'Y' as is_holiday, d_weekend = 'Y' as is_weekend, d_fiscal_year_sk as fiscal_year_sk,
               d_fy_year as fiscal_year, d_fy_quarter_seq as fiscal_quarter_seq, d_qoy as fiscal_quarter
        from b_date_dim where d_date_sk is not null""",
    "s_promotion": """
        select p_promo_sk as promotion_id, p_promo_id as promotion_code, p_promo_name as promotion_name,
               p_start_date_sk as start_date_sk, p_end_date_sk as end_date_sk, p_cost as promotion_cost,
               p_response_target as response_target, p_discount_active as is_discount_active,
               case 'Y' when p_channel_email then 'email' when p_channel_tv then 'tv' when p_channel_radio then 'radio'
                        when p_channel_direct_mail then 'direct_mail' when p_channel_event then 'event'
                        when p_channel_demo then 'demo' else 'other' end as channel_type
        from b_promotion where p_promo_sk is not null""",
    "s_clickstream": f"""
        select {_key("session_id", "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')")} as event_sk, session_id,
               user_id as customer_id, item_id, event_type, event_timestamp, device_type, referrer_source, _ingested_at
        from b_raw_clickstream
        where session_id is not null and event_timestamp is not null
          and event_type in ('page_view', 'add_to_cart', 'purchase')""",
}
