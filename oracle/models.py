"""Intermediate models and marts for DuckDB. Net sales are joined row by row here, unlike in the Spark code."""

MODELS = {
    "m_sales": """
        select *, 'store' as channel from (select * from s_store_sales)
        union all by name
        select * exclude (ship_address_id), 'web' as channel from s_web_sales
        union all by name
        select *, 'catalog' as channel from s_catalog_sales""",
    "m_returns": "select * from s_store_returns union all select * from s_web_returns",
    "m_unified_sales": """
        select sale_sk, channel, ticket_number, quantity_sold, gross_amount, gross_amount_inc_tax, net_profit,
               promotion_id, calendar_date as sale_date, calendar_year, month_of_year, fiscal_year, fiscal_quarter,
               is_holiday, is_weekend, i.item_id, item_description, category, item_class, brand, current_price,
               price_tier, c.customer_id, first_name, last_name,
               coalesce(st.state_code, ca.state_code) as state_code, coalesce(st.region, ca.region) as region
        from m_sales u
        join s_date_dim d using (date_sk)
        join s_item i on i.item_id = u.item_id
        left join s_store st on st.store_id = u.store_id
        left join s_customer c on c.customer_id = u.customer_id
        left join s_customer_address ca on ca.address_id = c.current_address_id""",
    "m_unified_returns": """
        select return_sk, return_channel, r.ticket_number, r.item_id, r.customer_id, quantity_returned, return_amount,
               net_loss, calendar_date as return_date, d.calendar_year as return_year, d.month_of_year as return_month,
               i.category, i.price_tier, s.promotion_id is not null as was_promoted
        from m_returns r
        left join m_unified_sales s on s.item_id = r.item_id and s.ticket_number = r.ticket_number
        left join s_item i on i.item_id = r.item_id
        left join s_date_dim d on d.date_sk = r.return_date_sk""",
    "m_net_sales": """
        select s.* exclude (gross_amount_inc_tax, net_profit), return_amount, quantity_returned,
               gross_amount - coalesce(return_amount, 0) as net_amount, return_amount is not null as was_returned
        from m_unified_sales s
        left join m_unified_returns r on r.item_id = s.item_id and r.ticket_number = s.ticket_number""",
    "m_item_daily_units": """
        select item_id, sale_date, cast(sum(quantity_sold) as bigint) as units_sold_that_day
        from m_unified_sales group by all""",
    "m_snapshots": """
        select inventory_sk, v.item_id, warehouse_id, quantity_on_hand, calendar_date as inv_date, calendar_year,
               month_of_year, category, price_tier, item_description,
               coalesce(u.units_sold_that_day, 0) as units_sold_that_day
        from s_inventory v
        join s_item i on i.item_id = v.item_id
        join s_date_dim d on d.date_sk = v.date_sk
        left join m_item_daily_units u on u.item_id = v.item_id and u.sale_date = d.calendar_date""",
    "m_inventory_daily": """
        select *, quantity_on_hand / nullif(avg_daily_sales_30d, 0) as days_of_supply
        from (select *, avg(units_sold_that_day) over (partition by item_id, warehouse_id
                            order by inv_date, inventory_sk, quantity_on_hand
                            rows between 29 preceding and current row) as avg_daily_sales_30d
              from m_snapshots)""",
    "m_daily_revenue": """
        select sale_date, channel, state_code, region, calendar_year, month_of_year, fiscal_year, fiscal_quarter,
               is_holiday, is_weekend, cast(sum(gross_amount) as double) as gross_revenue,
               cast(sum(coalesce(return_amount, 0)) as double) as total_return_amount,
               cast(sum(net_amount) as double) as net_revenue, count(*) as transaction_count,
               cast(sum(quantity_sold) as bigint) as total_units_sold, count(distinct customer_id) as unique_customers,
               count(distinct case when promotion_id is not null then 1 end) as promo_transaction_count,
               cast(sum(net_amount) as double) / count(*) as avg_order_value,
               cast(count(*) filter (was_returned) as double) / count(*) as return_rate
        from m_net_sales
        group by sale_date, channel, state_code, region, calendar_year, month_of_year, fiscal_year, fiscal_quarter,
                 is_holiday, is_weekend""",
    "m_sales_by_flag": """
        select item_id, promotion_id is not null as was_promoted, category, price_tier, item_description,
               cast(sum(quantity_sold) as bigint) as units_sold, cast(sum(gross_amount) as double) as gross_revenue,
               count(*) as transaction_count
        from m_unified_sales group by all""",
    "m_returns_by_flag": """
        select item_id, was_promoted, cast(sum(quantity_returned) as bigint) as units_returned,
               cast(sum(return_amount) as double) as gross_return_value, category, price_tier
        from m_unified_returns group by all""",
    "m_returns_analysis": """
        select s.item_id, item_description, s.category, s.price_tier, s.was_promoted, units_sold, gross_revenue,
               transaction_count, coalesce(units_returned, 0) as units_returned,
               coalesce(gross_return_value, 0) as gross_return_value,
               cast(round(cast(cast(coalesce(units_returned, 0) * 100 as double) / nullif(units_sold, 0)
                          as decimal(38,12)), 2) as double) as return_rate_pct
        from m_sales_by_flag s
        left join m_returns_by_flag r on r.item_id = s.item_id and r.was_promoted = s.was_promoted""",
    "m_inventory_health": """
        select item_id, item_description, category, price_tier, warehouse_id, inv_date as snapshot_date,
               quantity_on_hand, avg_daily_sales_30d, days_of_supply,
               case when days_of_supply is null or days_of_supply < 7 then 'HIGH'
                    when days_of_supply < 14 then 'MEDIUM' else 'LOW' end as stockout_risk_flag,
               case when days_of_supply is not null
                    then least(cast(round(cast(days_of_supply as decimal(38,12)), 1) as double), 999.0) end
                   as days_until_stockout
        from m_inventory_daily
        qualify row_number() over (partition by item_id, warehouse_id
                                   order by inv_date desc, inventory_sk desc, quantity_on_hand desc) = 1""",
    "m_totals": """
        select customer_id, state_code, region, cast(sum(net_amount) as double) as total_lifetime_spend,
               count(distinct ticket_number) as order_count, count(*) as transaction_count,
               min(sale_date) as first_order_date, max(sale_date) as last_order_date,
               date_diff('day', max(sale_date), date '2002-01-01') as days_since_last_order
        from m_net_sales where customer_id is not null group by customer_id, state_code, region""",
    "m_preferred": """
        select customer_id, channel as preferred_channel, cast(spend as double) as preferred_channel_spend
        from (select customer_id, channel, sum(net_amount) as spend from m_net_sales
              where customer_id is not null group by customer_id, channel)
        qualify row_number() over (partition by customer_id order by spend desc nulls first, channel) = 1""",
    "m_customer_ltv": """
        select t.customer_id, first_name, last_name, state_code, region, total_lifetime_spend, order_count,
               transaction_count, total_lifetime_spend / nullif(order_count, 0) as avg_order_value, first_order_date,
               last_order_date, days_since_last_order, preferred_channel,
               case when total_lifetime_spend >= 10000 then 'platinum' when total_lifetime_spend >= 5000 then 'gold'
                    when total_lifetime_spend >= 1000 then 'silver' else 'bronze' end as ltv_segment
        from m_totals t left join s_customer c using (customer_id) left join m_preferred p on p.customer_id = t.customer_id""",
    "m_windows": """
        select promotion_id, promotion_code, promotion_name, channel_type, is_discount_active,
               f.calendar_date as promo_start_date, l.calendar_date as promo_end_date,
               date_diff('day', f.calendar_date, l.calendar_date) as promo_duration_days,
               cast(f.calendar_date - interval 30 day as date) as baseline_start_date,
               cast(f.calendar_date - interval 1 day as date) as baseline_end_date
        from s_promotion p
        left join s_date_dim f on f.date_sk = p.start_date_sk
        left join s_date_dim l on l.date_sk = p.end_date_sk
        where start_date_sk is not null and end_date_sk is not null""",
    "m_promo_sales": """
        select promotion_id, count(*) as promo_transaction_count,
               cast(sum(gross_amount) as double) as promo_gross_revenue,
               cast(sum(net_amount) as double) as promo_net_revenue,
               cast(sum(coalesce(return_amount, 0)) as double) as promo_return_amount,
               cast(count(*) filter (was_returned) as double) / count(*) as promo_return_rate,
               count(distinct customer_id) as promo_unique_customers
        from m_net_sales join m_windows using (promotion_id)
        where sale_date >= promo_start_date and sale_date <= promo_end_date
        group by promotion_id""",
    "m_baseline": """
        select w.promotion_id, count(*) as baseline_transaction_count,
               cast(sum(gross_amount) as double) as baseline_gross_revenue,
               cast(sum(net_amount) as double) as baseline_net_revenue,
               cast(count(*) filter (was_returned) as double) / count(*) as baseline_return_rate
        from m_windows w
        join m_net_sales n on n.sale_date >= w.baseline_start_date and n.sale_date <= w.baseline_end_date
        where n.promotion_id is null
        group by w.promotion_id""",
    "m_promotion_effectiveness": """
        select promotion_id, promotion_code, promotion_name, channel_type, promo_start_date, promo_end_date,
               promo_duration_days, coalesce(promo_transaction_count, 0) as promo_transaction_count,
               coalesce(promo_gross_revenue, 0) as promo_gross_revenue,
               coalesce(promo_net_revenue, 0) as promo_net_revenue,
               coalesce(promo_return_rate, 0) as promo_return_rate,
               coalesce(promo_unique_customers, 0) as promo_unique_customers,
               coalesce(baseline_transaction_count, 0) as baseline_transaction_count,
               coalesce(baseline_net_revenue, 0) as baseline_net_revenue,
               coalesce(baseline_return_rate, 0) as baseline_return_rate,
               cast(round(cast(cast(
                   (cast(coalesce(promo_net_revenue, 0) as decimal(38,2)) - cast(coalesce(baseline_net_revenue, 0) as decimal(38,2))) * 100
                   as double) / nullif(coalesce(baseline_net_revenue, 0), 0) as decimal(38,12)), 2) as double)
                   as revenue_lift_pct,
               cast(round(cast(coalesce(promo_return_rate, 0) - coalesce(baseline_return_rate, 0) as decimal(38,12)), 4)
                   as double) as return_rate_delta
        from m_windows left join m_promo_sales using (promotion_id) left join m_baseline using (promotion_id)""",
    "m_customers": """
        select customer_id, customer_code, first_name, last_name, email, is_preferred_customer, address_code, city,
               state_code, zip_code, country, region
        from s_customer left join s_customer_address on address_id = current_address_id""",
}
