"""The raw, silver and gold tables as plain SQL, independent of the Spark code.

Each entry is one common table expression; `query` puts the needed ones in front of a final SELECT.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def define(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _needed(sql: str, seen: list[str]) -> None:
    for name in CTES:
        if name not in seen and re.search(rf"\b(from|join)\s+{name}\b", sql):
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def query(final: str) -> str:
    names: list[str] = []
    _needed(final, names)
    if not names:
        return final.strip()
    body = ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n]}\n)" for n in names)
    return f"WITH {body}\n{final.strip()}"


def half_up(amount: str, rows: str, places: int) -> str:
    """amount / rows in exact whole-number arithmetic, rounded half up; amount has two decimals at most."""
    scaled = f"(cast(({amount}) * 100 as hugeint) * {10 ** places})"
    whole = f"(cast({rows} as hugeint) * 100)"
    return (
        f"(case when ({rows}) = 0 then null else sign({scaled}) * "
        f"((2 * abs({scaled}) + {whole}) // (2 * {whole})) / {float(10 ** places)} end)"
    )


def half_up_pct(part: str, whole: str, places: int = 2) -> str:
    """100 * part / whole, both amounts with two decimals at most, rounded half up."""
    scaled = f"(cast(({part}) * 100 as hugeint) * 100 * {10 ** places})"
    cents = f"cast(({whole}) * 100 as hugeint)"
    return (
        f"(case when ({whole}) = 0 then null else sign({scaled}) * "
        f"((2 * abs({scaled}) + {cents}) // (2 * {cents})) / {float(10 ** places)} end)"
    )


# State codes, region and state names, installment buckets and segment names below.
_STATES = "['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','XX']"


def region_case(column: str, otherwise: str = "'Unknown'") -> str:
    return f"""case when {column} in ('SP','RJ','MG','ES') then 'Southeast'
      when {column} in ('RS','SC','PR') then 'South'
      when {column} in ('BA','PE','CE','MA','PB','RN','AL','SE','PI') then 'Northeast'
      when {column} in ('AM','PA','RO','AC','AP','RR','TO') then 'North'
      when {column} in ('DF','GO','MT','MS') then 'Central-West'
      else {otherwise} end"""


def state_name_case(column: str) -> str:
    names = {
        "AC": "Acre", "AL": "Alagoas", "AM": "Amazonas", "AP": "Amapa", "BA": "Bahia", "CE": "Ceara",
        "DF": "Distrito Federal", "ES": "Espirito Santo", "GO": "Goias", "MA": "Maranhao",
        "MG": "Minas Gerais", "MS": "Mato Grosso do Sul", "MT": "Mato Grosso", "PA": "Para",
        "PB": "Paraiba", "PE": "Pernambuco", "PI": "Piaui", "PR": "Parana", "RJ": "Rio de Janeiro",
        "RN": "Rio Grande do Norte", "RO": "Rondonia", "RR": "Roraima", "RS": "Rio Grande do Sul",
        "SC": "Santa Catarina", "SE": "Sergipe", "SP": "Sao Paulo", "TO": "Tocantins",
    }
    branches = " ".join(f"when '{code}' then '{name}'" for code, name in names.items())
    return f"case {column} {branches} end"


def key_sql(*columns: str) -> str:
    parts = " || '-' || ".join(
        f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns
    )
    return f"md5({parts})"


# ---- raw tables -------------------------------------------------------------------------------

define("base_orders", """
select k, p, copy,
  case when k % 211 = 0 then null when s = 'F' then 'delivered' when s = 'O' then 'shipped'
       else (['canceled','unavailable','created','invoiced','processing'])[cast(k % 5 as integer) + 1] end as status
from (select o_orderkey as k, o_orderstatus as s,
        o_orderdate + to_seconds(cast(o_orderkey * 7919 % 86400 as integer)) as p,
        unnest(case when o_orderkey % 50 = 0 then [0, 1] else [0] end) as copy
      from orders)
""")

define("raw_orders", """
select cast(k as varchar) as order_id, 'c' || k as customer_id, status as order_status,
  cast(p + to_days(cast(copy as integer)) as varchar) as order_purchase_timestamp,
  case when status = 'created' then null when k % 101 = 0 then 'n/a'
       else cast(p + to_hours(cast(k % 48 as integer)) as varchar) end as order_approved_at,
  case when status in ('delivered','shipped') then cast(p + to_days(cast(1 + k % 5 as integer)) as varchar) end
    as order_delivered_carrier_date,
  case when status = 'delivered' and k % 97 <> 0
       then cast(p + to_days(cast(4 * abs(month(p) - 6) + k * 31 % 11 as integer)) + to_seconds(cast(k * 613 % 86400 as integer)) as varchar) end
    as order_delivered_customer_date,
  cast(cast(cast(p as date) as timestamp) + to_days(cast(10 + k * 17 % 30 as integer)) as varchar)
    as order_estimated_delivery_date
from base_orders
""")

define("raw_customers", f"""
select 'c' || o_orderkey as customer_id, cast(o_custkey as varchar) as customer_unique_id,
  lpad(cast(o_custkey % 300 as varchar), 5, '0') as customer_zip_code_prefix,
  case when copy = 1 then ' Other ' else '  City ' || (o_custkey % 40) || ' ' end as customer_city,
  ({_STATES})[c_nationkey + 1] as customer_state
from (select *, unnest(case when o_orderkey % 70 = 0 then [0, 1] else [0] end) as copy from orders)
join customer on o_custkey = c_custkey
""")

define("raw_sellers", f"""
select cast(s_suppkey as varchar) as seller_id, lpad(cast(s_suppkey % 300 as varchar), 5, '0') as seller_zip_code_prefix,
  case when copy = 1 then ' Twin ' else ' Town ' || (s_suppkey % 12) end as seller_city,
  ({_STATES})[s_nationkey + 1] as seller_state
from (select *, unnest(case when s_suppkey % 9 = 0 then [0, 1] else [0] end) as copy from supplier)
""")

define("base_items", """
select *, cast(l_extendedprice as decimal(18,2)) as price,
  cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)), 2) as decimal(18,2)) as freight_value
from lineitem
""")

define("raw_items", """
select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as bigint) as order_item_id,
  case when (l_partkey + l_linenumber) % 41 = 0 then null else cast(l_partkey as varchar) end as product_id,
  cast(l_suppkey as varchar) as seller_id, cast(l_shipdate as varchar) as shipping_limit_date, price, freight_value
from base_items
""")

define("raw_payments", """
select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as bigint) as payment_sequential,
  case when l_partkey % 29 = 0 then null when l_returnflag = 'A' then 'credit_card' when l_returnflag = 'N' then 'boleto'
       when l_linestatus = 'F' then 'voucher' else 'debit_card' end as payment_type,
  case when l_partkey % 31 = 0 then null else cast(l_quantity as bigint) % 15 end as payment_installments,
  cast(case when l_discount <> 0 then price + freight_value when l_partkey % 7 = 0 then -price else 0 end as decimal(18,2)) as payment_value
from base_items
""")

define("raw_reviews", """
select 'r' || l_orderkey || '-' || (l_partkey % 2) as review_id, cast(l_orderkey as varchar) as order_id,
  cast(1 + l_partkey % 5 as varchar) as review_score,
  case when l_suppkey % 2 = 0 then null else 'title' end as review_comment_title,
  case when l_suppkey % 3 = 0 then null else 'msg ' || l_partkey end as review_comment_message,
  cast(l_shipdate as varchar) as review_creation_date,
  case when l_suppkey % 13 = 0 then null else cast(l_shipdate + to_days(l_linenumber) as varchar) end as review_answer_timestamp
from base_items
""")

define("raw_products", """
select cast(p_partkey as varchar) as product_id,
  case when p_partkey % 23 = 0 then null else ' ' || p_type || '_' || p_brand || ' ' end as product_category_name,
  case when p_partkey % 7 = 0 then null else cast(length(p_name) as bigint) end as product_name_lenght,
  case when p_partkey % 7 = 0 then null else cast(p_size * 10 as bigint) end as product_description_lenght,
  case when p_partkey % 6 = 0 or copy = 1 then null else cast(p_partkey % 6 as bigint) end as product_photos_qty,
  case when p_partkey % 31 = 0 then null else cast(p_size * 100 as double) end as product_weight_g,
  cast(10 + p_size as double) as product_length_cm, cast(2 + p_partkey % 20 as double) as product_height_cm,
  cast(6 + p_partkey % 15 as double) as product_width_cm
from (select *, unnest(case when p_partkey % 120 = 0 then [0, 1, 2] when p_partkey % 40 = 0 then [0, 1]
        when p_partkey % 60 = 0 then [0, 2] else [0] end) as copy from part)
""")

define("raw_geolocation", f"""
select lpad(cast(c_custkey % 250 as varchar), 5, '0') as geolocation_zip_code_prefix,
  -30 + cast(c_custkey * 37 % 3500 as double) / 100 as geolocation_lat,
  -70 + cast(c_custkey * 53 % 3500 as double) / 100 as geolocation_lng,
  'city ' || (c_custkey % 40) as geolocation_city, ({_STATES})[c_nationkey + 1] as geolocation_state
from customer
""")

define("raw_translation", """
select distinct lower(p_type || '_' || p_brand) as product_category_name,
  'en ' || lower(p_type || '_' || p_brand) as product_category_name_english
from part
""")

# ---- silver -----------------------------------------------------------------------------------

define("typed_orders", """
select order_id, customer_id, order_status,
  try_cast(order_purchase_timestamp as timestamp) as order_purchase_timestamp,
  try_cast(order_approved_at as timestamp) as order_approved_at,
  try_cast(order_delivered_carrier_date as timestamp) as order_delivered_carrier_date,
  try_cast(order_delivered_customer_date as timestamp) as order_delivered_customer_date,
  try_cast(order_estimated_delivery_date as timestamp) as order_estimated_delivery_date
from raw_orders
""")

define("silver_orders", """
select * exclude (rn) from (
  select *,
    datediff('day', order_purchase_timestamp, order_delivered_customer_date) as delivery_days,
    datediff('day', order_purchase_timestamp, order_estimated_delivery_date) as estimated_delivery_days,
    order_delivered_customer_date > order_estimated_delivery_date as is_late,
    case when order_delivered_customer_date > order_estimated_delivery_date
         then datediff('day', order_estimated_delivery_date, order_delivered_customer_date) else 0 end as delivery_delay_days,
    year(order_purchase_timestamp) as order_year, month(order_purchase_timestamp) as order_month,
    dayofweek(order_purchase_timestamp) + 1 as order_day_of_week,
    row_number() over (partition by order_id order by order_purchase_timestamp asc nulls last,
      order_approved_at asc nulls last, order_delivered_customer_date asc nulls last, order_status asc nulls last) as rn
  from typed_orders where order_status not in ('unavailable', 'created')
) where rn = 1
""")

define("silver_customers", """
select * exclude (rn) from (
  select customer_id, customer_unique_id, customer_zip_code_prefix, lower(trim(customer_city)) as customer_city, customer_state,
    row_number() over (partition by customer_id order by customer_unique_id nulls last, customer_zip_code_prefix nulls last,
      lower(trim(customer_city)) nulls last, customer_state nulls last) as rn
  from raw_customers) where rn = 1
""")

define("silver_sellers", """
select * exclude (rn) from (
  select seller_id, seller_zip_code_prefix, lower(trim(seller_city)) as seller_city, seller_state,
    row_number() over (partition by seller_id order by seller_zip_code_prefix nulls last, lower(trim(seller_city)) nulls last,
      seller_state nulls last) as rn
  from raw_sellers) where rn = 1
""")

define("clean_products", """
select product_id, lower(trim(product_category_name)) as product_category_name,
  coalesce(product_name_lenght, 0) as product_name_lenght,
  coalesce(product_description_lenght, 0) as product_description_lenght,
  coalesce(product_photos_qty, 0) as product_photos_qty,
  product_weight_g, product_length_cm, product_height_cm, product_width_cm,
  product_length_cm * product_height_cm * product_width_cm as product_volume_cm3
from raw_products
""")

define("silver_products", """
select * exclude (rn) from (
  select *, row_number() over (partition by product_id order by product_category_name nulls last, product_name_lenght,
      product_description_lenght, product_photos_qty, product_weight_g nulls last, product_length_cm, product_height_cm,
      product_width_cm) as rn
  from clean_products) where rn = 1
""")

define("payment_types", """
select order_id, payment_type, sum(payment_value) as type_total
from raw_payments where payment_value > 0 group by order_id, payment_type
""")

define("silver_payments", """
select t.order_id, t.total_payment, t.num_installments, p.payment_type as primary_payment_type
from (select order_id, sum(payment_value) as total_payment, max(payment_installments) as num_installments
      from raw_payments where payment_value > 0 group by order_id) t
left join (select *, row_number() over (partition by order_id order by type_total desc, payment_type asc nulls first) as rn
           from payment_types) p on p.order_id = t.order_id and p.rn = 1
""")

define("typed_reviews", """
select review_id, order_id, try_cast(review_score as bigint) as review_score,
  coalesce(review_comment_title, '') as review_comment_title, coalesce(review_comment_message, '') as review_comment_message,
  try_cast(review_creation_date as timestamp) as review_creation_date,
  try_cast(review_answer_timestamp as timestamp) as review_answer_timestamp
from raw_reviews
""")

define("silver_reviews", """
select * exclude (rn, rm) from (
  select *, row_number() over (partition by order_id order by review_answer_timestamp desc nulls last,
      review_creation_date desc nulls last, review_id) as rm
  from (select *, row_number() over (partition by review_id order by review_answer_timestamp desc nulls last,
          review_creation_date desc nulls last, order_id, review_score desc nulls last, review_comment_message,
          review_comment_title) as rn
        from typed_reviews) where rn = 1
) where rm = 1
""")

# ---- gold -------------------------------------------------------------------------------------

define("dim_customers", f"""
select {key_sql('customer_id')} as customer_key, customer_id, customer_unique_id, customer_city, customer_state,
  {region_case('customer_state')} as customer_region
from silver_customers
""")

define("dim_sellers", f"""
select {key_sql('seller_id')} as seller_key, seller_id, seller_city, seller_state,
  {region_case('seller_state')} as seller_region
from silver_sellers
""")

define("dim_products", f"""
select {key_sql('product_id')} as product_key, product_id, coalesce(product_category_name, 'unknown') as product_category,
  product_name_lenght as name_length, product_description_lenght as description_length, product_photos_qty as photos_qty,
  product_weight_g as weight_g, product_length_cm as length_cm, product_height_cm as height_cm,
  product_width_cm as width_cm, product_volume_cm3 as volume_cm3
from silver_products
""")

define("dim_payment", f"""
select {key_sql('payment_type', 'installments')} as payment_key, payment_type, installments,
  case when installments = 1 then '1 (cash)' when installments between 2 and 3 then '2-3'
       when installments between 4 and 6 then '4-6' when installments between 7 and 12 then '7-12'
       when installments > 12 then '12+' else 'unknown' end as installments_bucket
from (select distinct primary_payment_type as payment_type, num_installments as installments
      from silver_payments where primary_payment_type is not null)
""")

define("dim_dates", """
select full_date, cast(strftime(full_date, '%Y%m%d') as bigint) as date_key,
  year(full_date) as year, month(full_date) as month, day(full_date) as day, quarter(full_date) as quarter,
  dayofweek(full_date) as day_of_week, isodow(full_date) as day_of_week_iso,
  strftime(full_date, '%A') as day_name, strftime(full_date, '%B') as month_name,
  dayofweek(full_date) in (0, 6) as is_weekend,
  year(full_date) || '-Q' || quarter(full_date) as year_quarter, strftime(full_date, '%Y-%m') as year_month
from (select cast(unnest(generate_series(cast(min(order_purchase_timestamp) as date), cast(max(order_purchase_timestamp) as date),
        interval 1 day)) as date) as full_date from silver_orders)
""")

# what payments and reviews add, as one row per order, before orders are looked at
define("order_additions", """
select order_id, max(total_payment) as payment_amount, max(num_installments) as installments,
  max(primary_payment_type) as payment_type, max(review_score) as review_score, max(review_id) as review_id,
  max(review_creation_date) as review_created_at, max(review_answer_timestamp) as review_answered_at
from (select order_id, total_payment, num_installments, primary_payment_type, null as review_score, null as review_id,
        null as review_creation_date, null as review_answer_timestamp from silver_payments
      union all by name
      select order_id, review_score, review_id, review_creation_date, review_answer_timestamp from silver_reviews)
where order_id is not null group by order_id
""")

define("orders_enriched", """
select order_id, customer_id, order_status, delivery_days, estimated_delivery_days, is_late, delivery_delay_days,
  order_year, order_month, order_day_of_week, order_purchase_timestamp as purchased_at, order_approved_at as approved_at,
  order_delivered_carrier_date as shipped_at, order_delivered_customer_date as delivered_at,
  order_estimated_delivery_date as estimated_delivery_at, columns(added.* exclude (order_id))
from silver_orders left join order_additions as added using (order_id)
""")

# keys are hashes of what they stand for, so they need no join: only whether the dimension has the row
define("fact_orders", f"""
select {key_sql('order_id')} as order_key, order_id,
  case when customer_id in (select customer_id from silver_customers) then {key_sql('customer_id')} end as customer_key,
  case when (payment_type, coalesce(installments, 1)) in (select (payment_type, installments) from dim_payment)
       then {key_sql('payment_type', 'coalesce(installments, 1)')} end as payment_key,
  10000 * year(purchased_at) + 100 * month(purchased_at) + day(purchased_at) as date_key, order_status,
  ifnull(payment_amount, 0) as payment_amount, installments, payment_type, delivery_days, estimated_delivery_days,
  ifnull(is_late, false) as is_late, ifnull(delivery_delay_days, 0) as delivery_delay_days, review_score,
  purchased_at, approved_at, shipped_at, delivered_at, estimated_delivery_at, order_year, order_month, order_day_of_week
from orders_enriched
""")

define("product_facts", """
select product_id, product_category_name as product_category, product_name_lenght as name_length,
  product_description_lenght as description_length, product_photos_qty as photos_qty, product_weight_g as weight_g,
  product_volume_cm3 as volume_cm3 from silver_products
""")

define("seller_places", "select seller_id, seller_city, seller_state from silver_sellers")

define("items_enriched", """
select columns(* exclude (shipping_limit_date)), price + freight_value as total_item_value,
  try_cast(shipping_limit_date as timestamp) as shipping_limit_date
from raw_items left join product_facts using (product_id) left join seller_places using (seller_id)
""")

# ---- wide order table -------------------------------------------------------------------------

define("first_items", """
select order_id, {picks} from raw_items where order_id is not null group by order_id
""".replace("{picks}", ", ".join(
    f"first({c} order by order_item_id nulls last, product_id nulls first, seller_id nulls first, price, freight_value) "
    f"filter ({c} is not null) as {c}" for c in ["product_id", "seller_id", "price", "freight_value"]
)))

define("enriched", """
select o.*, p.total_payment, p.num_installments, p.primary_payment_type, r.review_score, f.product_id, f.seller_id,
  f.price, f.freight_value, c.customer_state, s.seller_state, d.product_weight_g, d.product_volume_cm3, d.product_photos_qty,
  cast(r.review_score >= 4 and r.review_score is not null as bigint) as is_good_review
from silver_orders o
left join silver_payments p on p.order_id = o.order_id
left join silver_reviews r on r.order_id = o.order_id
left join first_items f on f.order_id = o.order_id
left join silver_customers c on c.customer_id = o.customer_id
left join silver_sellers s on s.seller_id = f.seller_id
left join silver_products d on d.product_id = f.product_id
""")

define("bought", "select * from enriched where order_purchase_timestamp is not null")

define("overview", """
select * from bought
where order_purchase_timestamp >= (select min(cast(order_purchase_timestamp as date)) from bought)
  and order_purchase_timestamp <= (select cast(max(cast(order_purchase_timestamp as date)) as timestamp) from bought)
  and order_status = 'delivered'
""")

define("delivered", "select * from bought where order_status = 'delivered'")

define("sold", "select * from enriched where order_status = 'delivered' and seller_id is not null and seller_state is not null")

define("points", """
select order_id, delivery_days, review_score, total_payment from delivered
where delivery_days is not null and review_score is not null and total_payment is not null and delivery_days <= 60
""")

define("board", f"""
select seller_id, count(order_id) as order_count, coalesce(sum(total_payment), 0) as revenue,
  sum(delivery_days) as days, count(delivery_days) as days_n, sum(review_score) as score, count(review_score) as score_n,
  sum(delivery_days) / count(delivery_days) as avg_delivery_days, sum(review_score) / count(review_score) as avg_review_score,
  min(seller_state) as seller_state, {region_case('min(seller_state)', 'null')} as region
from sold group by seller_id having count(order_id) >= 10
""")

# ---- reports ----------------------------------------------------------------------------------

define("revenue_fact", "select * from fact_orders where order_status not in ('canceled', 'unavailable')")

define("monthly_base", f"""
select cast(date_trunc('month', purchased_at) as date) as period_start, count(distinct order_id) as order_count,
  count(distinct customer_key) as unique_customers, sum(payment_amount) as gmv,
  {half_up('sum(payment_amount)', 'count(payment_amount)', 2)} as avg_order_value,
  {half_up('sum(review_score)', 'count(review_score)', 2)} as avg_review_score,
  {half_up('sum(case when is_late then 1 else 0 end) * 100', 'count(*)', 1)} as late_delivery_pct
from revenue_fact where purchased_at is not null group by 1
""")

define("growth", f"""
select *, {half_up_pct('gmv - prev_month_gmv', 'prev_month_gmv')} as mom_gmv_growth_pct,
  {half_up('sum3', 'n3', 2)} as rolling_3m_avg_gmv
from (select *, lag(gmv) over (order by period_start) as prev_month_gmv,
        lag(order_count) over (order by period_start) as prev_month_orders,
        sum(gmv) over (order by period_start rows between 2 preceding and current row) as sum3,
        count(gmv) over (order by period_start rows between 2 preceding and current row) as n3
      from monthly_base)
""")

define("by_state", f"""
select customer_state, customer_region, order_count, total_gmv,
  {half_up('total_gmv', 'order_count', 2)} as avg_order_value,
  {half_up_pct('total_gmv', '(select sum(payment_amount) from revenue_fact f join dim_customers c on f.customer_key = c.customer_key)')} as gmv_share_pct
from (select c.customer_state, c.customer_region, count(distinct o.order_id) as order_count, sum(o.payment_amount) as total_gmv
      from revenue_fact o join dim_customers c on o.customer_key = c.customer_key group by 1, 2)
""")

# sums by customer key first; several keys can belong to one person
define("key_sums", """
select customer_key, max(purchased_at) as latest, count(*) as orders, sum(payment_amount) as paid
from revenue_fact where payment_amount > 0 and purchased_at is not null group by customer_key
""")

define("rfm_raw", """
select customer_unique_id, max(latest) as last_purchase, cast(sum(orders) as bigint) as frequency, sum(paid) as monetary
from dim_customers join key_sums using (customer_key) group by customer_unique_id
""")

define("rfm_days", """
select customer_unique_id, datediff('day', last_purchase, (select max(last_purchase) from rfm_raw)) as recency_days,
  frequency, monetary from rfm_raw
""")

define("rfm_scored", """
select *, ntile(5) over (order by recency_days desc, customer_unique_id) as r_score,
  ntile(5) over (order by frequency, customer_unique_id) as f_score,
  ntile(5) over (order by monetary, customer_unique_id) as m_score
from rfm_days
""")

# Segment names with the least and greatest score of each kind; the first that fits counts.
define("segment_rules", """
select * from (values
  (1, 'Champions', 4, 5, 4, 5, 4, 5), (2, 'Loyal Customers', 1, 5, 3, 5, 3, 5), (3, 'Recent Customers', 4, 5, 1, 2, 1, 5),
  (4, 'Potential Loyalists', 3, 5, 2, 5, 2, 5), (5, 'At Risk', 1, 2, 3, 5, 3, 5), (6, 'Cannot Lose Them', 1, 2, 4, 5, 1, 5),
  (7, 'Needs Attention', 2, 3, 1, 2, 1, 5), (8, 'Lost', 1, 2, 1, 2, 1, 2), (9, 'Other', 1, 5, 1, 5, 1, 5)
) as rules(turn, name, r_low, r_high, f_low, f_high, m_low, m_high)
""")

define("rfm_full", """
select customer_unique_id, any_value(columns(scored.* exclude (customer_unique_id))),
  any_value(concat(r_score, f_score, m_score)) as rfm_cell, any_value(r_score + f_score + m_score) as rfm_total,
  arg_min(name, turn) as segment_name
from rfm_scored as scored join segment_rules
  on r_score between r_low and r_high and f_score between f_low and f_high and m_score between m_low and m_high
group by customer_unique_id
""")

define("rfm_summary", f"""
select segment_name, count(*) as customer_count, {half_up('sum(recency_days)', 'count(*)', 1)} as avg_recency_days,
  {half_up('sum(frequency)', 'count(*)', 2)} as avg_frequency, {half_up('sum(monetary)', 'count(*)', 2)} as avg_monetary,
  cast(sum(monetary) as double) as total_monetary,
  {half_up_pct('count(*)', '(select count(*) from rfm_full)')} as pct_of_customers
from rfm_full group by segment_name
""")

# all months in which a person bought; the least of them is the cohort
define("months_bought", """
select customer_unique_id, list(distinct cast(date_trunc('month', purchased_at) as date)) as months
from dim_customers join revenue_fact using (customer_key) where purchased_at is not null group by customer_unique_id
""")

define("first_purchase", "select customer_unique_id, list_min(months) as cohort_month from months_bought")

define("activity", """
select customer_unique_id, unnest(months) as order_month, list_min(months) as cohort_month from months_bought
""")

define("cohort_counts", """
select cohort_month, datediff('month', cohort_month, order_month) as months_since_first_order,
  count(distinct customer_unique_id) as active_customers
from activity group by 1, 2
""")

define("retention", f"""
select strftime(n.cohort_month, '%Y-%m') as cohort_label, s.active_customers as cohort_size, n.months_since_first_order,
  n.active_customers, {half_up_pct('n.active_customers', 's.active_customers')} as retention_rate_pct
from cohort_counts n join cohort_counts s on n.cohort_month = s.cohort_month and s.months_since_first_order = 0
""")

# lines, money and freight by seller and order; each order then counts with its lines
define("seller_orders", """
select seller_id, order_id, count(*) as lines, count(price) as priced, sum(price) as revenue, sum(freight_value) as freight
from raw_items where seller_id is not null group by all
""")

define("seller_sums", """
select seller_id, count(*) as orders, sum(priced) as priced, sum(revenue) as revenue, sum(freight) as freight,
  sum(lines * review_score) as score, coalesce(sum(lines) filter (review_score is not null), 0) as scored,
  sum(lines * delivery_days) as days, coalesce(sum(lines) filter (delivery_days is not null), 0) as timed,
  coalesce(sum(lines) filter (is_late), 0) as late_lines, count(*) filter (is_late) as late
from seller_orders join revenue_fact using (order_id) group by seller_id
""")

define("seller_totals", f"""
select seller_id, seller_city, seller_state, seller_region, orders as total_orders, revenue as total_revenue,
  {half_up('revenue', 'priced', 2)} as avg_item_price, freight as total_freight,
  {half_up('score', 'scored', 2)} as avg_review_score, cast(scored as bigint) as review_count,
  {half_up('days', 'timed', 1)} as avg_delivery_days, cast(late_lines as bigint) as late_orders, late as late_by_order,
  {half_up('(orders - late_lines) * 100', 'orders', 2)} as on_time_rate_pct,
  {half_up('(orders - late) * 100', 'orders', 2)} as on_time_by_order
from seller_sums join dim_sellers using (seller_id)
""")

define("seller_scores", """
select *, round(coalesce(avg_review_score, 0) * 8 + coalesce(on_time_rate_pct, 0) * 0.4
    + ln(total_orders + 1) / nullif(ln((select max(total_orders) from seller_totals) + 1), 0) * 20, 2) as reliability_score
from seller_totals
""")

def place(measure: str, *, dense: bool = False) -> str:
    """Rank in falling order by counting greater values; missing ones come first."""
    greater = f"{'distinct ' if dense else ''}other.{measure}"
    missing = "least(count(*) filter (other.{0} is null), 1)" if dense else "count(*) filter (other.{0} is null)"
    return (
        f"(select case when mine.{measure} is null then 1 else 1 + count({greater}) filter (other.{measure} > mine.{measure}) "
        f"+ {missing.format(measure)} end from seller_scores as other)"
    )


define("seller_card", f"""
select mine.*, {place('total_revenue')} as revenue_rank, {place('total_orders')} as volume_rank,
  {place('avg_review_score', dense=True)} as review_rank, {place('on_time_rate_pct')} as ontime_rank,
  {place('reliability_score')} as reliability_rank
from seller_scores as mine
""")

define("seller_state_summary", f"""
select *, rank() over (order by round(mean_review, 9) desc nulls first) as state_review_rank
from (select seller_state, seller_region, count(distinct seller_id) as seller_count,
        {half_up('sum(cast(avg_review_score as decimal(18,2)))', 'count(avg_review_score)', 2)} as state_avg_review,
        {half_up('sum(cast(on_time_rate_pct as decimal(18,2)))', 'count(on_time_rate_pct)', 2)} as state_ontime_pct,
        cast(sum(total_revenue) as double) as state_total_revenue, avg(avg_review_score) as mean_review
      from seller_scores group by 1, 2)
""")

define("customer_states", f"""
select customer_state, count(order_id) as order_count, coalesce(sum(total_payment), 0) as revenue,
  sum(review_score) / count(review_score) as avg_review_score, sum(delivery_days) / count(delivery_days) as avg_delivery_days,
  sum(review_score) as score, count(review_score) as score_n, sum(delivery_days) as days, count(delivery_days) as days_n,
  {state_name_case('customer_state')} as state_name, {region_case('customer_state', 'null')} as region
from bought where customer_state is not null group by customer_state
""")

define("seller_states", """
select seller_state, count(order_id) as order_count, coalesce(sum(total_payment), 0) as revenue,
  sum(delivery_days) / count(delivery_days) as avg_delivery_days
from bought where seller_state is not null group by seller_state
""")

define("heat", """
select customer_state, seller_state, sum(delivery_days) / count(delivery_days) as avg_delivery_days from bought
where customer_state in (select customer_state from customer_states order by order_count desc, customer_state limit 10)
  and seller_state in (select seller_state from seller_states order by order_count desc, seller_state limit 10)
group by 1, 2
""")

define("busy_sellers", """
select seller_state, row_number() over (order by order_count desc, seller_state) as place
from seller_states where seller_state in (select seller_state from heat)
""")

define("page_rfm_raw", """
select customer_id, max(order_purchase_timestamp) as last_order, count(distinct order_id) as frequency,
  coalesce(sum(total_payment), 0) as monetary
from delivered where customer_id is not null group by 1
""")

define("page_rfm_days", """
select customer_id, floor((epoch((select max(last_order) from page_rfm_raw)) - epoch(last_order) + 86400) / 86400) as recency,
  frequency, monetary from page_rfm_raw
""")

define("page_rfm_pct", """
select *, (rank() over (order by recency) + (count(*) over (partition by recency) - 1) / 2) / count(*) over () as r,
  (rank() over (order by frequency) + (count(*) over (partition by frequency) - 1) / 2) / count(*) over () as f,
  (rank() over (order by monetary) + (count(*) over (partition by monetary) - 1) / 2) / count(*) over () as m
from page_rfm_days
""")

define("page_rfm", """
select *, recency_score + frequency_score + monetary_score as rfm_score,
  case when recency_score + frequency_score + monetary_score >= 10 then 'Champions'
       when recency_score + frequency_score + monetary_score >= 7 then 'Loyal'
       when recency_score + frequency_score + monetary_score >= 5 then 'At Risk' else 'Lost' end as segment
from (select customer_id, cast(recency as bigint) as recency, frequency, monetary,
        cast(5 - case when r <= 0.25 then 1 when r <= 0.5 then 2 when r <= 0.75 then 3 else 4 end as bigint) as recency_score,
        cast(case when f <= 0.25 then 1 when f <= 0.5 then 2 when f <= 0.75 then 3 else 4 end as bigint) as frequency_score,
        cast(case when m <= 0.25 then 1 when m <= 0.5 then 2 when m <= 0.75 then 3 else 4 end as bigint) as monetary_score
      from page_rfm_pct)
""")

# ---- features ---------------------------------------------------------------------------------

define("centroids", """
select geolocation_zip_code_prefix as zip_prefix, median(geolocation_lat) as lat, median(geolocation_lng) as lng
from raw_geolocation group by 1
""")

define("item_totals", """
select order_id, count(order_item_id) as item_count, sum(price) as total_price, sum(freight_value) as total_freight
from raw_items where order_id is not null group by 1
""")

define("wide", """
select e.*, r.review_comment_message, r.review_comment_title, c.customer_zip_code_prefix, s.seller_zip_code_prefix,
  d.product_category_name, t.item_count, t.total_price, t.total_freight,
  cz.lat as cust_lat, cz.lng as cust_lng, sz.lat as sell_lat, sz.lng as sell_lng
from enriched e
left join silver_reviews r on r.order_id = e.order_id
left join silver_customers c on c.customer_id = e.customer_id
left join silver_sellers s on s.seller_id = e.seller_id
left join silver_products d on d.product_id = e.product_id
left join item_totals t on t.order_id = e.order_id
left join centroids cz on cz.zip_prefix = c.customer_zip_code_prefix
left join centroids sz on sz.zip_prefix = s.seller_zip_code_prefix
""")

define("frequent_categories", """
select product_category_name from wide where product_category_name is not null
group by 1 order by count(*) desc, product_category_name limit 20
""")

HAVERSINE = (
    "2 * 6371.0 * asin(sqrt(least(greatest(power(sin((radians(sell_lat) - radians(cust_lat)) / 2), 2) + cos(radians(cust_lat)) "
    "* cos(radians(sell_lat)) * power(sin((radians(sell_lng) - radians(cust_lng)) / 2), 2), 0), 1)))"
)


def half_even(amount: str, rows: str, places: int) -> str:
    """amount / rows for amounts >= 0 in whole-number arithmetic, ties to the even neighbour."""
    scaled = f"(cast(({amount}) * 100 as hugeint) * {10 ** places})"
    whole = f"(cast({rows} as hugeint) * 100)"
    floor, twice = f"({scaled} // {whole})", f"(2 * ({scaled} % {whole}))"
    up = f"(case when {twice} > {whole} or ({twice} = {whole} and {floor} % 2 = 1) then 1 else 0 end)"
    return f"(case when ({rows}) = 0 then null else ({floor} + {up}) / {float(10 ** places)} end)"


def half_even_ratio(part: str, whole: str, places: int) -> str:
    """part / whole for two amounts with two decimals, ties to the even neighbour."""
    scaled = f"(cast(({part}) * 100 as hugeint) * {10 ** places})"
    cents = f"cast(({whole}) * 100 as hugeint)"
    floor, twice = f"({scaled} // {cents})", f"(2 * ({scaled} % {cents}))"
    up = f"(case when {twice} > {cents} or ({twice} = {cents} and {floor} % 2 = 1) then 1 else 0 end)"
    return f"(case when ({whole}) = 0 then null else ({floor} + {up}) / {float(10 ** places)} end)"


define("features", f"""
select *, case when product_category_name in (select product_category_name from frequent_categories)
    then product_category_name else 'other' end as product_category,
  {half_even_ratio('total_freight', 'total_price + total_freight', 4)} as freight_ratio,
  case when cust_lat is not null and sell_lat is not null then {HAVERSINE} end as distance_km,
  length(coalesce(review_comment_message, '')) + length(coalesce(review_comment_title, '')) as comment_length,
  cast(length(coalesce(review_comment_message, '')) + length(coalesce(review_comment_title, '')) > 0 as bigint) as has_comment,
  case when seller_id is not null then avg(delivery_days) over earlier end as seller_avg_delivery,
  case when seller_id is not null then avg(review_score) over earlier end as seller_avg_review
from wide
window earlier as (partition by seller_id order by order_purchase_timestamp nulls last, order_id
  rows between unbounded preceding and 1 preceding)
""")

define("delivery_training", "select * from features where delivery_days is not null and order_status = 'delivered'")

define("review_training", """
select *, cast(coalesce(is_late, false) as bigint) as is_late_int, cast(review_score >= 4 as bigint) as label
from features where review_score is not null
""")

define("day_predictions", """
select order_id, cast(delivery_days as double) as label, cast(10 + cast(order_id as bigint) % 20 as double) as prediction
from silver_orders where order_status = 'delivered' and delivery_days is not null
""")

define("class_predictions", """
select order_id, cast(review_score >= 4 as bigint) as label, cast(delivery_delay_days = 0 as bigint) as prediction
from enriched where review_score is not null
""")
