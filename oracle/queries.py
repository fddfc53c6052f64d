"""The expected result of every query that plain SQL can express."""

from __future__ import annotations

from oracle.tables import (
    half_even, half_even_ratio, half_up, key_sql, query, region_case, state_name_case,
)

_RAW = {
    "orders": "raw_orders", "customers": "raw_customers", "order_items": "raw_items", "order_payments": "raw_payments",
    "order_reviews": "raw_reviews", "products": "raw_products", "sellers": "raw_sellers",
    "geolocation": "raw_geolocation", "category_translation": "raw_translation",
}
_SILVER = {
    "orders": "silver_orders", "products": "silver_products", "customers": "silver_customers",
    "sellers": "silver_sellers", "payments": "silver_payments", "reviews": "silver_reviews", "items": "raw_items",
}
_SOURCE_OF = {
    "orders": "raw_orders", "products": "raw_products", "customers": "raw_customers", "sellers": "raw_sellers",
    "payments": "raw_payments", "reviews": "raw_reviews", "items": "raw_items",
}


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as \"table\", count(*) as rows from {t}" for n, t in tables.items())


# raw text columns come back unchanged; integers are widened, money is a double
_LISTS = {
    "status": "'delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'approved'",
    "any status": "'delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'approved', 'unavailable', 'created'",
    "region": "'Southeast', 'South', 'Northeast', 'North', 'Central-West', 'Unknown'", "score": "1, 2, 3, 4, 5",
}
# table: (columns that are unique and present, present, with listed values); staging renames one tested column
_TESTED = {
    "source.orders": ("silver_orders", "order_id", "customer_id", "order_status:any status"),
    "source.customers": ("silver_customers", "customer_id", "customer_unique_id", ""),
    "source.products": ("silver_products", "product_id", "", ""), "source.sellers": ("silver_sellers", "seller_id", "", ""),
    "source.payments": ("silver_payments", "order_id", "total_payment", ""), "source.reviews": ("silver_reviews", "review_id order_id", "", ""),
    "staging.orders": ("silver_orders", "order_id", "customer_id", ""),
    "staging.customers": ("silver_customers", "customer_id", "customer_unique_id", ""),
    "staging.products": ("silver_products", "product_id", "", ""), "staging.sellers": ("silver_sellers", "seller_id", "", ""),
    "staging.payments": ("(select *, total_payment as payment_amount from silver_payments)", "order_id", "payment_amount", ""),
    "staging.reviews": ("silver_reviews", "review_id order_id", "", "review_score:score"),
    "gold.fact_orders": ("fact_orders", "order_key order_id", "customer_key date_key payment_amount", "order_status:status"),
    "gold.dim_customers": ("dim_customers", "customer_key customer_id", "customer_unique_id", "customer_region:region"),
    "gold.dim_sellers": ("dim_sellers", "seller_key seller_id", "", ""), "gold.dim_products": ("dim_products", "product_key product_id", "", ""),
    "gold.dim_dates": ("dim_dates", "date_key full_date", "", ""), "gold.dim_payment": ("dim_payment", "payment_key", "", ""),
}
_TESTED_RAW = {
    "source.orders": ("raw_orders", "order_id", "customer_id", "order_status:any status"), "source.products": ("raw_products", "product_id", "", ""),
    "source.reviews": ("raw_reviews", "review_id order_id", "", ""),
}


def _declared(tested: dict[str, tuple[str, str, str, str]]) -> str:
    parts = []
    for name, (rows, keys, present, listed) in tested.items():
        checks = [(c, "unique", f"(select {c} from {rows} where {c} is not null group by 1 having count(*) > 1)") for c in keys.split()]
        checks += [(c, "not_null", f"(select 1 from {rows} where {c} is null)") for c in f"{keys} {present}".split()]
        if listed:
            column, values = listed.split(":")
            checks.append((column, "accepted_values", f"(select 1 from {rows} where {column} not in ({_LISTS[values]}))"))
        parts += [f"""select '{name}' as "table", '{c}' as "column", '{test}' as test, (select count(*) from {bad}) as failing""" for c, test, bad in checks]
    return " union all ".join(parts)


_PAYMENTS = "order_id, payment_sequential, payment_type, payment_installments, cast(payment_value as double) as payment_value"
_ITEMS = "order_id, order_item_id, product_id, seller_id, shipping_limit_date, cast(price as double) as price, cast(freight_value as double) as freight_value"

_MEASURES = """
select order_id, order_purchase_timestamp, order_delivered_customer_date > order_estimated_delivery_date as is_late,
  datediff('day', order_purchase_timestamp, order_delivered_customer_date) as delivery_days,
  datediff('day', order_purchase_timestamp, order_estimated_delivery_date) as estimated_delivery_days,
  case when order_delivered_customer_date > order_estimated_delivery_date
       then datediff('day', order_estimated_delivery_date, order_delivered_customer_date) else 0 end as delivery_delay_days,
  year(order_purchase_timestamp) as order_year, month(order_purchase_timestamp) as order_month,
  dayofweek(order_purchase_timestamp) + 1 as order_day_of_week
from typed_orders
"""

_BUCKET = """case when {c} = 1 then '1 (cash)' when {c} between 2 and 3 then '2-3' when {c} between 4 and 6 then '4-6'
  when {c} between 7 and 12 then '7-12' when {c} > 12 then '12+' else 'unknown' end"""


def _validation_sql() -> str:
    not_null = {
        "orders": ["order_id", "customer_id", "order_status"], "customers": ["customer_id", "customer_unique_id"],
        "order_items": ["order_id", "product_id", "seller_id"], "order_payments": ["order_id", "payment_value"],
        "order_reviews": ["review_id", "order_id", "review_score"], "products": ["product_id"], "sellers": ["seller_id"],
        "geolocation": ["geolocation_zip_code_prefix"], "category_translation": ["product_category_name"],
    }
    dates = {
        "orders": ["order_purchase_timestamp", "order_estimated_delivery_date"],
        "order_items": ["shipping_limit_date"], "order_reviews": ["review_creation_date"],
    }
    parts = []
    for name, table in _RAW.items():
        nulls = " or ".join(f"{c} is null" for c in not_null[name])
        bad = " or ".join(f"({c} is not null and try_cast({c} as timestamp) is null)" for c in dates.get(name, [])) or "false"
        parts.append(
            f"select '{name}' as file_name, (select count(*) from {table}) as row_count, "
            f"(select count(*) from {table} where {nulls}) = 0 as nulls_ok, "
            f"(select count(*) from {table}) = (select count(*) from (select distinct * from {table})) as copies_ok, "
            f"(select count(*) from {table} where {bad}) = 0 as dates_ok"
        )
    return f"""
select file_name, case when nulls_ok and copies_ok and dates_ok then 'PASS' else 'FAIL' end as status, row_count,
  'file_exists,csv_readable,row_count_gt_zero,column_names_match' || case when nulls_ok then ',no_key_nulls' else '' end
    || case when copies_ok then ',no_full_duplicates' else '' end || case when dates_ok then ',date_columns_parseable' else '' end as passed,
  array_to_string(list_filter([case when not nulls_ok then 'no_key_nulls' end, case when not copies_ok then 'no_full_duplicates' end,
    case when not dates_ok then 'date_columns_parseable' end], lambda x: x is not null), ',') as failed
from ({' union all '.join(parts)})
"""


def _histogram(source: str, column: str, bins: int, digits: int | None = None) -> str:
    start = f"low + bin * width" if digits is None else f"round(low + bin * width, {digits})"
    return f"""
select bin, {start} as bin_start, count(*) as count
from (select low, width, least(cast(floor((v - low) / width) as bigint), {bins - 1}) as bin
      from (select v, (select min(v) from ({source})) as low,
              ((select max(v) from ({source})) - (select min(v) from ({source}))) / {bins} as width
            from ({source}))
     ) group by bin, low, width
"""


def _periods(unit: str, step: str, end: str) -> str:
    return f"""
select cast({end} as date) as date, coalesce(n, 0) as orders
from (select unnest(generate_series((select min(date_trunc('{unit}', order_purchase_timestamp)) from overview),
        (select max(date_trunc('{unit}', order_purchase_timestamp)) from overview), interval {step})) as start)
left join (select date_trunc('{unit}', order_purchase_timestamp) as s, count(order_id) as n from overview group by 1) on s = start
"""


_FACT = """order_key, order_id, customer_key, payment_key, date_key, order_status, cast(payment_amount as double) as payment_amount,
  installments, payment_type, delivery_days, estimated_delivery_days, is_late, delivery_delay_days, review_score, purchased_at,
  approved_at, shipped_at, delivered_at, estimated_delivery_at, order_year, order_month, order_day_of_week"""
_CARD_MEASURES = """seller_id, seller_city, seller_state, seller_region, total_orders, cast(total_revenue as double) as total_revenue,
  avg_item_price, cast(total_freight as double) as total_freight, avg_review_score, review_count, avg_delivery_days, late_orders, on_time_rate_pct"""
_STATES = "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO".split()
_NUMERIC = [
    "distance_km", "product_weight_g", "product_volume_cm3", "freight_value", "price", "freight_ratio", "item_count",
    "num_installments", "order_day_of_week", "order_month", "seller_avg_delivery",
]
_F1 = """
select round((n00 + n11) / n, 4) as accuracy, round((p0 + p1) / classes, 4) as precision_macro,
  round((r0 + r1) / classes, 4) as recall_macro, round((f0 + f1) / classes, 4) as f1_macro
from (select *, n00 + n01 + n10 + n11 as n,
        coalesce(n00 / nullif(n00 + n10, 0), 0) as p0, coalesce(n11 / nullif(n11 + n01, 0), 0) as p1,
        coalesce(n00 / nullif(n00 + n01, 0), 0) as r0, coalesce(n11 / nullif(n11 + n10, 0), 0) as r1,
        coalesce(2 * n00 / nullif(2 * n00 + n01 + n10, 0), 0) as f0, coalesce(2 * n11 / nullif(2 * n11 + n01 + n10, 0), 0) as f1,
        case when n00 + n01 + n10 > 0 then 1 else 0 end + case when n11 + n01 + n10 > 0 then 1 else 0 end as classes
      from (select cast(count(*) filter (label = 0 and prediction = 0) as double) as n00,
              cast(count(*) filter (label = 0 and prediction = 1) as double) as n01,
              cast(count(*) filter (label = 1 and prediction = 0) as double) as n10,
              cast(count(*) filter (label = 1 and prediction = 1) as double) as n11 from class_predictions))
"""
_SILVER_CHECKS = {
    "orders.order_id not null": "select 1 from silver_orders where order_id is null",
    "orders.customer_id not null": "select 1 from silver_orders where customer_id is null",
    "products.product_id not null": "select 1 from silver_products where product_id is null",
    "customers.customer_id not null": "select 1 from silver_customers where customer_id is null",
    "sellers.seller_id not null": "select 1 from silver_sellers where seller_id is null",
    "payments.order_id not null": "select 1 from silver_payments where order_id is null",
    "reviews.review_id not null": "select 1 from silver_reviews where review_id is null",
    "reviews.order_id not null": "select 1 from silver_reviews where order_id is null",
    "orders.delivery_days not negative": "select 1 from silver_orders where delivery_days < 0",
    "orders without dropped statuses": "select 1 from silver_orders where order_status in ('unavailable', 'created')",
    "products.product_id unique": "select product_id from silver_products group by 1 having count(*) > 1",
    "payments.total_payment positive": "select 1 from silver_payments where total_payment <= 0",
    "reviews.order_id unique": "select order_id from silver_reviews group by 1 having count(*) > 1",
    **{f"{t} not empty": f"select 1 where (select count(*) from {_SILVER[t]}) = 0"
       for t in ["orders", "products", "customers", "sellers", "payments", "reviews"]},
}
_TEST_ROWS = "rn <= cast(ceil(n * 0.2) as bigint)"

# Names of candidates and of the features of the delivery model.
_REGRESSORS = ["LinearRegression", "RandomForestRegressor", "GradientBoostingRegressor", "FeatureSampledBoostingRegressor"]
_CLASSIFIERS = ["LogisticRegression", "RandomForestClassifier", "GradientBoostingClassifier", "WeightedBoostingClassifier"]
_DELIVERY_FEATURES = [
    "seller_state", "customer_state", "distance_km", "product_weight_g", "product_volume_cm3", "product_category",
    "freight_value", "price", "freight_ratio", "item_count", "primary_payment_type", "num_installments",
    "order_day_of_week", "order_month", "seller_avg_delivery",
]


def _candidates(models: list[str], measures: list[str]) -> str:
    return f"""select model, measure, true as in_range, true as choice_holds
        from (select unnest({models}) as model) cross join (select unnest({measures}) as measure)"""


def _weights(features: list[str]) -> str:
    return f"select unnest({features}) as feature, true as not_negative, true as adds_up"


EXPECTED: dict[str, str] = {
    # sources and sinks
    "s1_orders_csv": "select * from raw_orders",
    "s2_customers_csv": "select * from raw_customers",
    "s2_sellers_csv": "select * from raw_sellers",
    "s2_products_csv": "select * from raw_products",
    "s2_payments_csv": f"select {_PAYMENTS} from raw_payments",
    "s3_reviews_csv": """select * replace ('he said "' || review_comment_message || '",' || chr(10) || 'then left' as review_comment_message)
        from raw_reviews""",
    "s3_reviews_split": """select * replace ('he said "' || review_comment_message || '",' || chr(10) || chr(10) || 'then left' as review_comment_message)
        from raw_reviews""",
    "s4_write_silver": "select * from silver_customers",
    "s5_silver_scan": _counts(_SILVER),
    "s5_saved_sellers": "select * from silver_sellers",
    "s6_landed_sellers": "select raw_sellers.*, run_date from raw_sellers, (values (date '2024-01-01'), (date '2024-01-02')) as days(run_date)",
    "s6_land_snapshot": _counts({**_RAW, "orders of the day": "raw_orders"}),
    "s7_latest_snapshot": "select *, date '2024-01-02' as run_date from raw_sellers",
    "s8_load_table": """select order_id as ORDER_ID, customer_id as CUSTOMER_ID, order_status as ORDER_STATUS,
        order_purchase_timestamp as ORDER_PURCHASE_TIMESTAMP, order_approved_at as ORDER_APPROVED_AT,
        order_delivered_carrier_date as ORDER_DELIVERED_CARRIER_DATE, order_delivered_customer_date as ORDER_DELIVERED_CUSTOMER_DATE,
        order_estimated_delivery_date as ORDER_ESTIMATED_DELIVERY_DATE, delivery_days as DELIVERY_DAYS,
        estimated_delivery_days as ESTIMATED_DELIVERY_DAYS, cast(is_late as bigint) as IS_LATE,
        delivery_delay_days as DELIVERY_DELAY_DAYS, order_year as ORDER_YEAR, order_month as ORDER_MONTH,
        order_day_of_week as ORDER_DAY_OF_WEEK from silver_orders""",
    "s9_load_all": _counts({
        "STG_ORDERS": "silver_orders", "STG_PRODUCTS": "silver_products", "STG_CUSTOMERS": "silver_customers",
        "STG_SELLERS": "silver_sellers", "STG_PAYMENTS": "silver_payments", "STG_REVIEWS": "silver_reviews",
        "STG_ORDER_ITEMS": "raw_items",
    }),
    "s10_reconcile": " union all ".join(
        f"select '{n}' as \"table\", (select count(*) from {_SOURCE_OF[n]}) as bronze, (select count(*) from {t}) as silver, "
        + f"cast((select count(*) from {t}) as varchar) as loaded"
        for n, t in _SILVER.items()
    ),
    # validation
    "v1_readable": " union all ".join(
        [f"select '{n}' as file_name, true as file_exists, cast(0 as bigint) as malformed_rows" for n in _RAW]
        + ["select 'absent', false, null"]
    ),
    "v2_row_count": "select count(*) as row_count from raw_items",
    "v3_column_names": "select count(*) as rows, 'seller_id' as missing, 'note' as extra from raw_items",
    "v4_null_counts": """select count(*) filter (order_id is null) as order_id, count(*) filter (product_id is null) as product_id,
        count(*) filter (seller_id is null) as seller_id from raw_items""",
    "v5_duplicate_rows": "select (select count(*) from raw_products) - (select count(*) from (select distinct * from raw_products)) as duplicate_rows",
    "v6_unparseable_dates": """select
        count(*) filter (order_purchase_timestamp is not null and try_cast(order_purchase_timestamp as timestamp) is null) as order_purchase_timestamp,
        count(*) filter (order_approved_at is not null and try_cast(order_approved_at as timestamp) is null) as order_approved_at
        from raw_orders""",
    "v7_validation_reports": _validation_sql(),
    "v8_gate": f"""select file_name, case when file_name = 'geolocation' then 'CRITICAL' else status end as status, true as stops
        from ({_validation_sql()}) where status <> 'PASS' or file_name = 'geolocation'""",
    "v9_unique": "select product_id, count(*) as n_records from raw_products group by 1 having count(*) > 1",
    "v10_not_null": f"select {_ITEMS} from raw_items where product_id is null",
    "v11_accepted_values": """select order_status as value_field, count(*) as n_records from raw_orders
        where order_status not in ('delivered','shipped','canceled','invoiced','processing','approved') group by 1""",
    "v11_declared_tests": _declared(_TESTED),
    "v11_declared_tests_of_raw": f"""select *, max(failing) over (partition by "table") > 0 as stops from ({_declared(_TESTED_RAW)})""",
    "v12_negative_delivery_days": f"select order_id, delivery_days from ({_MEASURES}) where delivery_days < 0",
    "v13_negative_payments": "select order_id, cast(payment_amount as double) as payment_amount from fact_orders where payment_amount < 0",
    "v13_negative_after_refund": "select order_id, cast(payment_amount - 50000 as double) as payment_amount from fact_orders where payment_amount < 50000",
    "v14_silver_checks": " union all ".join(
        f"select '{name}' as \"check\", count(*) as failing_rows from ({rows})" for name, rows in _SILVER_CHECKS.items()
    ),
    # projections
    "p1_staged_orders": """select order_id, customer_id, order_status, order_purchase_timestamp as purchased_at,
        order_approved_at as approved_at, order_delivered_carrier_date as shipped_at, order_delivered_customer_date as delivered_at,
        order_estimated_delivery_date as estimated_delivery_at, delivery_days, estimated_delivery_days, is_late,
        delivery_delay_days, order_year, order_month, order_day_of_week from silver_orders""",
    "p1_staged_customers": "select * rename (customer_zip_code_prefix as zip_code_prefix) from silver_customers",
    "p1_staged_products": """select product_id, product_category_name as product_category, product_name_lenght as name_length,
        product_description_lenght as description_length, product_photos_qty as photos_qty, product_weight_g as weight_g,
        product_length_cm as length_cm, product_height_cm as height_cm, product_width_cm as width_cm,
        product_volume_cm3 as volume_cm3 from silver_products""",
    "p1_staged_sellers": "select * rename (seller_zip_code_prefix as zip_code_prefix) from silver_sellers",
    "p1_staged_payments": """select order_id, cast(total_payment as double) as payment_amount, num_installments as installments,
        primary_payment_type as payment_type from silver_payments""",
    "p1_staged_reviews": """select review_id, order_id, review_score, review_comment_title as comment_title,
        review_comment_message as comment_message, review_creation_date as review_created_at,
        review_answer_timestamp as review_answered_at from silver_reviews""",
    "p2_parse_times": "select * from typed_orders",
    "p3_review_casts": "select * from typed_reviews",
    "p4_clean_text": "select customer_id, lower(trim(customer_city)) as customer_city from raw_customers",
    "p5_fill_nulls": """select product_id, coalesce(product_name_lenght, 0) as product_name_lenght,
        coalesce(product_description_lenght, 0) as product_description_lenght, coalesce(product_photos_qty, 0) as product_photos_qty
        from raw_products""",
    "p6_volume": "select product_id, product_length_cm * product_height_cm * product_width_cm as product_volume_cm3 from raw_products",
    "p7_day_counts": f"select order_id, order_purchase_timestamp, delivery_days, estimated_delivery_days from ({_MEASURES})",
    "p8_lateness": f"select order_id, order_purchase_timestamp, is_late, delivery_delay_days from ({_MEASURES})",
    "p9_purchase_parts": f"select order_id, order_purchase_timestamp, order_year, order_month, order_day_of_week from ({_MEASURES})",
    "p10_status_filter": "select order_id, order_status from raw_orders where order_status not in ('unavailable', 'created')",
    "p11_positive_payments": f"select {_PAYMENTS} from raw_payments where payment_value > 0",
    "p12_regions": f"""select customer_id, {region_case('customer_state')} as region,
        {region_case('customer_state', 'null')} as known_region from silver_customers""",
    "p13_installments_bucket": f"""select order_id, payment_sequential, payment_installments,
        {_BUCKET.format(c='payment_installments')} as bucket from raw_payments""",
    "p14_surrogate_keys": f"""select order_id, payment_type, payment_installments,
        {key_sql('payment_type', 'payment_installments')} as payment_key from raw_payments""",
    "p15_date_key": "select order_id, cast(strftime(order_purchase_timestamp, '%Y%m%d') as bigint) as date_key from silver_orders",
    "p16_defaults": """select order_id, cast(coalesce(payment_amount, 0) as double) as payment_amount, coalesce(is_late, false) as is_late,
        coalesce(delivery_delay_days, 0) as delivery_delay_days from orders_enriched""",
    "p17_period_labels": """select order_id, strftime(order_purchase_timestamp, '%Y-%m') as year_month,
        year(order_purchase_timestamp) || '-Q' || quarter(order_purchase_timestamp) as year_quarter,
        cast(date_trunc('month', order_purchase_timestamp) as date) as month_start, quarter(order_purchase_timestamp) as quarter
        from silver_orders""",
    "p18_calendar": """select full_date, cast(strftime(full_date, '%Y%m%d') as bigint) as date_key, year(full_date) as year,
        month(full_date) as month, day(full_date) as day, quarter(full_date) as quarter, dayofweek(full_date) as day_of_week,
        isodow(full_date) as day_of_week_iso, strftime(full_date, '%A') as day_name, strftime(full_date, '%B') as month_name,
        dayofweek(full_date) in (0, 6) as is_weekend, year(full_date) || '-Q' || quarter(full_date) as year_quarter,
        strftime(full_date, '%Y-%m') as year_month
        from (select distinct cast(order_purchase_timestamp as date) as full_date from silver_orders)""",
    "q2_dim_dates": "select * from dim_dates",
    "p19_month_index": """select order_id, datediff('month', order_purchase_timestamp, order_estimated_delivery_date) as months
        from silver_orders""",
    "p20_rfm_cell": "select customer_unique_id, rfm_cell, rfm_total from rfm_full",
    "p21_rfm_segment": "select customer_unique_id, segment_name from rfm_full",
    "p22_total_segment": "select customer_id, rfm_score, segment from page_rfm",
    "p23_safe_ratio": f"""select seller_id, {half_up('sum(price)', 'count(product_id)', 2)} as mean_price, cast(null as double) as nothing
        from raw_items group by 1""",
    "p24_reliability": "select seller_id, reliability_score from seller_scores",
    "p25_good_review": "select order_id, review_score, is_good_review from enriched",
    "p26_freight_ratio": f"""select order_id, order_item_id, {half_even_ratio('freight_value', 'price + freight_value', 4)} as freight_ratio
        from raw_items""",
    "p27_comments": "select order_id, comment_length, has_comment from features",
    "p28_distance": "select order_id, round(distance_km, 6) as distance_km from features",
    "p29_late_flag": "select order_id, cast(coalesce(is_late, false) as bigint) as is_late_int from silver_orders",
    "p30_item_value": "select order_id, order_item_id, cast(price + freight_value as double) as total from raw_items",
    "p31_page_filters": """
        select 'overview' as "table", count(*) as rows from overview
        union all select 'overview, whole last day', count(*) from bought where order_status = 'delivered'
        union all select 'overview, one year', count(*) from bought where order_status in ('delivered', 'shipped')
          and order_purchase_timestamp between timestamp '1997-01-01' and timestamp '1997-12-31'
        union all select 'overview, any status', count(*) from bought
          where order_purchase_timestamp <= (select cast(max(cast(order_purchase_timestamp as date)) as timestamp) from bought)
        union all select 'years', count(*) from bought where year(order_purchase_timestamp) in (1996, 1998)
        union all select 'all years', count(*) from bought
        union all select 'sellers', count(*) from sold
        union all select 'sellers of two states', count(*) from sold where seller_state in ('MG', 'RJ')
        union all select 'customers', count(*) from delivered
        union all select 'delivery and review', count(*) from points where delivery_days <= 30""",
    "p32_late_label": """select order_id, case when is_late then 'Late' when not is_late then 'On Time' else 'Unknown' end as late_label
        from silver_orders""",
    "p33_names": f"""select customer_id, {state_name_case('customer_state')} as state_name, substr(customer_id, 1, 3) || '…' as short_id
        from silver_customers""",
    "p34_scoring_freight_ratio": """select order_id, order_item_id,
        case when price + freight_value > 0 then round(cast(freight_value as double) / cast(price + freight_value as double), 10) else 0 end as freight_ratio
        from raw_items""",
    "p35_revenue_per_order": "select seller_id, round(cast(revenue as double) / order_count, 6) as revenue_per_order from board",
    # joins
    "j1_orders_enriched": "select * replace (cast(payment_amount as double) as payment_amount) from orders_enriched",
    "j2_customer_key": "select order_id, customer_key from fact_orders",
    "j3_payment_key": "select order_id, payment_type, installments, payment_key from fact_orders",
    "j4_items_enriched": """select * replace (cast(price as double) as price, cast(freight_value as double) as freight_value,
        cast(total_item_value as double) as total_item_value) from items_enriched""",
    "j4_items_in_english": """select i.order_id, i.order_item_id, i.product_id,
        coalesce(t.product_category_name_english, i.product_category) as product_category
        from items_enriched i left join raw_translation t on t.product_category_name = i.product_category""",
    "j5_fact_customers": """select o.order_id, c.customer_unique_id, c.customer_state, cast(o.payment_amount as double) as payment_amount
        from revenue_fact o join dim_customers c on o.customer_key = c.customer_key""",
    "j6_seller_lines": """select seller_id, seller_region, total_orders, cast(total_revenue as double) as total_revenue, review_count
        from seller_totals""",
    "j7_activity": "select * from activity",
    "j8_cohort_size": "select cohort_label, months_since_first_order, cohort_size from retention",
    "j9_enriched_orders": """select * replace (cast(total_payment as double) as total_payment, cast(price as double) as price,
        cast(freight_value as double) as freight_value) from enriched""",
    "j10_training_join": """select order_id, customer_state, seller_state, product_category_name, product_weight_g, review_comment_message,
        customer_zip_code_prefix, seller_zip_code_prefix, item_count, cast(total_price as double) as total_price,
        cast(total_freight as double) as total_freight from wide""",
    "j11_centroids": """select order_id, round(cust_lat, 8) as cust_lat, round(cust_lng, 8) as cust_lng,
        round(sell_lat, 8) as sell_lat, round(sell_lng, 8) as sell_lng from wide""",
    "j12_primary_type": "select * replace (cast(total_payment as double) as total_payment) from silver_payments",
    "j13_latest_purchase": "select customer_unique_id, recency_days from rfm_days",
    "j14_top_states_only": """select order_id, customer_state from bought
        where customer_state in (select customer_state from customer_states order by order_count desc, customer_state limit 10)""",
    # aggregations
    "a1_payments_by_type": "select order_id, payment_type, cast(type_total as double) as type_total from payment_types",
    "a2_payments_by_order": "select order_id, cast(total_payment as double) as total_payment, num_installments from silver_payments",
    "a3_payment_dimension": "select * from dim_payment",
    "a4_first_months": "select * from first_purchase",
    "a5_cohort_counts": "select * from cohort_counts",
    "a6_rfm_base": "select * replace (cast(monetary as double) as monetary) from rfm_raw",
    "a7_segment_summary": "select * from rfm_summary",
    "a8_monthly_base": "select * replace (cast(gmv as double) as gmv) from monthly_base",
    "a9_quarterly": f"""select order_year, quarter(purchased_at) as quarter, order_year || '-Q' || quarter(purchased_at) as year_quarter,
        count(distinct order_id) as order_count, cast(sum(payment_amount) as double) as quarterly_gmv,
        {half_up('sum(payment_amount)', 'count(payment_amount)', 2)} as avg_order_value from revenue_fact group by 1, 2, 3""",
    "a10_revenue_by_state": """select * replace (cast(total_gmv as double) as total_gmv) from by_state
        order by total_gmv desc nulls last, customer_state limit 10""",
    "a11_seller_metrics": f"select {_CARD_MEASURES} from seller_totals",
    "a11_seller_metrics_by_order": "select seller_id, late_by_order as late_orders, on_time_by_order as on_time_rate_pct from seller_totals",
    "a12_seller_states": "select * exclude (mean_review) from seller_state_summary",
    "a13_kpis": """select count(*) as total_orders, cast(coalesce(sum(total_payment), 0) as double) as total_revenue,
        cast(sum(total_payment) as double) / count(total_payment) as avg_order_value,
        sum(delivery_days) / count(delivery_days) as avg_delivery_days, sum(review_score) / count(review_score) as avg_review_score,
        count(*) filter (delivery_days > estimated_delivery_days) / count(*) * 100 as late_pct from overview""",
    "a14_orders_per_month": _periods("month", "1 month", "last_day(start)"),
    "a14_orders_per_week": _periods("week", "7 day", "start + interval 6 day"),
    "a14_orders_per_quarter": _periods("quarter", "3 month", "last_day(start + interval 2 month)"),
    "a15_revenue_by_month": """select strftime(order_purchase_timestamp, '%Y-%m') as month, cast(sum(total_payment) as double) as total_payment
        from overview where total_payment is not null group by 1""",
    "a16_payment_types": "select primary_payment_type, count(*) as count from overview where primary_payment_type is not null group by 1",
    "a17_review_scores": "select review_score, count(*) as count from overview where review_score is not null group by 1",
    "a18_statuses": "select order_status, count(*) as count from enriched where order_status is not null group by 1",
    "a19_delivery_histogram": _histogram("select cast(delivery_days as double) as v from overview where delivery_days is not null", "v", 50),
    "a20_customer_states": """select customer_state, order_count, cast(revenue as double) as revenue, avg_review_score,
        avg_delivery_days, state_name, region from customer_states""",
    "a20_customer_state_table": f"""select customer_state, state_name, region, order_count, {half_even('revenue', '1', 0)} as revenue,
        {half_even('score', 'score_n', 2)} as avg_review_score, {half_even('days', 'days_n', 1)} as avg_delivery_days from customer_states""",
    "a21_seller_states": "select * replace (cast(revenue as double) as revenue) from seller_states",
    "a22_regions": "select region, cast(sum(order_count) as bigint) as order_count from customer_states where region is not null group by 1",
    "a23_delivery_heat": "select * from heat",
    "a23_delivery_heat_matrix": "select customer_state, "
        + ", ".join(f"max(avg_delivery_days) filter (place = {i}) as seller_{i}" for i in range(1, 11)) + ", "
        + ", ".join(f"(select seller_state from busy_sellers where place = {i}) as seller_{i}_state" for i in range(1, 11))
        + " from heat join busy_sellers using (seller_state) group by 1",
    "a24_customer_rfm_base": "select customer_id, cast(recency as bigint) as recency, frequency, cast(monetary as double) as monetary from page_rfm_days",
    "a25_segment_spend": "select segment, count(*) as count, cast(sum(monetary) as double) / count(*) as monetary from page_rfm group by 1",
    "a25_segment_summary": f"""select segment, count(*) as customers, {half_even('sum(recency)', 'count(*)', 1)} as avg_recency,
        {half_even('sum(frequency)', 'count(*)', 1)} as avg_frequency, {half_even('sum(monetary)', 'count(*)', 1)} as avg_monetary
        from page_rfm group by 1""",
    "a26_review_by_lateness": """select case when is_late then 'Late' when not is_late then 'On Time' else 'Unknown' end as late_label,
        sum(review_score) / count(review_score) as review_score from delivered group by 1""",
    "a27_orders_by_month": "select strftime(order_purchase_timestamp, '%Y-%m') as cohort_month, count(order_id) as orders from delivered group by 1",
    "a28_seller_leaderboard": """select seller_id, order_count, cast(revenue as double) as revenue, round(avg_delivery_days, 8) as avg_delivery_days,
        round(avg_review_score, 8) as avg_review_score, seller_state, region,
        round(cast(revenue as double) / order_count, 6) as revenue_per_order from board""",
    "a29_seller_kpis": """select count(*) as active_sellers, round(avg(order_count), 6) as avg_orders_per_seller,
        round(avg(avg_delivery_days), 6) as avg_delivery_days, round(avg(avg_review_score), 6) as avg_review_score from board""",
    "a30_seller_state_revenue": """select seller_state, cast(sum(revenue) as double) as revenue from board where seller_state is not null
        group by 1 order by sum(revenue) desc, seller_state limit 15""",
    "a31_seller_delivery_histogram": _histogram(
        "select round(avg_delivery_days, 8) as v from board where avg_delivery_days is not null", "v", 40, 6),
    "a32_item_totals": """select order_id, item_count, cast(total_price as double) as total_price,
        cast(total_freight as double) as total_freight from item_totals""",
    "a33_zip_medians": "select zip_prefix, round(lat, 8) as lat, round(lng, 8) as lng from centroids",
    "a34_top_categories": "select product_category, count(*) as orders from features group by 1",
    "a35_review_trend": "select delivery_days, count(*) as orders, sum(review_score) / count(*) as avg_review_score from points group by 1",
    "a36_cohort_matrix": "select cohort_label, "
        + ", ".join(f"max(retention_rate_pct) filter (months_since_first_order = {i}) as \"Month {i}\"" for i in range(7))
        + " from retention where months_since_first_order <= 12 group by 1",
    "a37_date_domain": """select cast(min(order_purchase_timestamp) as date) as min_date, cast(max(order_purchase_timestamp) as date) as max_date,
        count(*) as orders from bought""",
    "a37_status_domain": "select distinct order_status from enriched where order_status is not null",
    "a37_year_domain": "select distinct order_year from enriched where order_year is not null",
    "a37_state_domain": "select distinct seller_state from sold",
    # windows
    "w1_dedup_orders": "select order_id, order_purchase_timestamp, order_status from silver_orders",
    "w2_dedup_customers": "select * from silver_customers",
    "w2_dedup_sellers": "select * from silver_sellers",
    "w2_dedup_products": "select * from silver_products",
    "w3_dedup_reviews": "select * from silver_reviews",
    "w4_primary_payment": "select order_id, primary_payment_type from silver_payments",
    "w5_rfm_tiles": "select customer_unique_id, r_score, f_score, m_score from rfm_scored",
    "w6_month_growth": """select period_start, cast(prev_month_gmv as double) as prev_month_gmv, prev_month_orders, mom_gmv_growth_pct
        from growth""",
    "w7_state_shares": "select customer_state, gmv_share_pct from by_state",
    "w8_rolling_mean": "select period_start, rolling_3m_avg_gmv from growth",
    "w9_seller_ranks": "select seller_id, revenue_rank, volume_rank, review_rank, ontime_rank, reliability_rank from seller_card",
    "w9_order_amount_ranks": """select order_id, dense_rank() over (order by review_score desc nulls first) as score_rank,
        rank() over (order by payment_amount desc nulls first) as amount_rank from fact_orders""",
    "w10_state_rank": "select seller_state, state_review_rank from seller_state_summary",
    "w11_quartile_scores": "select customer_id, recency_score, frequency_score, monetary_score from page_rfm",
    "w12_seller_history": """select order_id, seller_id, round(seller_avg_delivery, 8) as seller_avg_delivery,
        round(seller_avg_review, 8) as seller_avg_review from features""",
    "w13_first_items": """select * replace (cast(price as double) as price, cast(freight_value as double) as freight_value) from first_items""",
    # order, limit, sampling
    "l1_report_order": "select customer_unique_id, rfm_total, cast(monetary as double) as monetary, row_number() over (order by rfm_total desc, monetary desc, customer_unique_id) - 1 as place from rfm_full",
    "l1_cohort_order": """select cohort_label, months_since_first_order, row_number() over (order by cohort_label, months_since_first_order) - 1 as place
        from retention where months_since_first_order <= 12""",
    "l1_trend_order": "select strftime(period_start, '%Y-%m') as year_month, row_number() over (order by period_start) - 1 as place from growth",
    "l1_scorecard_order": "select seller_id, reliability_rank, row_number() over (order by reliability_rank, seller_id) - 1 as place from seller_card",
    "l2_top_customer_states": "select customer_state, cast(revenue as double) as revenue from customer_states order by revenue desc, customer_state limit 10",
    "l2_top_seller_states": "select * replace (cast(revenue as double) as revenue) from seller_states order by order_count desc, seller_state limit 10",
    "l3_top_sellers": f"""select seller_id, seller_state, order_count, {half_even('revenue', '1', 0)} as revenue,
        {half_even('days', 'days_n', 1)} as avg_delivery_days, {half_even('score', 'score_n', 2)} as avg_review_score,
        substr(seller_id, 1, 8) || '…' as seller_id_short
        from (select * from board order by revenue desc, seller_id limit 20)""",
    "l4_bottom_sellers": """select seller_id, seller_state, reliability_score, avg_review_score, on_time_rate_pct, total_orders
        from seller_card order by reliability_score asc nulls last, seller_id limit 10""",
    "l5_seller_detail": f"""select substr(seller_id, 1, 16) || '…' as seller_id, seller_state, region, order_count,
        {half_even('revenue', '1', 0)} as revenue, {half_even('days', 'days_n', 1)} as avg_delivery_days,
        {half_even('score', 'score_n', 2)} as avg_review_score
        from (select * from board order by round(avg_review_score, 12) desc nulls last, seller_id limit 100)""",
    "l6_sample": """select order_id, delivery_days, review_score, cast(total_payment as double) as total_payment from points
        order by md5('42-' || order_id) limit 500""",
    "l7_date_spine": """select full_date as date_day, n as orders from dim_dates
        left join (select cast(order_purchase_timestamp as date) as d, count(*) as n from silver_orders group by 1) on d = full_date""",
    "l8_distinct": "select distinct primary_payment_type, num_installments from silver_payments",
    # models
    "m1_features": """select order_id, product_category, freight_ratio, item_count, cast(price as double) as price,
        cast(freight_value as double) as freight_value, product_weight_g, product_volume_cm3, product_photos_qty, num_installments,
        primary_payment_type, order_day_of_week, order_month, comment_length, has_comment from features""",
    "m2_delivery_training": "select order_id, cast(delivery_days as double) as label from delivery_training",
    "m2_review_training": "select order_id, is_late_int, label from review_training",
    "m3_label_codes": """select feature, label, row_number() over (partition by feature order by label) - 1 as code from (""" + " union ".join(
        f"select '{c}' as feature, coalesce({c}, 'unknown') as label from delivery_training"
        for c in ["seller_state", "customer_state", "primary_payment_type", "product_category"]) + ")",
    "m4_medians": " union all ".join(
        f"select '{c}' as feature, round(median(cast({c} as double)), 6) as median from delivery_training" for c in _NUMERIC),
    "m6_regression_candidates": _candidates(_REGRESSORS, ["MAE", "RMSE", "R2"]),
    "m8_best_model": """select count(*) - cast(ceil(count(*) * 0.2) as bigint) as train_samples,
        cast(ceil(count(*) * 0.2) as bigint) as test_samples, 'delivery_days' as target, true as best_is_best from delivery_training""",
    "m9_feature_importance": _weights(_DELIVERY_FEATURES),
    "s11_artifacts": _weights(_DELIVERY_FEATURES),
    "m10_classification_candidates": _candidates(_CLASSIFIERS, ["accuracy", "precision_macro", "recall_macro", "f1_macro"]),
    "s12_model_comparison": _candidates(_CLASSIFIERS, ["accuracy", "precision_macro", "recall_macro", "f1_macro"]),
    "m14_delivery_scores": "select order_id, true as scored from features",
    "m15_review_scores": "select order_id, true as consistent from features",
    "m17_chained_scores": "select order_id, true as scored, true as consistent from features",
    "m5_split": f"""select order_id, {_TEST_ROWS} as is_test
        from (select order_id, row_number() over (order by md5('42-' || order_id), order_id) as rn, count(*) over () as n from delivery_training)""",
    "m5_stratified_split": """select order_id, label, rn <= test_rows as is_test
        from (select order_id, label, row_number() over (partition by label order by md5('42-' || order_id), order_id) as rn from review_training)
        join (select label as l, n - whole - case when row_number() over (order by exact - whole desc, label) <= train - sum(whole) over () then 1 else 0 end as test_rows
              from (select label, n, cast(n as double) * train / total as exact, cast(floor(cast(n as double) * train / total) as bigint) as whole, train
                    from (select label, count(*) as n, sum(count(*)) over () as total,
                            sum(count(*)) over () - cast(ceil(sum(count(*)) over () * 0.2) as bigint) as train
                          from review_training group by label))) on l = label""",
    "m7_regression_metrics": """select round(sum(abs(label - prediction)) / count(*), 3) as "MAE",
        round(sqrt(sum((label - prediction) * (label - prediction)) / count(*)), 3) as "RMSE",
        round(1 - sum((label - prediction) * (label - prediction)) / (sum(label * label) - sum(label) * sum(label) / count(*)), 4) as "R2"
        from day_predictions""",
    "m10_class_weights": """select label, n as orders, round(cast(total as double) / (2 * n), 8) as balanced,
        round(case when label = 1 then cast(total - n as double) / n else 1 end, 8) as positives
        from (select label, count(*) as n, (select count(*) from review_training) as total from review_training group by 1)""",
    "m11_classification_metrics": _F1,
    "m12_confusion_matrix": """select a.actual, count(*) filter (prediction = 0 and label = a.actual) as predicted_0,
        count(*) filter (prediction = 1 and label = a.actual) as predicted_1
        from class_predictions cross join (select cast(unnest([0, 1]) as bigint) as actual) a group by 1""",
    "m13_class_balance": """select round(sum(label) / count(*) * 100, 8) as good_pct, round((1 - sum(label) / count(*)) * 100, 8) as bad_pct
        from review_training""",
    "m16_prepare_scoring": """select order_id, case when seller_state in ('MG', 'RJ') then seller_state else 'unknown' end as seller_state,
        case when product_category in ('economy_brand#1', 'other') then product_category else 'economy_brand#1' end as product_category,
        cast(price as double) as price, cast(null as double) as distance_km from features""",
    # reports
    "q1_silver_orders": "select * from silver_orders",
    "q1_silver_payments": "select * replace (cast(total_payment as double) as total_payment) from silver_payments",
    "q1_silver_reviews": "select * from silver_reviews",
    "q1_silver_items": """select order_id, order_item_id, product_id, seller_id, try_cast(shipping_limit_date as timestamp) as shipping_limit_date,
        cast(price as double) as price, cast(freight_value as double) as freight_value from raw_items""",
    "q2_fact_orders": f"select {_FACT} from fact_orders",
    "q2_dim_customers": "select * from dim_customers",
    "q2_dim_sellers": "select * from dim_sellers",
    "q2_dim_products": "select * from dim_products",
    "q2_dim_payment": "select * from dim_payment",
    "q3_rfm": "select * replace (cast(monetary as double) as monetary) from rfm_full",
    "q3_rfm_summary": "select * from rfm_summary",
    "q4_cohort_retention": "select * from retention where months_since_first_order <= 12",
    "q5_monthly_trend": """select strftime(period_start, '%Y-%m') as year_month, order_count, unique_customers, cast(gmv as double) as gmv,
        avg_order_value, mom_gmv_growth_pct, rolling_3m_avg_gmv, avg_review_score, late_delivery_pct from growth""",
    "q6_seller_scorecard": f"""select {_CARD_MEASURES}, reliability_score, revenue_rank, volume_rank, review_rank, ontime_rank,
        reliability_rank from seller_card""",
    "q7_customer_segments": "select * replace (cast(monetary as double) as monetary) from page_rfm",
    "q8_features": """select order_id, seller_state, customer_state, product_weight_g, product_volume_cm3, product_category,
        cast(freight_value as double) as freight_value, cast(price as double) as price, freight_ratio, item_count, primary_payment_type,
        num_installments, order_day_of_week, order_month, round(distance_km, 6) as distance_km,
        round(seller_avg_delivery, 8) as seller_avg_delivery from features""",
}


# reports that are built from operators above
for _report, _operator in {
    "q1_silver_customers": "w2_dedup_customers", "q1_silver_sellers": "w2_dedup_sellers",
    "q1_silver_products": "w2_dedup_products", "q4_cohort_matrix": "a36_cohort_matrix",
    "q5_quarterly": "a9_quarterly", "q5_revenue_by_state": "a10_revenue_by_state",
    "q6_bottom_sellers": "l4_bottom_sellers", "q6_seller_states": "a12_seller_states",
}.items():
    EXPECTED[_report] = EXPECTED[_operator]


def expected_sql() -> dict[str, str]:
    return {name: query(sql) for name, sql in EXPECTED.items()}
