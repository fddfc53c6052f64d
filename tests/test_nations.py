"""Reports over tables whose nation keys go beyond the 25 listed ones, as in tables repeated with shifted keys."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import queries
from oracle.queries import expected_sql
from tests.compare import difference

# 400 orders of 40 customers from 12 suppliers; nation keys from 0 to 74
TABLES = {
    "nation": "select i::int as n_nationkey, 'nation ' || i as n_name, (i % 5)::int as n_regionkey from range(75) t(i)",
    "region": "select i::int as r_regionkey, 'region ' || i as r_name from range(5) t(i)",
    "customer": """select i as c_custkey, 'Customer#' || i as c_name, (i * 13 % 75)::int as c_nationkey, i * 10.5 as c_acctbal,
        'MACHINERY' as c_mktsegment from range(40) t(i)""",
    "supplier": """select i as s_suppkey, 'Supplier#' || i as s_name, (i * 7 % 75)::int as s_nationkey, i * 1.5 as s_acctbal
        from range(12) t(i)""",
    "part": """select i as p_partkey, 'part ' || i as p_name, 'Brand#' || i % 4 as p_brand, 'LARGE' as p_type,
        (1 + i % 50)::int as p_size, 900.0 + i as p_retailprice from range(30) t(i)""",
    "orders": """select i as o_orderkey, i * 17 % 40 as o_custkey, ['F', 'F', 'O', 'P'][1 + i % 4] as o_orderstatus,
        100.0 * i as o_totalprice, timestamp '2016-01-01' + to_days((i * 7 % 900)::int) as o_orderdate, '5-LOW' as o_orderpriority
        from range(400) t(i)""",
    "lineitem": """select i % 400 as l_orderkey, i * 11 % 30 as l_partkey, i * 5 % 12 as l_suppkey, (1 + i // 400)::int as l_linenumber,
        (1 + i % 50)::double as l_quantity, 10.25 + i % 700 as l_extendedprice, (i % 11) / 100 as l_discount, (i % 9) / 100 as l_tax,
        ['A', 'N', 'R'][1 + i % 3] as l_returnflag, ['F', 'O'][1 + i % 2] as l_linestatus,
        timestamp '2016-02-01' + to_days((i * 13 % 900)::int) as l_shipdate from range(1200) t(i)""",
}
NAMES = [
    "a12_seller_states",
    "a11_seller_metrics_by_order",
    "a13_kpis",
    "a14_orders_per_month",
    "a14_orders_per_week",
    "a14_orders_per_quarter",
    "a16_payment_types",
    "a15_revenue_by_month",
    "a17_review_scores",
    "a18_statuses",
    "a19_delivery_histogram",
    "a20_customer_state_table",
    "a20_customer_states",
    "a22_regions",
    "a21_seller_states",
    "a23_delivery_heat",
    "a23_delivery_heat_matrix",
    "a24_customer_rfm_base",
    "a25_segment_summary",
    "a25_segment_spend",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("nations"))


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name, rows in TABLES.items():
        con.execute(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_nation_keys_beyond_the_list(spark, folder, duck, name):
    assert difference(queries()[name](spark, folder), duck, expected_sql()[name]) is None
