"""Banking inputs derived from the benchmark tables.

Each input is one SELECT both engines understand; ``{name}`` stands for a table. Every
row of the underlying table takes part, so an input grows with its table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Numbers of several kinds: two valid ones, one with a dash, one too long, one missing.
_PHONE = (
    "case {k} % 5 when 0 then '+91' || cast(6000000000 + {k} as string) "
    "when 1 then '+91-' || cast(6000000000 + {k} as string) "
    "when 2 then cast(9000000000 + {k} as string) when 3 then '99999999999999' end"
)
_EMAIL = (
    "case c_custkey % 3 when 0 then c_name || '@X.com' "
    "when 1 then replace(c_name, '#', '.') || '@Ex.Org' else c_name end"
)


def _phone(key: str) -> str:
    return _PHONE.replace("{k}", key)


INPUTS = {
    # Curated-like rows for the reports.
    "transactions": (
        "select o_orderkey as transaction_id, o_custkey as account_id, "
        "case when o_orderpriority = '1-URGENT' then lower(o_orderstatus) else o_orderstatus end as status, "
        "cast(o_orderdate as date) as date, o_totalprice as amount from {orders}"
    ),
    "customers": "select c_custkey as customer_id, c_name as name, c_custkey as account_id from {customer}",
    "accounts": "select c_custkey as account_id, c_name as account_name from {customer}",
    "sales": (
        "select l_partkey as product_id, l_suppkey as branch_id, cast(l_shipdate as date) as date, "
        "l_extendedprice as amount, l_returnflag as status, l_linestatus as line from {lineitem}"
    ),
    "products": "select p_partkey as product_id from {part}",
    # Fields to clean.
    "texts": (
        "select c_custkey as id, c_name as name, c_mktsegment || '_' || c_name || ' *&^%' as dirty, "
        f"{_phone('c_custkey')} as phone, {_EMAIL} as email, "
        "'\t  ' || c_name || '  ' || c_mktsegment || ' 　\n' as padded from {customer}"
    ),
    "required": (
        "select c_custkey as id, nullif(c_custkey % 5, 0) as a, nullif(c_mktsegment, 'BUILDING') as b "
        "from {customer}"
    ),
    "days": (
        "select o_orderkey as id, cast(o_orderdate as date) as day, case when o_orderstatus = 'P' then case o_orderkey % 4 when 0 then '2024' when 1 then '2024-01-05 zz' else 'soon' end "
        "else cast(cast(o_orderdate as date) as string) end as text, "
        "case o_orderstatus when 'F' then 'True' when 'O' then 'false' else case o_orderkey % 2 when 0 then 'y' else 'perhaps' end end as flag, "
        "o_orderstatus = 'F' as done from {orders}"
    ),
    # Arrival messages and file paths.
    "objects": (
        "select event_id, 'b' as bucket, 'raw/' || event_type || '_' || cast(event_id as string) || '.csv' as name "
        "from {events}"
    ),
    "paths": (
        "select event_id, 'gs://b/raw/' || case event_id % 7 when 0 then 'Accounts' when 1 then 'Branch_' "
        "when 2 then 'CUSTOMER_account' when 3 then 'customers' when 4 then 'Products' "
        "when 5 then 'transactions' else 'misc' end || event_type || '.csv' as path from {events}"
    ),
    # Two states of the order book that overlap.
    "book": (
        "select o_orderkey, o_totalprice, o_orderstatus, cast(o_orderdate as date) as day from {orders} "
        "where o_orderdate < timestamp '2000-01-01 00:00:00'"
    ),
    "book_changes": (
        "select o_orderkey, o_totalprice + 1 as o_totalprice, 'N' as o_orderstatus, "
        "cast(o_orderdate as date) + 40 as day from {orders} "
        "where o_orderdate >= timestamp '1999-01-01 00:00:00'"
    ),
    # Three loads of transactions: all orders, then changes of day, status and amount, then of
    # account and to earlier days.
    "load_1": (
        "select o_orderkey as k, o_custkey % 100 as account, o_custkey % 30 as product, o_orderkey % 10 as branch, "
        "cast(date_trunc('month', cast(o_orderdate as date)) as date) as date, case o_orderstatus when 'F' then 'Success' when 'O' then 'SUCCESS' else 'Failed' end as status, "
        "o_totalprice as amount from {orders} where o_orderkey % 5 > 0"
    ),
    "load_2": (
        "select o_orderkey as k, o_custkey % 100 as account, o_custkey % 30 as product, o_orderkey % 10 as branch, "
        "cast(date_trunc('month', cast(o_orderdate as date) + 45) as date) as date, case when o_orderkey % 4 = 0 then 'Success' else 'Failed' end as status, "
        "o_totalprice + 1 as amount from {orders} where o_orderkey % 2 = 0"
    ),
    "load_3": (
        "select o_orderkey as k, o_custkey % 90 as account, o_custkey % 30 as product, o_orderkey % 10 as branch, "
        "cast(date_trunc('month', cast(o_orderdate as date) - 400) as date) as date, 'Success' as status, case when o_orderkey % 9 > 0 then o_totalprice end as amount "
        "from {orders} where o_orderkey % 3 = 0"
    ),
    # Values of several kinds, as text.
    "kinds": (
        "select lpad(cast(o_orderkey as string), 8, '0') as zeros, '+91' || cast(6000000000 + o_orderkey as string) as phone, "
        "cast(o_orderkey as string) as whole, cast(cast(o_totalprice as decimal(18, 2)) as string) as price, "
        "cast(cast(o_orderdate as date) as string) as day, cast(cast(o_orderdate as date) as string) || ' 10:11:12' as moment, "
        "case when o_orderstatus = 'F' then 'true' else 'false' end as flag, "
        "case when o_orderkey = 7 then 'x' else cast(o_orderkey as string) end as mixed, cast(null as string) as nothing, "
        "case when o_orderstatus = 'F' then null else cast(o_orderkey as string) end as gaps, o_orderpriority as words from {orders}"
    ),
    # Raw rows of the five entities, all text: a current and an older copy of each record,
    # whose ids become equal when cleaned.
    "raw_account": (
        "select 'A-' || cast(c_custkey as string) as account_id, c_mktsegment || ' *&^%' as account_name, "
        f"c_name || '@@' as email, {_phone('c_custkey')} as phone_number, '1 ' || c_name || ' St ##' as address, "
        "case when c_custkey % 2 = 0 then '2030-01-01' else '2024-01-01' end as created_date from {customer} "
        "union all select 'A#' || cast(c_custkey as string), 'Older', null, null, 'none', '2020-01-01' "
        "from {customer} "
        "union all select null, c_name, null, null, null, '2025-01-01' from {customer} "
        "where c_mktsegment = 'BUILDING' "
        "union all select '###', c_name, null, null, null, '2025-01-01' from {customer} "
        "where c_mktsegment = 'MACHINERY'"
    ),
    "raw_customer": (
        "select 'C' || cast(c_custkey as string) as customer_id, '\t ' || c_name || ' ' as customer_name, "
        f"{_EMAIL} as email, coalesce({_phone('c_custkey')}, 'none') as phone, "
        "'A-' || cast(c_custkey as string) as account_id, "
        "case when c_acctbal < 0 then 'Female' else 'Male' end as gender, "
        "cast(date '1950-01-01' + c_nationkey as string) as dob, c_mktsegment || ' Road, 7' as address, "
        "'Verified' as kyc_status, cast(date '2020-01-01' + c_nationkey as string) as registration_date, "
        "'T' || cast(c_custkey as string) as transaction_id from {customer} "
        "union all select 'C' || cast(c_custkey as string), 'Older', 'o@x.yz', 'none', 'A0', 'Male', 'unknown', "
        "'none', 'Pending', '2019-01-01', 'T0' from {customer} "
        "union all select null, c_name, 'n@x.yz', 'none', 'A0', 'Male', '1990-01-01', 'none', 'Pending', "
        "'2021-01-01', 'T0' from {customer} where c_mktsegment = 'BUILDING'"
    ),
    "raw_branch": (
        "select 'B' || cast(s_suppkey as string) as branch_id, s_name as branch_name, "
        "'Town ' || cast(s_nationkey as string) as location, 'Manager_1' as manager_name, "
        "cast(date '2000-01-01' + s_nationkey as string) as opened_date, 'East' as region, "
        f"'Urban' as branch_type, {_phone('s_suppkey')} as contact_number from {{supplier}} "
        "union all select 'B' || cast(s_suppkey as string), 'Older', 'none', 'none', '1990-01-01', 'West', "
        "'Rural', null from {supplier}"
    ),
    "raw_products": (
        "select 'P-' || cast(p_partkey as string) as product_id, p_name || '_1' as product_name, "
        "p_type || ' x' as product_type, cast(cast(p_retailprice as decimal(18, 2)) as string) as price, "
        "cast(date '2015-01-01' + p_size as string) as launch_date, "
        "case when p_size > 25 then 'True' else 'FALSE' end as is_active, "
        "nullif(p_type, 'PROMO') as category, p_brand as vendor_name from {part} "
        "union all select 'P#' || cast(p_partkey as string), 'Older', 'none', 'free', '2001-01-01', 'no', "
        "'none', 'none' from {part} where p_type <> 'PROMO'"
    ),
    "raw_transaction": (
        "select 'T-' || cast(o_orderkey as string) as transaction_id, 'A-' || cast(o_custkey as string) as account_id, "
        "'P-' || cast(o_custkey as string) as product_id, 'B-' || cast(o_custkey % 10 as string) as branch_id, "
        "substr(cast(cast(o_orderdate as date) as string), 1, 7) || '-01' as date, "
        "cast(cast(o_orderdate as date) as string) || ' 10:11:12' as timestamp, "
        "cast(cast(o_totalprice as decimal(18, 2)) as string) as amount, 'Net ' || o_orderpriority as payment_method, "
        "case o_orderstatus when 'F' then 'Success' when 'O' then 'SUC CESS' else 'Pending!' end as status, "
        "'INR' as currency, nullif(o_orderpriority, '5-LOW') as remarks, "
        "case when o_orderstatus = 'P' then 'True' else 'FALSE' end as is_refund from {orders}"
    ),
    "raw_transaction_older": (
        "select 'T#' || cast(o_orderkey as string) as transaction_id, 'A0' as account_id, 'P0' as product_id, "
        "'B0' as branch_id, case o_orderkey % 4 when 0 then '1990' when 1 then '1990-01-05 zz' else '1990-01-01' end as date, "
        "case o_orderkey % 3 when 0 then 'never' when 1 then '2024' else '12:30:00' end as timestamp, "
        "case o_orderkey % 5 when 0 then 'NaN' when 1 then 'Infinity' when 2 then '12d' when 3 then '1.5e3' else 'none' end as amount, "
        "'Cash' as payment_method, 'Success' as status, 'INR' as currency, cast(null as string) as remarks, "
        "case o_orderkey % 2 when 0 then 'y' else 'maybe' end as is_refund from {orders}"
    ),
}

# Curated rows that are there before a load; every second id meets a raw row.
TARGET_KEYS = {
    "account": ("customer", "'A' || cast(c_custkey * 2 as string)"),
    "customer": ("customer", "'C' || cast(c_custkey * 2 as string)"),
    "branch": ("supplier", "'B' || cast(s_suppkey * 2 as string)"),
    "products": ("part", "'P' || cast(p_partkey * 2 as string)"),
    "transaction": ("orders", "'T' || cast(o_orderkey * 2 as string)"),
}


def spark_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input, or a SELECT over tables in braces, as a DataFrame."""
    text = INPUTS.get(name, name)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def oracle_input(name: str) -> str:
    """The same input as a SELECT over the oracle's views."""
    return re.sub(r"\{(\w+)\}", r"\1", INPUTS[name])
