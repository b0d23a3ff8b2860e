"""SQL that must give the same rows as each query."""

from __future__ import annotations

from coinwharf.checks.inputs import TARGET_KEYS, oracle_input
from coinwharf.functions.text import WHITESPACE
from coinwharf.schemas import CURATED_DDL

# The rules for e-mail addresses and phone numbers.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^(\+91)?[6-9][0-9]{9}$"
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?"


def money(column: str) -> str:
    """A sum that does not depend on the order of rows."""
    return f"cast(sum(cast({column} as decimal(18, 2))) as double)"


def strip(column: str, but: str = "", by: str = "") -> str:
    return f"regexp_replace({column}, '[^A-Za-z0-9{but}]', '{by}', 'g')"


def phone(column: str) -> str:
    return f"case when regexp_matches({column}, '{PHONE}') then {column} else '' end"


def email(column: str) -> str:
    return f"case when regexp_matches({column}, '{EMAIL}') then lower({column}) end"


def trim(column: str) -> str:
    return f"trim({column}, '{WHITESPACE}')"


def flag_text(column: str) -> str:
    return (
        f"case when lower(trim({column})) in ('true', 'false') then lower(trim({column})) else {column} end"
    )


def number(column: str) -> str:
    """Finite decimal numbers only."""
    return f"case when regexp_full_match(trim({column}), '{NUMBER}') then try_cast({column} as double) end"


def day(column: str) -> str:
    """Whole days only, alone or before a whole time."""
    return f"case when regexp_full_match({column}, '{DAY}') then try_cast({column} as date) end"


def instant(column: str) -> str:
    return f"case when regexp_full_match({column}, '{DAY}') then try_cast({column} as timestamp) end"


def flag(column: str) -> str:
    return f"case lower(trim({column})) when 'true' then true when 'false' then false end"


READ = {"double": number, "date": day, "timestamp": instant, "boolean": flag}


def table(name: str) -> str:
    return f"({oracle_input(name)})"


ORACLE = {
    "top_customers": f"""
        select c.customer_id, c.name as customer_name, {money('t.amount')} as total_volume
        from {table('transactions')} t join {table('customers')} c on t.account_id = c.account_id
        where upper(t.status) = 'F' group by c.customer_id, c.name
        order by total_volume desc, customer_id limit 5""",
    "monthly_trend": f"""
        select branch_id, strftime(date, '%Y-%m') as year_month, count(*) as total_transactions,
               {money('amount')} as total_amount, line as transaction_status
        from {table('sales')} group by 1, 2, 5""",
    "product_share": f"""
        with revenue as (
            select p.product_id, {money('s.amount')} as total_revenue
            from {table('sales')} s join {table('products')} p on s.product_id = p.product_id
            where s.status = 'R' group by p.product_id)
        select product_id, total_revenue,
               round(total_revenue * 100 / (select {money('total_revenue')} from revenue), 2) as revenue_percentage
        from revenue""",
    "inactive_accounts": f"""
        select a.account_id, a.account_name from {table('accounts')} a
        left join {table('transactions')} t
          on a.account_id = t.account_id and t.date >= date '2001-08-01' - interval 3 month
        where t.account_id is null""",
    "suspicious": f"""
        select t.transaction_id, c.customer_id, c.name, t.amount, t.date, t.status
        from {table('transactions')} t join {table('customers')} c on t.account_id = c.account_id
        where t.amount > 450000""",
    "suspicious_hot": f"""
        with t as (select *, case when day(date) > 10 then 'hot' else 'cold' end as account from {table('transactions')}
            where amount > 400000),
        c as (select *, case when customer_id % 10 > 3 then 'hot' else 'cold' end as account from {table('customers')})
        select c.customer_id, t.status, count(*) as n, {money('t.amount')} as amount
        from t join c on t.account = c.account group by c.customer_id, t.status""",
    "latest_per_customer": f"""
        select account_id, date, transaction_id, amount from (
            select *, row_number() over (partition by account_id order by date desc, transaction_id desc) as place
            from {table('transactions')}) where place = 1""",
    "share_of_total": f"""
        with g as (select branch_id, {money('amount')} as total from {table('sales')} group by branch_id)
        select branch_id, total, round(total * 100 / (select {money('total')} from g), 2) as percentage from g""",
    "rows_without_match": f"""
        select product_id from {table('products')} where product_id not in (
            select product_id from {table('sales')} group by product_id having max(amount) > 94000)""",
    "upsert_rows": f"""
        select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
               case when s.o_orderkey is null then t.o_totalprice else s.o_totalprice end as o_totalprice,
               case when t.o_orderkey is null then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
               case when s.o_orderkey is null then t.day else s.day end as day,
               case when s.o_orderkey is null then 'keep' when t.o_orderkey is null then 'insert'
                    else 'update' end as action
        from {table('book')} t full outer join {table('book_changes')} s on t.o_orderkey = s.o_orderkey""",
    "updated_rows": f"""
        select t.o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) as o_totalprice,
               coalesce(s.o_orderstatus, t.o_orderstatus) as o_orderstatus, t.day
        from {table('book')} t left join {table('book_changes')} s on t.o_orderkey = s.o_orderkey""",
    "partitioned_table": "select event_id, event_type, cast(ts as date) as event_day from events",
    "trim_names": f"select id, {trim('padded')} as name from {table('texts')}",
    "validate_email": f"select id, {email('email')} as email from {table('texts')}",
    "validate_phone": f"""
        select id, {phone('phone')} as phone, {phone("replace(phone, '-', '')")} as normalized
        from {table('texts')}""",
    "strip_non_alnum": f"select id, {strip('dirty')} as stripped from {table('texts')}",
    "strip_non_word": f"select id, {strip('dirty', but='_')} as stripped from {table('texts')}",
    "blank_non_alnum": f"select id, {strip('dirty', by=' ')} as blanked from {table('texts')}",
    "parse_dates": f"select id, try_cast(text as date) as day from {table('days')}",
    "clamp_future_date": f"""
        select id, case when try_cast(text as date) > date '2000-01-01' then date '2000-01-01'
                        else try_cast(text as date) end as day from {table('days')}""",
    "three_months_back": f"select id, cast(day - interval 3 month as date) as day from {table('days')}",
    "month_text": f"select id, strftime(day, '%Y-%m') as year_month from {table('days')}",
    "ratio_or_null": """
        select l_orderkey, l_linenumber, l_partkey,
               case when l_discount <> 0 then round(l_tax * 100 / l_discount, 2) end as ratio from lineitem""",
    "bool_casts": f"""
        select id, case lower(flag) when 'true' then true when 'false' then false end as as_boolean,
               {flag_text('flag')} as as_text, cast(done as varchar) as done_text from {table('days')}""",
    "required_fields": f"select id, a, b from {table('required')} where a is not null and b is not null",
    "status_filters": f"""
        select account_id, count(*) filter (where upper(status) = 'F') as any_case,
               count(*) filter (where status = 'F') as exact, count(*) filter (where amount > 100000) as large,
               count(*) filter (where date >= date '2001-08-01' - interval 3 month) as recent
        from {table('transactions')} group by account_id""",
    "message_paths": f"""
        select event_id, case when event_id % 7 <> 0 then 'gs://' || bucket || '/' || name end as path
        from {table('objects')}""",
    "undecodable_messages": f"select event_id, bucket from {table('objects')} where event_id % 5 = 0",
    "stream_messages": f"select bucket, name, 'gs://' || bucket || '/' || name as path from {table('objects')}",
}

ORACLE["upsert_action_counts"] = (
    f"select action, count(*) as rows from ({ORACLE['upsert_rows']}) group by action"
)
ORACLE["stored_upsert"] = (
    "select o_orderkey, o_totalprice, o_orderstatus, cast(date_trunc('month', day) as date) as day "
    f"from ({ORACLE['upsert_rows']})"
)
ORACLE["replaced_table"] = f"select * from ({ORACLE['monthly_trend']}) where total_transactions > 1"

_ROUTED = f"""
    select event_id, path, case when name like '%account%' then 'account' when name like '%branch%' then 'branch'
        when name like '%customer%' then 'customer' when name like '%product%' then 'products'
        when name like '%transaction%' then 'transaction' end as tbl
    from (select *, lower(regexp_extract(path, '[^/]*$')) as name from {table('paths')})"""
ORACLE["route_files"] = f'select event_id, tbl as "table" from ({_ROUTED}) where tbl is not null'
ORACLE["skipped_files"] = f"select event_id, path from ({_ROUTED}) where tbl is null"
ORACLE["planned_loads"] = f"""
    select tbl as "table", case tbl when 'account' then 'overwrite' else 'append' end as write_mode,
           count(*) as files
    from ({_ROUTED}) where tbl is not null group by 1, 2"""

# -- curated loads ---------------------------------------------------------------------

_RAW_TRANSACTIONS = f"({oracle_input('raw_transaction')} union all {oracle_input('raw_transaction_older')})"


def raw(entity: str) -> str:
    return _RAW_TRANSACTIONS if entity == "transaction" else table(f"raw_{entity}")


# (rows accepted, date that decides, cleaned columns that differ from the raw column)
CLEANING = {
    "account": (
        f"account_id is not null and {strip('account_id')} <> ''",
        "created_date",
        {
            "account_id": strip("account_id"),
            "account_name": strip("account_name"),
            "phone_number": phone("phone_number"),
            "address": strip("address", by=" "),
            "created_date": "case when try_cast(created_date as date) > {as_of} then {as_of} "
            "else try_cast(created_date as date) end",
        },
    ),
    "customer": (
        "customer_id is not null and customer_name is not null and email is not null and phone is not null",
        "registration_date",
        {
            "name": trim("customer_name"),
            "email": email("email"),
            "phone": phone("phone"),
            "account_id": strip("account_id"),
            "dob": "try_cast(dob as date)",
            "registration_date": "try_cast(registration_date as date)",
        },
    ),
    "branch": (
        "branch_id is not null",
        "opened_date",
        {"opened_date": "try_cast(opened_date as date)", "contact_number": phone("contact_number")},
    ),
    "products": (
        "product_id is not null and product_name is not null and category is not null",
        "launch_date",
        {
            "product_id": strip("product_id"),
            "product_name": strip("product_name", but="_"),
            "product_type": strip("product_type"),
            "price": number("price"),
            "launch_date": "try_cast(launch_date as date)",
            "is_active": flag_text("is_active"),
            "category": strip("category"),
            "vendor_name": strip("vendor_name"),
        },
    ),
    "transaction": (
        "transaction_id is not null",
        "date",
        {
            "transaction_id": strip("transaction_id"),
            "account_id": strip("account_id"),
            "product_id": strip("product_id"),
            "branch_id": strip("branch_id"),
            "date": day("date"),
            "timestamp": instant("timestamp"),
            "amount": number("amount"),
            "payment_method": strip("payment_method"),
            "status": strip("status"),
            "is_refund": flag("is_refund"),
        },
    ),
}
STAMPS = ("load_time", "created_at", "updated_at")
KEPT = {"customer": ("load_time", "created_at"), "products": ("created_at", "updated_at")}


def columns(entity: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ")) for part in CURATED_DDL[entity].split(",")]


def source(entity: str, as_of: str = "date '2026-01-01'") -> str:
    """The latest cleaned row per key."""
    accepted, newest, rules = CLEANING[entity]
    names = [c for c, _ in columns(entity) if c not in STAMPS]
    cleaned = ", ".join(f"{rules.get(c, c)} as {c}" for c in names).replace("{as_of}", as_of)
    return (
        f"(select {', '.join(names)} from (select *, row_number() over (partition by {names[0]} "
        f"order by newest desc nulls last) as place from (select {cleaned}, {day(newest)} as newest "
        f"from {raw(entity)} where {accepted})) where place = 1)"
    )


def curated(entity: str) -> str:
    base, key_text = TARGET_KEYS[entity]
    key = columns(entity)[0][0]
    new, old = "date '2026-01-01'", "date '2025-12-01'"
    picks = [f"coalesce(s.{key}, t.k) as {key}"]
    for name, kind in columns(entity)[1:]:
        if name in STAMPS:
            kept = name in KEPT.get(entity, ("created_at",))
            was_there = "t.k is not null" if kept else "s." + key + " is null"
            picks.append(f"case when {was_there} then {old} else {new} end as {name}")
        elif kind == "string":
            picks.append(f"case when s.{key} is null then 'old' else s.{name} end as {name}")
        elif name == "timestamp":
            picks.append("strftime(s.timestamp, '%Y-%m-%d %H:%M:%S') as timestamp")
        else:
            picks.append(f"s.{name} as {name}")
    picks.append(
        f"case when s.{key} is null then 'keep' when t.k is null then 'insert' else 'update' end as action"
    )
    return (
        f"select {', '.join(picks)} from {source(entity)} s "
        f"full outer join (select {key_text} as k from {base}) t on s.{key} = t.k"
    )


for _entity in CURATED_DDL:
    ORACLE[f"curated_{_entity}"] = curated(_entity)
    _names = ", ".join(name for name, _ in columns(_entity))
    ORACLE[f"stored_curated_{_entity}"] = f"select {_names} from ({curated(_entity)})"


def _unreadable(*casts: tuple[str, str]) -> str:
    tests = [f"count(*) filter (where {c} is not null and ({READ[t](c)}) is null)" for c, t in casts]
    return " + ".join(tests)


_TYPED = {
    "account": (("created_date", "date"),),
    "customer": (("dob", "date"), ("registration_date", "date")),
    "branch": (("opened_date", "date"),),
    "products": (("price", "double"), ("launch_date", "date")),
    "transaction": (("date", "date"), ("timestamp", "timestamp"), ("amount", "double"), ("is_refund", "boolean")),
}


def _quality(entity: str) -> str:
    return (
        f"select '{entity}' as entity, count(*) as rows_in, "
        f"count(*) filter (where not ({CLEANING[entity][0]})) as rejected, "
        f"{_unreadable(*_TYPED[entity])} as unreadable from {raw(entity)}"
    )


ORACLE["quality_of_raw"] = " union all ".join(_quality(e) for e in CURATED_DDL)
ORACLE["rejected_raw_rows"] = (
    f"select customer_name, email, 'customer_id' as missing from {raw('customer')} where customer_id is null"
)
ORACLE["rejected_keys"] = (
    "select account_id, account_name, 'account_id' as missing "
    f"from {raw('account')} where account_id is null or {strip('account_id')} = ''"
)
_PICKS = {
    "account": ("account_id", "account_name", "created_date"),
    "branch": ("branch_id", "branch_name", "opened_date"),
    "customer": ("customer_id", "customer_name", "registration_date"),
    "products": ("product_id", "product_name", "launch_date"),
    "transaction": ("transaction_id", "status", "date"),
}
ORACLE["raw_load"] = " union all ".join(
    f"select '{e}' as entity, {i} as id, {n} as name, {d} as day, date '2026-01-01' as ingested from {raw(e)}"
    for e, (i, n, d) in _PICKS.items()
)

# -- the chain ---------------------------------------------------------------------------

_AS_OF = "date '2001-08-01'"
_CHAIN = f"""
    with c as {source('customer', _AS_OF)}, a as {source('account', _AS_OF)},
    p as {source('products', _AS_OF)}, t as {source('transaction', _AS_OF)},
    revenue as (
        select p.product_id, {money('t.amount')} as total_revenue from t join p on t.product_id = p.product_id
        where t.status = 'Success' group by p.product_id)
    select * from (
        select 'top_five_customer_trans' as report, c.customer_id as key, c.name as detail, 1 as rows,
               {money('t.amount')} as amount
        from t join c on t.account_id = c.account_id where upper(t.status) = 'SUCCESS'
        group by c.customer_id, c.name order by amount desc, key limit 5)
    union all
    select 'monthly_trans_trend_per_branch', branch_id, strftime(date, '%Y-%m') || ' ' || status, count(*),
           {money('amount')}
    from t group by branch_id, strftime(date, '%Y-%m'), status
    union all
    select 'prod_wise_revenue', product_id,
           cast(round(total_revenue * 100 / (select {money('total_revenue')} from revenue), 2) as varchar),
           1, total_revenue
    from revenue
    union all
    select 'Last_three_month_inact_acct', account_id, account_name, 1, null from a
    where not exists (
        select 1 from t where t.account_id = a.account_id and t.date >= {_AS_OF} - interval 3 month)
    union all
    select 'suspicious_trans', t.transaction_id,
           c.customer_id || ' ' || c.name || ' ' || cast(t.date as varchar) || ' ' || t.status, 1, t.amount
    from t join c on t.account_id = c.account_id where t.amount > 100000"""
ORACLE["batch_chain"] = _CHAIN
ORACLE["stream_chain"] = _CHAIN
ORACLE["message_chain"] = (
    _CHAIN
    + "".join(f" union all select 'raw', '{e}', null, count(*), null from {raw(e)}" for e in CURATED_DDL)
    + " union all select 'arrivals', 'undecodable', null, count(*), null from nation"
    + " union all select 'arrivals', 'not_csv', null, count(*), null from region"
)


def _audit(entity: str) -> str:
    quality, accepted = f"({_quality(entity)})", f"(select count(*) as n from {source(entity)})"
    key, lines = columns(entity)[0][0], []
    collapsed = (
        f"(select count(*) as n from (select {CLEANING[entity][2].get(key, key)} as k from {raw(entity)} "
        f"where {CLEANING[entity][0]} group by k having min({key}) <> max({key})))"
    )
    for run in ("first", "second"):
        lines.append(f"select '{run}' as run_id, '{entity}' as entity, 'collapsed' as metric, n as rows from {collapsed}")
        inserted, updated = ("n", "0") if run == "first" else ("0", "n")
        lines += [f"select '{run}' as run_id, '{entity}' as entity, '{m}' as metric, {m} as rows from {quality}"
                  for m in ("rows_in", "rejected")]
        lines += [f"select '{run}', '{entity}', '{m}', {v} from {accepted}"
                  for m, v in (("insert", inserted), ("update", updated), ("keep", "0"))]
    return " union all ".join(lines)


ORACLE["chain_audit"] = " union all ".join(_audit(e) for e in CURATED_DDL)

# -- the order of reports, and reports kept up to date by what changed -----------------------

ORACLE["product_order"] = (
    "select row_number() over (order by total_revenue desc, product_id) as place, product_id "
    f"from ({ORACLE['product_share']})"
)
ORACLE["suspicious_order"] = (
    "select row_number() over (order by amount desc, transaction_id, customer_id) as place, transaction_id, customer_id "
    f"from ({ORACLE['suspicious']})"
)
# Later loads replace rows of earlier ones.
_FINAL = (
    f"(select * from {table('load_3')} union all select * from {table('load_2')} where k % 3 <> 0 "
    f"union all select * from {table('load_1')} where k % 3 <> 0 and k % 2 <> 0)"
)
ORACLE["trend_by_deltas"] = (
    "select 'B' || cast(branch as varchar) as branch_id, strftime(date, '%Y-%m') as year_month, "
    f"count(*) as total_transactions, {money('amount')} as total_amount, status as transaction_status "
    f"from {_FINAL} group by branch, year_month, status"
)
ORACLE["share_by_deltas"] = f"""
    with revenue as (
        select 'P' || cast(product as varchar) as product_id, {money('amount')} as total_revenue from {_FINAL}
        where status = 'Success' and product in (select p_partkey % 25 from part) group by product)
    select product_id, total_revenue,
           round(total_revenue * 100 / (select {money('total_revenue')} from revenue), 2) as revenue_percentage
    from revenue"""
ORACLE["customers_by_deltas"] = f"""
    select c_custkey as customer_id, c_name as customer_name, {money('amount')} as total_volume
    from {_FINAL} join customer on account = c_custkey % 120 where upper(status) = 'SUCCESS'
    group by c_custkey, c_name order by total_volume desc, customer_id, customer_name limit 50"""
ORACLE["inactive_by_state"] = " union all ".join(
    f"select 'A' || cast(a as varchar) as account_id, '{day}' as as_of "
    f"from (select distinct c_custkey % 120 as a from customer) where a not in "
    f"(select account from {_FINAL} where date >= date '{day}' - interval 3 month)"
    for day in ("2000-01-01", "2001-06-01", "2001-12-15")
)


def _kind(name: str) -> str:
    def comes_back(kind: str) -> str:
        return f"bool_and(coalesce(cast(try_cast({name} as {kind}) as varchar) = {name}, false)) filter (where {name} is not null)"

    places, digits = f"length(split_part({name}, '.', 2))", f"length(replace(split_part({name}, '.', 1), '-', ''))"
    decimal = f"bool_and(regexp_full_match({name}, '-?(0|[1-9][0-9]*)[.][0-9]+'))"
    return (
        f"select '{name}' as name, count({name}) as n_values, case when count({name}) = 0 then 'string' "
        f"when {comes_back('bigint')} then 'bigint' when {decimal} and min({places}) = max({places}) "
        f"then 'decimal(' || cast(max({digits}) + max({places}) as varchar) || ',' || cast(max({places}) as varchar) || ')' "
        f"when {comes_back('date')} then 'date' when {comes_back('timestamp')} then 'timestamp' "
        f"when {comes_back('boolean')} then 'boolean' else 'string' end as kind from {table('kinds')}"
    )


ORACLE["inferred_types"] = " union all ".join(
    map(_kind, ("zeros", "phone", "whole", "price", "day", "moment", "flag", "mixed", "nothing", "gaps", "words"))
)
