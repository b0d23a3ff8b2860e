import datetime as dt

import pytest

from coinwharf.plans.audit import quality_counts, rejected_rows
from coinwharf.operators.upsert import DuplicateSourceKeys
from coinwharf.plans.curated import SPECS, accepted, check_spellings, merge_curated, upsert_source
from coinwharf.schemas import RAW_COLUMNS, curated_schema
from fixtures import account, branch, customer, product, raw_rows, transaction

T1 = dt.datetime(2026, 1, 1)
T2 = dt.datetime(2026, 2, 2)
AS_OF = "2026-01-01"


def source(spark, entity, rows, run_ts=T1, **options):
    return upsert_source(raw_rows(spark, entity, rows), SPECS[entity], AS_OF, run_ts, **options)


def keyed(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("entity", list(SPECS))
def test_source_has_the_curated_schema(spark, entity):
    got = source(spark, entity, [])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in curated_schema(entity)]
    raw = [SPECS[entity].raw_name(c) for c in SPECS[entity].cleaned]
    assert set(raw) <= set(RAW_COLUMNS[entity])


def test_account(spark):
    rows = [
        account("A-1", "Ab *&^%", "12345", "4 x St ##", "2030-01-01"),
        account("A1", "Older", created="2029-01-01"),
        account("A2", created=None),
        account("A3", created="not a day", phone=None),
        account(None),
    ]
    got = keyed(source(spark, "account", rows), "account_id")
    assert set(got) == {"A1", "A2", "A3"}
    a = got["A1"]
    assert (a.account_name, a.phone_number, a.address, a.created_date) == ("Ab", "", "4 x St   ", dt.date(2026, 1, 1))
    assert a.created_at == a.updated_at == T1
    assert got["A2"].created_date is None and got["A3"].created_date is None
    assert got["A3"].phone_number == "" and "email" not in a.asDict()


def test_customer(spark):
    rows = [
        customer("C1", "A-1", "  Ann \t", "ANN@x.com", registered="2024-01-01"),
        customer("C1", "A-1", "Ann Late", "bad@@x", "+91-9876543210", registered="2024-06-01"),
        customer("C2", "A1", name=None),
        customer("C3", "A1", email=None),
        customer("C4", "A1", phone=None),
        customer(None, "A1"),
    ]
    got = keyed(source(spark, "customer", rows), "customer_id")
    assert set(got) == {"C1"}
    c = got["C1"]
    assert (c.name, c.email, c.phone, c.account_id) == ("Ann Late", None, "", "A1")
    assert c.load_time == c.created_at == c.updated_at == T1
    with_null = source(spark, "customer", rows, null_keys=True)
    assert {r.customer_id for r in with_null.collect()} == {"C1", None}
    normalized = source(spark, "customer", rows, normalize_phone=True).first()
    assert normalized.phone == "+919876543210"


def test_branch(spark):
    got = keyed(source(spark, "branch", [branch("B1", contact="+91-8274350418"), branch("B1", opened="2020-01-01")]), "branch_id")
    assert got["B1"].opened_date == dt.date(2020, 1, 1) and got["B1"].contact_number == "9876543210"


def test_products(spark):
    rows = [product("P-1", active="False", price="x", vendor_name="Vendor_1"), product("P2", category=None)]
    got = keyed(source(spark, "products", rows), "product_id")
    assert set(got) == {"P1"}
    p = got["P1"]
    assert (p.product_name, p.product_type, p.vendor_name) == ("Product_P1", "SavingsAccount", "Vendor1")
    assert p.is_active == "false" and p.price is None


def test_transaction(spark):
    got = source(spark, "transaction", [transaction("T-1", "A-1", "P-1", "B-1", is_refund="True", status="Suc cess")]).first()
    assert (got.transaction_id, got.account_id, got.product_id, got.branch_id) == ("T1", "A1", "P1", "B1")
    assert (got.payment_method, got.status, got.is_refund, got.amount) == ("NetBanking", "Success", True, 1000.0)
    assert got.date == dt.date(2025, 6, 15) and got.timestamp == dt.datetime(2025, 6, 16)


@pytest.mark.parametrize(
    "entity,make,kept",
    [
        ("customer", lambda k, **o: customer(k, "A1", **o), {"created_at", "load_time"}),
        ("branch", branch, {"created_at"}),
        ("account", account, {"created_at"}),
        ("products", product, {"created_at", "updated_at"}),
        ("transaction", lambda k, **o: transaction(k, "A1", **o), {"created_at"}),
    ],
)
def test_second_load(spark, entity, make, kept):
    """Updates keep the columns of their list, inserts take the new stamp, the rest is untouched."""
    key = SPECS[entity].key
    first = source(spark, entity, [make("K1"), make("K2")])
    target = merge_curated(first.limit(0), first, SPECS[entity])
    assert {r.action for r in target.collect()} == {"insert"}
    merged = merge_curated(target, source(spark, entity, [make("K2"), make("K3")], T2), SPECS[entity])
    got = keyed(merged, key)
    assert {k: r.action for k, r in got.items()} == {"K1": "keep", "K2": "update", "K3": "insert"}
    for stamp in SPECS[entity].stamps:
        assert got["K1"][stamp] == T1
        assert got["K2"][stamp] == (T1 if stamp in kept else T2)
        assert got["K3"][stamp] == T2


def test_ties_are_settled_by_arrival_then_by_value(spark):
    raw = raw_rows(spark, "account", [account("A1", "First"), account("A1", "Second")])
    from pyspark.sql import functions as F

    stamped = raw.withColumn(
        "ingestion_timestamp", F.when(F.col("account_name") == "Second", F.lit(T2)).otherwise(F.lit(T1))
    )
    for parts in (1, 4):
        got = upsert_source(stamped.repartition(parts), SPECS["account"], AS_OF, T1).first()
        assert got.account_name == "Second"
        got = upsert_source(raw.repartition(parts), SPECS["account"], AS_OF, T1).first()
        assert got.account_name == "First"


def test_strict_refuses_two_spellings_of_a_key(spark):
    raw = raw_rows(spark, "account", [account("A-1"), account("A-1"), account("A2"), account(None)])
    check_spellings(raw, SPECS["account"])
    with pytest.raises(DuplicateSourceKeys):
        check_spellings(raw.union(raw_rows(spark, "account", [account("A1")])), SPECS["account"])
    check_spellings(raw_rows(spark, "customer", [customer("C-1", "A"), customer("C1", "A")]), SPECS["customer"])


def test_required_fields_reach_the_scan(spark, folder):
    raw_rows(spark, "products", [product("P1")]).write.parquet(folder + "/raw")
    plan = accepted(spark.read.parquet(folder + "/raw"), SPECS["products"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(category)" in plan


def test_quality_counts_and_rejects(spark):
    rows = [customer("C1", "A", dob="x"), customer(None, "A"), customer("C3", "A", email=None, name=None)]
    raw = raw_rows(spark, "customer", rows)
    got = quality_counts(raw, SPECS["customer"]).first().asDict()
    assert got == {"rows_in": 3, "rejected": 2, "unreadable_dob": 1, "unreadable_registration_date": 0}
    assert quality_counts(raw, SPECS["customer"], null_keys=True).first().rejected == 1
    missing = sorted(tuple(r.missing) for r in rejected_rows(raw, SPECS["customer"]).collect())
    assert missing == [("customer_id",), ("customer_name", "email")]
