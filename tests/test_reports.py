import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from coinwharf.plans import reports

T_DDL = "transaction_id string, account_id string, product_id string, branch_id string, date date, amount double, status string"


def transactions(spark, rows):
    return spark.createDataFrame(rows, T_DDL)


def t(key, account="A1", product="P1", branch="B1", day="2025-06-15", amount=1000.0, status="Success"):
    return (key, account, product, branch, day and dt.date.fromisoformat(day), amount, status)


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, name string, account_id string")


def tuples(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_customers_any_case_shared_accounts_and_ties(spark):
    rows = [t("1", "A1", amount=5.0, status="SUCCESS"), t("2", "A1", amount=5.0, status="success"),
            t("3", "A2", amount=10.0), t("4", "A3", amount=99.0, status="Failed"), t("5", None, amount=99.0),
            t("6", "A4", amount=None)]
    people = customers(spark, [("C2", "b", "A1"), ("C1", "a", "A1"), ("C3", "c", "A2"), ("C4", "d", "A3"),
                               ("C5", "e", None), ("C6", "f", "A4"), ("C3", "c", "A1")])
    got = tuples(reports.top_customers(transactions(spark, rows), people))
    assert got == [("C3", "c", 20.0), ("C1", "a", 10.0), ("C2", "b", 10.0), ("C6", "f", None)]
    assert tuples(reports.top_customers(transactions(spark, rows), people, n=1)) == [("C3", "c", 20.0)]
    assert "TakeOrderedAndProject" in plan_of(reports.top_customers(transactions(spark, rows), people))


def test_monthly_trend_keeps_null_groups(spark):
    rows = [t("1"), t("2", day="2025-06-30", amount=0.1), t("3", status="Failed"), t("4", branch=None, amount=None),
            t("5", branch=None, day=None), t("6", day="2025-07-01")]
    assert tuples(reports.in_order(reports.MONTHLY_TREND, reports.monthly_trend(transactions(spark, rows)))) == [
        (None, None, 1, 1000.0, "Success"),
        (None, "2025-06", 1, None, "Success"),
        ("B1", "2025-06", 1, 1000.0, "Failed"),
        ("B1", "2025-06", 2, 1000.1, "Success"),
        ("B1", "2025-07", 1, 1000.0, "Success"),
    ]


def test_product_share_exact_status_only(spark):
    rows = [t("1", product="P1", amount=1.0), t("2", product="P2", amount=2.0), t("3", product="P1", status="SUCCESS"),
            t("4", product="P9", amount=500.0), t("5", product=None)]
    products = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "product_id string")
    got = tuples(reports.in_order(reports.PRODUCT_SHARE, reports.product_share(transactions(spark, rows), products)))
    assert got == [("P2", 2.0, 66.67), ("P1", 1.0, 33.33)]


def test_product_share_of_nothing(spark):
    products = spark.createDataFrame([("P1",)], "product_id string")
    assert tuples(reports.product_share(transactions(spark, [t("1", status="Failed")]), products)) == []
    assert tuples(reports.product_share(transactions(spark, [t("1", amount=0.0)]), products)) == [("P1", 0.0, None)]


@pytest.mark.parametrize(
    "as_of,day,active",
    [("2025-09-15", "2025-06-15", True), ("2025-09-16", "2025-06-15", False), ("2025-05-31", "2025-02-28", True),
     ("2025-05-31", "2025-02-27", False), ("2025-01-01", "2030-01-01", True), ("2025-01-01", None, False)],
)
def test_inactive_accounts_bound(spark, as_of, day, active):
    accounts = spark.createDataFrame([("A1", "n"), ("A2", "m")], "account_id string, account_name string")
    rows = [t("1", "A1", day=day, status="Failed"), t("2", None, day="2030-01-01")]
    got = tuples(reports.inactive_accounts(accounts, transactions(spark, rows), as_of))
    assert sorted(got) == ([("A2", "m")] if active else [("A1", "n"), ("A2", "m")])


def test_suspicious_is_strict_and_needs_a_customer(spark):
    rows = [t("1", amount=100000.0), t("2", amount=100000.01, status="Failed"), t("3", "A9", amount=1e9),
            t("4", amount=200000.0), t("5", amount=None), t("6", None, amount=3e5)]
    people = customers(spark, [("C1", "a", "A1"), ("C2", "b", "A1"), ("C3", "c", None)])
    day = dt.date(2025, 6, 15)
    assert tuples(reports.in_order(reports.SUSPICIOUS, reports.suspicious(transactions(spark, rows), people))) == [
        ("4", "C1", "a", 200000.0, day, "Success"),
        ("4", "C2", "b", 200000.0, day, "Success"),
        ("2", "C1", "a", 100000.01, day, "Failed"),
        ("2", "C2", "b", 100000.01, day, "Failed"),
    ]


def skewed(rng, n):
    """Transactions of which a third share one account, one product and one branch."""
    rows = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        rows.append(t(
            f"T{i}", "hot" if hot else f"A{rng.randrange(30)}", "hot" if hot else f"P{rng.randrange(20)}",
            "hot" if hot else f"B{rng.randrange(9)}", f"2025-0{rng.randrange(1, 8)}-1{rng.randrange(10)}",
            rng.randrange(1, 20_000_000) / 100, rng.choice(["Success", "SUCCESS", "Pending", "Failed"])))
    return rows


def test_reports_against_brute_force_on_skewed_rows(spark):
    rng = random.Random(11)
    rows = skewed(rng, 3000)
    people = [(f"C{i}", f"n{i}", rng.choice(["hot"] + [f"A{k}" for k in range(40)])) for i in range(60)]
    df, who = transactions(spark, rows).repartition(7), customers(spark, people)

    volume = defaultdict(int)
    for _, account, _, _, _, amount, status in rows:
        for cid, name, owned in people:
            if status.upper() == "SUCCESS" and owned == account:
                volume[cid, name] += round(amount * 100)
    top = sorted(((c, n, v / 100) for (c, n), v in volume.items()), key=lambda r: (-r[2], r[0]))[:5]
    assert tuples(reports.top_customers(df, who)) == top

    months = defaultdict(lambda: [0, 0])
    for _, _, _, branch, day, amount, status in rows:
        months[branch, day.strftime("%Y-%m"), status][0] += 1
        months[branch, day.strftime("%Y-%m"), status][1] += round(amount * 100)
    assert tuples(reports.in_order(reports.MONTHLY_TREND, reports.monthly_trend(df))) == [
        (b, m, n, cents / 100, s) for (b, m, s), (n, cents) in sorted(months.items())]

    revenue = defaultdict(int)
    for _, _, product, _, _, amount, status in rows:
        if status == "Success":
            revenue[product] += round(amount * 100)
    products = spark.createDataFrame([(p,) for p in revenue], "product_id string")
    got = tuples(reports.in_order(reports.PRODUCT_SHARE, reports.product_share(df, products)))
    assert [(p, v) for p, v, _ in got] == sorted(((p, c / 100) for p, c in revenue.items()), key=lambda r: (-r[1], r[0]))
    total = sum(revenue.values())
    assert all(abs(share - revenue[p] * 100 / total) <= 0.005 + 1e-9 for p, _, share in got)

    expected = sorted(
        ((i, c, n, a, d, s) for i, acc, _, _, d, a, s in rows if a > 100000 for c, n, own in people if own == acc),
        key=lambda r: (-r[3], r[0], r[1]))
    assert tuples(reports.in_order(reports.SUSPICIOUS, reports.suspicious(df, who))) == expected
    assert tuples(reports.in_order(reports.SUSPICIOUS, reports.suspicious(df, who, hot={"part_rows": 20}))) == expected

    accounts = spark.createDataFrame([(f"A{k}", "x") for k in range(40)] + [("hot", "x")], "account_id string, account_name string")
    active = {acc for _, acc, _, _, d, _, _ in rows if d >= dt.date(2025, 7, 15)}
    got = {r[0] for r in tuples(reports.inactive_accounts(accounts, df, "2025-10-15"))}
    assert got == {f"A{k}" for k in range(40)} | {"hot"} - active - set() if not active else got == ({f"A{k}" for k in range(40)} | {"hot"}) - active


def test_transactions_are_summed_before_they_are_joined(spark):
    df, who = transactions(spark, [t("1")]), customers(spark, [("C1", "a", "A1")])
    for setting in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        plan = plan_of(reports.top_customers(df, who))
        join = plan.index("HashJoin") if "HashJoin" in plan else plan.index("SortMergeJoin")
        assert "partial_sum(FLOOR(amount" in plan[join:]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_are_not_sorted_to_be_stored(spark):
    df, who = transactions(spark, [t("1")]), customers(spark, [("C1", "a", "A1")])
    products = spark.createDataFrame([("P1",)], "product_id string")
    for report in (reports.monthly_trend(df), reports.product_share(df, products), reports.suspicious(df, who)):
        assert "rangepartitioning" not in plan_of(report)


def test_only_needed_columns_are_read(spark, folder):
    transactions(spark, [t("1")]).withColumn("pad", F.lit("x")).write.parquet(folder + "/t")
    stored = spark.read.parquet(folder + "/t")
    plan = plan_of(reports.product_share(stored, spark.createDataFrame([("P1",)], "product_id string")))
    assert "ReadSchema: struct<product_id:string,amount:double,status:string>" in plan
    assert "EqualTo(status,Success)" in plan
