"""Summaries kept by signed changes against the same reports over all rows."""

import datetime as dt
import random

import pytest

from coinwharf.plans import reports, summaries
from coinwharf.plans.chain import Run, run_files
from coinwharf.plans.curated import SPECS
from coinwharf.plans.lake import Lake
from coinwharf.schemas import curated_schema
from coinwharf.sources.landing import list_files
from coinwharf.sources.tables import SnapshotTable
from fixtures import account, customer, product, transaction, write_csv

TS = dt.datetime(2025, 7, 1, tzinfo=dt.timezone.utc)
AS_OF = dt.date(2025, 7, 1)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_summaries_follow_inserts_and_updates(spark, folder, monkeypatch):
    monkeypatch.setattr(summaries, "ADDED_UP", 2)
    rng = random.Random(6)
    lake, spec = Lake(spark, folder), SPECS["transaction"]
    table = lake.curated("transaction")
    names = curated_schema("transaction").names
    accounts = spark.createDataFrame([(f"A{i}", "n") for i in range(6)], "account_id string, account_name string")
    products = spark.createDataFrame([(f"P{i}",) for i in range(3)], "product_id string")
    customers = spark.createDataFrame([(f"C{i}", "n", f"A{i}") for i in range(6)], "customer_id string, name string, account_id string")
    for n in range(6):
        rows = []
        for k in {rng.randrange(14) for _ in range(7)}:
            values = {
                "transaction_id": f"T{k}", "account_id": rng.choice([None, "A1", "A2", "A3"]), "product_id": rng.choice([None, "P1", "P2"]),
                "branch_id": rng.choice([None, "B1"]), "date": rng.choice([None, *(dt.date(2025, m, 3) for m in (1, 2, 5, 6))]),
                "status": rng.choice([None, "Success", "SUCCESS", "Failed"]), "amount": rng.choice([None, 0.1, 1e9, 2.25]),
            }
            rows.append(tuple(values.get(c) for c in names))
        changes = () if n == 3 else summaries.IMAGED  # one load without images
        table.merge(spark.createDataFrame(rows, curated_schema("transaction")), [spec.key], spec.on_match, load_id=str(n), changes=changes)
        kept = [s.read(s.refresh(lake, table)) for s in (summaries.ACCOUNT_VOLUMES, summaries.MONTHLY_TOTALS, summaries.PRODUCT_REVENUE)]
        activity = summaries.refresh_activity(lake, table)
        again = summaries.MONTHLY_TOTALS.refresh(lake, table)  # nothing twice
        every = table.read()
        assert rows_of(reports.greatest_customers(kept[0], customers)) == rows_of(reports.top_customers(every, customers))
        assert rows_of(reports.trend_rows(kept[1])) == rows_of(reports.monthly_trend(every)) == rows_of(reports.trend_rows(summaries.MONTHLY_TOTALS.read(again)))
        assert rows_of(reports.shares(kept[2], products)) == rows_of(reports.product_share(every, products))
        for day in ("2025-04-01", "2025-07-01", "2025-09-04"):
            assert rows_of(summaries.inactive_by_state(accounts, activity.read(), day)) == rows_of(reports.inactive_accounts(accounts, every, day))


def test_a_micro_batch_reads_no_raw_rows_of_older_loads(spark, folder, monkeypatch):
    landing, lake = folder + "/landing", Lake(spark, folder + "/lake")
    write_csv(landing, "accounts.csv", [account("A1"), account("A2")], entity="account")
    write_csv(landing, "customers.csv", [customer("C1", "A1")], entity="customer")
    write_csv(landing, "products.csv", [product("P1")], entity="products")
    write_csv(landing, "transactions_1.csv", [transaction("T1", "A1", amount="5"), transaction("T2", "A2", day="2025-06-01")], entity="transaction")
    run_files(lake, list_files(spark, landing), Run.of("one", TS, AS_OF), only_new=True)

    read = SnapshotTable._read

    def guarded(self, folders, *args, **options):
        if "/rawlayer/" in self.root:
            assert {entry["load_id"] for entry in folders} <= {"two"}, "raw rows of an older load are read"
        return read(self, folders, *args, **options)

    monkeypatch.setattr(SnapshotTable, "_read", guarded)
    write_csv(landing, "transactions_2.csv", [transaction("T1", "A1", amount="7"), transaction("T2", "A2", day="2024-01-01", amount="9")], entity="transaction")
    files = list_files(spark, landing).where("path like '%transactions_2.csv'")
    run_files(lake, files, Run.of("two", TS, AS_OF), only_new=True)
    monkeypatch.undo()
    amounts = {r["transaction_id"]: r["amount"] for r in lake.curated("transaction").read().collect()}
    assert amounts["T2"] == 1000.0 and amounts["T1"] == 5.0  # T2 is older, T1 as new but with the greater amount: the tie keeps the least
    with pytest.raises(AssertionError):
        monkeypatch.setattr(SnapshotTable, "_read", guarded)
        lake.raw("transaction").read()
