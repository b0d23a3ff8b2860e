import base64
import datetime as dt
import json
import os

import pytest

from coinwharf.plans.lake import Lake
from coinwharf.plans.raw_load import files_per_table, load_table, skipped
from coinwharf.schemas import RAW_COLUMNS
from coinwharf.sources.landing import list_files, load_plan, planned, read_raw, stamped
from coinwharf.sources.notifications import decode_notifications, encode_notifications, undecodable
from fixtures import account, write_csv


def write_config(folder, tables, default=None):
    path = os.path.join(folder, "job.json")
    body = {"tables": {t: {"write_mode": m} for t, m in tables.items()}, "other": {"deep": [1]}}
    if default:
        body["bigquery"] = {"write_mode_default": default}
    with open(path, "w") as out:
        json.dump(body, out, indent=2)
    return path


def test_load_plan(spark, folder):
    config = write_config(folder, {"account": "overwrite", "branch": None}, "append")
    assert {tuple(r) for r in load_plan(spark, config).collect()} == {("account", "overwrite"), ("branch", "append")}


def test_listing_is_flat_and_case_sensitive(spark, folder):
    write_csv(folder, "a.csv", [account("A1")])
    write_csv(folder, "B.CSV", [account("A1")])
    write_csv(folder, "c.txt", [account("A1")])
    write_csv(os.path.join(folder, "deeper"), "d.csv", [account("A1")])
    got = list_files(spark, folder)
    assert [r.path.rsplit("/", 1)[1] for r in got.collect()] == ["a.csv"]
    assert got.columns == ["path", "modificationTime", "length"]
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_and_missing_folder(spark, folder):
    assert list_files(spark, folder).isEmpty()
    assert list_files(spark, folder + "/none").isEmpty()
    assert files_per_table(Lake(spark, folder), list_files(spark, folder), None) == []


def test_files_per_table(spark, folder):
    for name in ("Accounts_1.csv", "accounts_2.csv", "customer_account.csv", "misc.csv", "branch.csv"):
        write_csv(folder, name, [account("A1")])
    config = write_config(folder, {"account": "append"})
    files = list_files(spark, folder)
    got = {r["table"]: r for r in files_per_table(Lake(spark, folder), files, config)}
    assert len(got["account"]["paths"]) == 3 and got["account"]["write_mode"] == "append"
    assert got["branch"]["write_mode"] == "append"
    assert [r.path.rsplit("/", 1)[1] for r in skipped(files).collect()] == ["misc.csv"]
    assert planned(files, load_plan(spark, config)).count() == 4


def test_read_keeps_text(spark, folder):
    path = write_csv(folder, "account.csv", [account("00123", phone="+919517728478", address="9, x Road")])
    row = read_raw(spark, [path], "account", "strict").first()
    assert (row.account_id, row.phone_number, row.address) == ("00123", "+919517728478", "9, x Road")
    # No type is inferred that would change a value.
    inferred = read_raw(spark, [path], "account", infer=True)
    assert tuple(map(str, inferred.first())) == tuple(map(str, row))
    kinds = {f.name: f.dataType.simpleString() for f in inferred.schema}
    assert (kinds["account_id"], kinds["phone_number"], kinds["created_date"]) == ("string", "string", "date")


@pytest.mark.parametrize("name", ["plain.csv", "with blank + plus%20.csv", "glob[1]{a}.csv"])
def test_headers_in_another_order_are_matched_by_name(spark, folder, name):
    columns = RAW_COLUMNS["account"]
    paths = [
        write_csv(folder, "one.csv", [account("A1", "One")], columns),
        write_csv(folder, name, [account("A2", "Two")], columns[::-1]),
    ]
    got = read_raw(spark, paths, "account")
    assert {(r.account_id, r.account_name) for r in got.collect()} == {("A1", "One"), ("A2", "Two")}
    assert got.columns == columns
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, paths, "account", "strict").collect()


def test_a_foreign_header_fails_loudly(spark, folder):
    columns = [c for c in RAW_COLUMNS["account"] if c != "email"]
    rows = [{k: v for k, v in account("A1").items() if k != "email"}]
    path = write_csv(folder, "a.csv", rows, columns)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, [path], "account").collect()


def test_a_file_with_two_different_headers_is_refused(spark, folder):
    columns = RAW_COLUMNS["account"]
    path = write_csv(folder, "a.csv", [account("A1"), dict(zip(columns, columns[::-1])), account("A2")], columns)
    with pytest.raises(Exception, match="several different header lines"):
        read_raw(spark, [path], "account").collect()


def test_quoted_header_and_empty_fields(spark, folder):
    path = os.path.join(folder, "a.csv")
    with open(path, "w") as out:
        out.write(",".join(f'"{c}"' for c in RAW_COLUMNS["account"]) + "\n")
        out.write("A1,,x@y.zz,,,2024-01-01\n")
    row = read_raw(spark, [path], "account").first()
    assert row.account_id == "A1" and row.account_name is None and row.phone_number is None


def test_stamped(spark):
    now = dt.datetime(2026, 1, 1, 12)
    assert stamped(spark.range(1), now).first().ingestion_timestamp == now


def test_notifications(spark):
    good = spark.createDataFrame([("b", "raw/ä x.csv"), ("b", None)], "bucket string, name string")
    sent = encode_notifications(good)
    assert [r.path for r in decode_notifications(sent).collect()] == ["gs://b/raw/ä x.csv", None]
    by_hand = base64.b64encode(json.dumps({"bucket": "b", "name": "n.csv", "size": 3}).encode()).decode()
    bad = ["!!", "aGk", base64.b64encode(b"\xff\xfe").decode(), base64.b64encode(b"not json").decode(),
           base64.b64encode(b"[1]").decode(), "", None]
    got = decode_notifications(spark.createDataFrame([(m,) for m in [by_hand, *bad]], "data string"), scheme="s3")
    assert [r.path for r in got.collect()] == ["s3://b/n.csv"] + [None] * len(bad)
    assert undecodable(got).count() == len(bad)


def test_header_lines_are_read_up_to_their_break_only(spark, folder, monkeypatch):
    """Reading files by name reads no more of them than reading them strictly, but for the first lines."""
    from coinwharf.sources import landing

    path = write_csv(folder, "big.csv", [account(f"A{i}", "x" * 200) for i in range(3000)])
    with open(path, "rb") as file:
        first = file.readline().decode().rstrip()
    assert landing.header_lines(spark, [path, path.replace("/", "file:///", 1)]) == dict.fromkeys([path, path.replace("/", "file:///", 1)], first)
    plans = [read_raw(spark, [path], "account", headers)._jdf.queryExecution().optimizedPlan().toString() for headers in ("strict", "by_name")]
    assert [plan.count("Relation [") for plan in plans] == [1, 1]
    # where Python has no way to the files, Spark's text reader finds the same lines
    other = write_csv(folder, "other.csv", [account("B1")], RAW_COLUMNS["account"][::-1])
    def unreachable(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.nulls(len(b), pa.string())], ["path", "line"])

    monkeypatch.setattr(landing, "_first_lines", lambda: unreachable)
    assert landing.header_lines(spark, [path, other]) == {path: first, other: ",".join(RAW_COLUMNS["account"][::-1])}


def test_files_of_a_raw_table_hold_a_bounded_number_of_rows(spark, folder, monkeypatch):
    monkeypatch.setattr("coinwharf.plans.lake.FILE_ROWS", 10)
    path = write_csv(folder, "accounts.csv", [account(f"A{i}") for i in range(35)])
    rows = load_table(Lake(spark, folder + "/lake"), "account", [path], "append", "load")
    per_file = rows.groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in per_file) == 35 and max(r["count"] for r in per_file) <= 10
