import datetime as dt
import random
import re
import string
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coinwharf.functions import numeric, paths, temporal, text


def values(spark, rows, ddl, expression):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expression.alias("x")).collect()]


def texts(spark, rows, expression):
    return values(spark, [(r,) for r in rows], "s string", expression(F.col("s")))


def test_trim_whitespace(spark):
    given = ["  a b ", "\ta\n", " a ", "　a b \x85", "", None, "​a"]
    assert texts(spark, given, text.trim_whitespace) == ["a b", "a", "a", "a b", "", None, "​a"]


def test_valid_email(spark):
    given = ["Ab.c+1%_-@X-y.Com", "a@b.c", "a@@b.com", "a b@c.de", "a@b.com\n", "@b.com", "", None]
    assert texts(spark, given, text.valid_email) == ["ab.c+1%_-@x-y.com"] + [None] * 7


def test_valid_phone(spark):
    given = ["9876543210", "+919876543210", "5876543210", "98765432101", "+91-9876543210",
             "9876543210\n", "abcdefghij", "", None]
    assert texts(spark, given, text.valid_phone) == ["9876543210", "+919876543210"] + [""] * 7


def test_valid_phone_normalized(spark):
    given = ["+91-9876543210", "(98765) 43210", "+91-99999", None]
    got = texts(spark, given, lambda c: text.valid_phone(c, normalize=True))
    assert got == ["+919876543210", "9876543210", "", ""]


def test_stripping(spark):
    given = ["A-1_b é", "Savings Account", "!!", None]
    assert texts(spark, given, text.strip_non_alnum) == ["A1b", "SavingsAccount", "", None]
    assert texts(spark, given, text.strip_non_word) == ["A1_b", "SavingsAccount", "", None]
    assert texts(spark, ["44 Ab ##@", None], text.blank_non_alnum) == ["44 Ab    ", None]


def test_stripping_equals_the_regular_expressions(spark):
    rng = random.Random(5)
    alphabet = string.printable + "éß漢字😀🇮🇳\u0000\u200b\xa0" + "Aa0_" * 10
    given = ["".join(rng.choices(alphabet, k=rng.randrange(25))) for _ in range(3000)]
    assert texts(spark, given, text.strip_non_alnum) == [re.sub("[^A-Za-z0-9]", "", g) for g in given]
    assert texts(spark, given, text.strip_non_word) == [re.sub("[^A-Za-z0-9_]", "", g) for g in given]
    assert texts(spark, given, text.blank_non_alnum) == [re.sub("[^A-Za-z0-9]", " ", g) for g in given]


def test_same_word(spark):
    given = ["SUCCESS", "success", "Success", "Failed", None]
    assert texts(spark, given, lambda c: text.same_word(c, "Success")) == [True, True, True, False, None]


def test_to_day_and_instant(spark):
    given = ["2024-02-29", "2023-02-29", "2024-01-05 10:11:12", "soon", None]
    assert texts(spark, given, temporal.to_day) == [dt.date(2024, 2, 29), None, dt.date(2024, 1, 5), None, None]
    got = texts(spark, given, lambda c: temporal.to_instant(c).cast("string"))
    assert got == ["2024-02-29 00:00:00", None, "2024-01-05 10:11:12", None, None]


def test_clamp_future_keeps_null(spark):
    rows = [(dt.date(2026, 1, 2),), (dt.date(2026, 1, 1),), (dt.date(2020, 5, 5),), (None,)]
    got = values(spark, rows, "d date", temporal.clamp_future(F.col("d"), temporal.day_literal("2026-01-01")))
    assert got == [dt.date(2026, 1, 1), dt.date(2026, 1, 1), dt.date(2020, 5, 5), None]


@pytest.mark.parametrize("day,expected", [("2024-05-31", "2024-02-29"), ("2025-05-31", "2025-02-28"), ("2025-01-15", "2024-10-15")])
def test_months_before(spark, day, expected):
    got = spark.range(1).select(temporal.months_before(temporal.day_literal(day), 3)).first()[0]
    assert got == dt.date.fromisoformat(expected)


def test_defaults_use_the_clock(spark):
    row = spark.range(1).select(temporal.day_literal(None), temporal.instant_literal(None)).first()
    assert isinstance(row[0], dt.date) and isinstance(row[1], dt.datetime)


def test_naive_instants_are_utc(spark):
    got = spark.range(1).select(temporal.instant_literal("2026-01-01T05:00:00").cast("string")).first()[0]
    assert got == "2026-01-01 05:00:00"


def test_year_month(spark):
    assert values(spark, [(dt.date(2025, 7, 9),), (None,)], "d date", temporal.year_month(F.col("d"))) == ["2025-07", None]


def test_exact_sum_does_not_depend_on_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e15, -1e15, 0.000001] * 50
    totals = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(parts)
        totals.add(df.agg(numeric.exact_sum(F.col("a")).cast("double")).first()[0])
    assert totals == {30.00005}


def test_exact_sum_of_signs_nulls_and_scales(spark):
    df = spark.createDataFrame([(-0.1,), (-2.35,), (None,), (3.0,), (0.9999999,)], "a double")
    assert df.agg(numeric.exact_sum(F.col("a"))).first()[0] == Decimal("1.55")
    assert df.agg(numeric.exact_sum(F.col("a"), 2)).first()[0] == Decimal("1.55")
    assert df.where("a is null").agg(numeric.exact_sum(F.col("a"))).first()[0] is None
    whole = spark.range(5).agg(numeric.exact_sum(F.col("id"))).first()[0]
    assert whole == 10


@pytest.mark.parametrize("amount", [1e30, -1e30, float("inf"), float("nan")])
def test_exact_sum_refuses_amounts_that_do_not_fit(spark, amount):
    df = spark.createDataFrame([(amount,)], "a double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        df.agg(numeric.exact_sum(F.col("a"))).first()


def test_percent_of(spark):
    rows = [(1.0, 3.0), (2.675, 100.0), (-0.125, 100.0), (1.0, 0.0), (None, 1.0), (1.0, None)]
    got = values(spark, rows, "a double, b double", numeric.percent_of(F.col("a"), F.col("b")))
    assert got == [33.33, 2.68, -0.13, None, None, None]


def test_flags(spark):
    given = ["True", "FALSE", " true", "Y", "maybe", None]
    assert texts(spark, given, numeric.flag_text) == ["true", "false", "true", "Y", "maybe", None]
    assert texts(spark, given, numeric.to_flag) == [True, False, True, None, None, None]
    assert texts(spark, ["1", "t", "y", "0"], numeric.to_flag) == [None] * 4
    assert texts(spark, ["1.5", "x", None], numeric.to_number) == [1.5, None, None]
    assert texts(spark, ["NaN", "Infinity", "-inf", "12d", "1e999", " -3 ", "2e3"], numeric.to_number) == [None] * 5 + [-3.0, 2000.0]


def test_days_are_whole(spark):
    given = ["2024", "2024-3", "2024-01-05 zz", "2024-1-5", "2024-02-30", " 2024-01-05", "2024-01-05 10:00:00"]
    assert [str(d) for d in texts(spark, given, temporal.to_day)] == ["None"] * 5 + ["2024-01-05"] * 2
    assert values(spark, [(True,), (None,)], "b boolean", numeric.flag_text(F.col("b"))) == ["true", None]


def test_route_takes_the_first_word_in_order(spark):
    given = ["gs://b/raw/Datafile_ACCOUNTS.csv", "x/customer_account.csv", "branch.csv", "a/account/customers.csv",
             "Product_transaction.csv", "transactions.csv", "misc.csv", None]
    assert texts(spark, given, paths.route) == [
        "account", "account", "branch", "customer", "products", "transaction", None, None]


def test_object_uri(spark):
    df = spark.createDataFrame([("b", "raw/x.csv"), (None, "x"), ("b", None)], "b string, n string")
    got = [r[0] for r in df.select(paths.object_uri(F.col("b"), F.col("n"))).collect()]
    assert got == ["gs://b/raw/x.csv", None, None]
