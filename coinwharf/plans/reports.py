"""The five KPI reports, each from curated DataFrames to a result DataFrame.

Inputs need only the columns used here, under their curated names. Transactions may be
concentrated on a few accounts or products, so they are summed (or made distinct) per
join key first; the joins then see one row per key on the transaction side. Joins carry
no broadcast hint: Spark broadcasts a side only after checking its size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from coinwharf.functions.numeric import AMOUNT_SCALE, exact_sum
from coinwharf.functions.temporal import day_literal, months_before, year_month
from coinwharf.functions.text import same_word
from coinwharf.operators.absence import without_match
from coinwharf.operators.hot_join import hot_join
from coinwharf.operators.share import with_percentage
from coinwharf.session import staged

# The names of the report tables and the limits they use.
TOP_CUSTOMERS = "top_five_customer_trans"
MONTHLY_TREND = "monthly_trans_trend_per_branch"
PRODUCT_SHARE = "prod_wise_revenue"
INACTIVE_ACCOUNTS = "Last_three_month_inact_acct"
SUSPICIOUS = "suspicious_trans"
SUCCESS = "Success"
# Columns a report is shown in the order of; a minus stands for the greatest first.
ORDER = {
    TOP_CUSTOMERS: ("-total_volume", "customer_id", "customer_name"),
    MONTHLY_TREND: ("branch_id", "year_month", "transaction_status"),
    PRODUCT_SHARE: ("-total_revenue", "product_id"),
    INACTIVE_ACCOUNTS: ("account_id",),
    SUSPICIOUS: ("-amount", "transaction_id", "customer_id"),
}
TOP_N = 5
INACTIVE_MONTHS = 3
SUSPICIOUS_ABOVE = 100000


def account_volumes(transactions: DataFrame, status: str = SUCCESS, scale: int = AMOUNT_SCALE) -> DataFrame:
    """Successful amount per account; the status may be in any case."""
    successful = transactions.where(same_word(F.col("status"), status) & F.col("account_id").isNotNull())
    return successful.groupBy("account_id").agg(exact_sum(F.col("amount"), scale).alias("amount"))


def top_customers(
    transactions: DataFrame,
    customers: DataFrame,
    n: int = TOP_N,
    status: str = SUCCESS,
    scale: int = AMOUNT_SCALE,
) -> DataFrame:
    """The ``n`` customers with the greatest successful amount; the status may be in any case."""
    return greatest_customers(account_volumes(transactions, status, scale), customers, n)


def greatest_customers(volumes: DataFrame, customers: DataFrame, n: int = TOP_N) -> DataFrame:
    """The same from (account_id, amount) rows, one per account."""
    return (
        volumes.join(customers.select("account_id", "customer_id", "name"), "account_id")
        .groupBy("customer_id", F.col("name").alias("customer_name"))
        .agg(F.sum("amount").cast("double").alias("total_volume"))
        .orderBy(F.desc("total_volume"), "customer_id", "customer_name")
        .limit(n)
    )


def monthly_trend(transactions: DataFrame, scale: int = AMOUNT_SCALE) -> DataFrame:
    """Count and amount per branch, month and status; a missing branch or day is a group too.

    Grouped by the first day of the month; the text is made once per group, not per row.
    """
    groups = transactions.groupBy("branch_id", F.trunc("date", "month").alias("month"), "status")
    return trend_rows(groups.agg(F.count("*").alias("n"), exact_sum(F.col("amount"), scale).alias("amount")))


def trend_rows(groups: DataFrame) -> DataFrame:
    """The same from (branch_id, month, status, n, amount) rows, one per group."""
    return groups.select(
        "branch_id",
        year_month(F.col("month")).alias("year_month"),
        F.col("n").alias("total_transactions"),
        F.col("amount").cast("double").alias("total_amount"),
        F.col("status").alias("transaction_status"),
    )


def product_share(
    transactions: DataFrame,
    products: DataFrame,
    status: str = SUCCESS,
    scale: int = AMOUNT_SCALE,
) -> DataFrame:
    """Revenue per product and its percentage of all; only exactly this status counts.

    Amounts of products that are not in ``products`` count neither in a group nor in the total.
    """
    sold = transactions.where((F.col("status") == status) & F.col("product_id").isNotNull())
    return shares(sold.groupBy("product_id").agg(exact_sum(F.col("amount"), scale).alias("amount")), products)


def shares(per_product: DataFrame, products: DataFrame) -> DataFrame:
    """The same from (product_id, amount) rows, one per product."""
    revenue = (
        per_product.join(products.select("product_id"), "product_id")
        .groupBy("product_id")
        .agg(F.sum("amount").alias("revenue"))
    )
    return (
        with_percentage(revenue, "revenue", "revenue_percentage")
        .select("product_id", F.col("revenue").cast("double").alias("total_revenue"), "revenue_percentage")
    )


def inactive_accounts(
    accounts: DataFrame,
    transactions: DataFrame,
    as_of: dt.date | str | None = None,
    months: int = INACTIVE_MONTHS,
) -> DataFrame:
    """Accounts with no transaction of any status on or after ``as_of`` less some months."""
    since = months_before(day_literal(as_of), months)
    recent = transactions.where(F.col("date") >= since)
    return without_match(accounts.select("account_id", "account_name"), recent, ["account_id"])


def suspicious(
    transactions: DataFrame, customers: DataFrame, above: float = SUSPICIOUS_ABOVE, hot: dict | None = None
) -> DataFrame:
    """Transactions strictly above a limit, for every customer that shares the account.

    Nothing can be summed here. A hot account is left to adaptive execution, which splits an
    outsized partition of either side, or, with ``hot`` (the options of ``hot_join``, may be
    empty), found by a sketch and dealt over many tasks on both sides.
    """
    large = transactions.where(F.col("amount") > above).select(
        "transaction_id", "account_id", "amount", "date", "status"
    )
    owners = customers.select("account_id", "customer_id", "name")
    joined = large.join(owners, "account_id") if hot is None else hot_join(large, owners, "account_id", **hot)
    return joined.select("transaction_id", "customer_id", "name", "amount", "date", "status")


def in_order(name: str, report: DataFrame) -> DataFrame:
    """A report's rows in the order they are shown in.

    The order belongs to reading: stored rows have none, so computing a report never
    shuffles it whole just to sort it.
    """
    return report.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in ORDER[name]])


def placed(name: str, report: DataFrame) -> DataFrame:
    """A report's rows with their ``place`` in that order, from 1.

    The sort is by ranges, so no task sees all rows: each row has a place in its range, and the
    ranges, a row each, are added up.
    """
    row = F.monotonically_increasing_id()  # the range above 33 bits of the place in it
    ranges = staged(in_order(name, report).withColumn("_row", row).withColumn("_range", F.shiftright("_row", 33)), "ordered")
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_begin"))
    place = F.col("_begin") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranges.join(begins, "_range").select(place.alias("place"), *report.columns)
