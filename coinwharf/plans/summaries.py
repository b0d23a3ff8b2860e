"""Sums and last days that are kept up to date from row changes.

Each merge into the curated transactions keeps the images of its changed rows, before (sign -1) and
after (sign 1). Counts and exact amounts per group can be added and taken back, so a summary takes
the signed sums of the images instead of reading all transactions again; it is stored as such sums
and added up when read. The last day of an account can only grow by what was added; where a row that
held the last day was moved or changed, that account alone is counted anew.

A summary's load id is the version of the transactions it stands for, so it is brought up to date
once per version, whatever is repeated. Where a version kept no images (a first load, or a batch
that curates all raw rows) the summary is computed from all rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from coinwharf.functions.numeric import exact_sum
from coinwharf.functions.temporal import day_literal, months_before
from coinwharf.functions.text import same_word
from coinwharf.operators.absence import without_match
from coinwharf.plans.lake import Lake
from coinwharf.plans.reports import INACTIVE_MONTHS, SUCCESS
from coinwharf.sources.tables import SnapshotTable

#: Columns of transactions whose images are kept.
IMAGED = ("account_id", "product_id", "branch_id", "date", "status", "amount")
#: Stored sums of a summary after which they are added up to one.
ADDED_UP = 20
TOTALS = "n long, amounts long, amount decimal(38, 6)"
ACTIVITY = StructType([StructField("account_id", StringType()), StructField("last_day", DateType())])


@dataclass(frozen=True)
class Summary:
    """Counts and amounts of transactions per group."""

    name: str
    keys: str  # names and types
    group: Callable[[], list[Column]]
    counted: Callable[[], Column]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(f"{self.keys}, {TOTALS}")

    @property
    def key_names(self) -> list[str]:
        return StructType.fromDDL(self.keys).names

    def signed(self, rows: DataFrame) -> DataFrame:
        """Signed sums of images per group."""
        amount, sign = F.col("amount"), F.col("sign")
        one_side = lambda s: F.coalesce(exact_sum(F.when(sign == s, amount)), F.lit(0))
        return (
            rows.where(self.counted())
            .groupBy(*self.group())
            .agg(
                F.sum(sign).cast("long").alias("n"),
                F.sum(F.when(amount.isNotNull(), sign).otherwise(0)).cast("long").alias("amounts"),
                (one_side(1) - one_side(-1)).cast("decimal(38, 6)").alias("amount"),
            )
        )

    def added_up(self, stored: DataFrame) -> DataFrame:
        """One row per group that still has rows."""
        sums = [F.sum(c).cast(self.schema[c].dataType).alias(c) for c in ("n", "amounts", "amount")]
        return stored.groupBy(*self.key_names).agg(*sums).where("n > 0")

    def read(self, table: SnapshotTable) -> DataFrame:
        """Groups with their count ``n`` and ``amount``; of missing amounts only the amount is NULL."""
        amount = F.when(F.col("amounts") > 0, F.col("amount")).alias("amount")
        return self.added_up(table.read()).select(*self.key_names, "n", amount)

    def refresh(self, lake: Lake, transactions: SnapshotTable) -> SnapshotTable:
        """Bring the stored sums up to the transactions' version."""
        table = lake.summary(self.name, self.schema)
        now, known = transactions.state(), table.state()
        load_id = str(now.version)
        if known.last_load == load_id:
            return table
        changes = transactions.changes_since(int(known.last_load), now.version) if known.last_load else None
        if changes is None:
            table.replace(self.signed(transactions.read(now).select(*IMAGED, F.lit(1).alias("sign"))), load_id)
        elif not changes.columns:
            table.append(table.read().limit(0), load_id)
        elif len(known.live) >= ADDED_UP:
            table.replace(self.added_up(table.read(known).unionByName(self.signed(changes))), load_id)
        else:
            table.append(self.signed(changes), load_id)
        return table


ACCOUNT_VOLUMES = Summary(
    "account_volumes",
    "account_id string",
    lambda: [F.col("account_id")],
    lambda: same_word(F.col("status"), SUCCESS) & F.col("account_id").isNotNull(),
)
MONTHLY_TOTALS = Summary(
    "monthly_totals",
    "branch_id string, month date, status string",
    lambda: [F.col("branch_id"), F.trunc("date", "month").alias("month"), F.col("status")],
    lambda: F.lit(True),
)
PRODUCT_REVENUE = Summary(
    "product_revenue",
    "product_id string",
    lambda: [F.col("product_id")],
    lambda: (F.col("status") == SUCCESS) & F.col("product_id").isNotNull(),
)


def refresh_activity(lake: Lake, transactions: SnapshotTable) -> SnapshotTable:
    """Bring the last day of each account up to the transactions' version."""
    table = lake.summary("last_activity", ACTIVITY)
    now, known = transactions.state(), table.state()
    load_id = str(now.version)
    if known.last_load == load_id:
        return table
    last = F.max("date").alias("last_day")
    changes = transactions.changes_since(int(known.last_load), now.version) if known.last_load else None
    if changes is None:
        rows = transactions.read(now).where("account_id is not null")
        table.replace(rows.groupBy("account_id").agg(last), load_id)
        return table
    if not changes.columns:
        table.append(table.read().limit(0), load_id)
        return table
    moved = changes.where("account_id is not null").groupBy("account_id").agg(
        F.max(F.when(F.col("sign") == 1, F.col("date"))).alias("added"),
        F.max(F.when(F.col("sign") == -1, F.col("date"))).alias("taken"),
    )
    moved = moved.join(table.read(known), "account_id", "left")
    # the last day may be gone if a row that had it was taken and none as late was added
    lowered = F.coalesce(F.col("taken") >= F.col("last_day"), F.lit(False)) & F.coalesce(F.col("added") < F.col("taken"), F.lit(True))
    recount = moved.where(lowered).select("account_id")
    raised = moved.where(~lowered).select("account_id", F.greatest("last_day", "added").alias("last_day"))
    counted = recount.join(transactions.read(now), "account_id", "left").groupBy("account_id").agg(last)
    source = raised if recount.isEmpty() else raised.unionByName(counted)
    table.merge(source, ["account_id"], ["last_day"], load_id)
    return table


def inactive_by_state(accounts: DataFrame, activity: DataFrame, as_of=None, months: int = INACTIVE_MONTHS) -> DataFrame:
    """Accounts whose last day is before ``as_of`` less some months, or that have none."""
    recent = activity.where(F.col("last_day") >= months_before(day_literal(as_of), months))
    return without_match(accounts.select("account_id", "account_name"), recent, ["account_id"])
