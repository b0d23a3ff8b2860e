"""Raw to curated: filter, clean, keep the latest row per key, stamp, upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampType

from coinwharf.functions.numeric import flag_text, to_flag, to_number
from coinwharf.functions.temporal import clamp_future, day_literal, instant_literal, to_day, to_instant
from coinwharf.functions.text import (
    blank_non_alnum,
    strip_non_alnum,
    strip_non_word,
    trim_whitespace,
    valid_email,
    valid_phone,
)
from coinwharf.operators.latest import latest_per_key
from coinwharf.operators.upsert import check_unique, merge_upsert
from coinwharf.schemas import curated_schema

Expression = Callable[[Column], Column]
#: Stored with each curated row, to compare it with rows that arrive later.
ORDER_STAMPS = StructType([StructField("_newest", DateType()), StructField("_arrived", TimestampType())])


@dataclass(frozen=True)
class CuratedSpec:
    """How one curated table is made from its raw table."""

    entity: str
    key: str
    newest: str  # raw date that decides which row of a key is the latest
    required: tuple[str, ...]  # raw columns that must not be null
    partition: tuple[str, str]  # partition column and the curated column it comes from
    cluster: tuple[str, ...]  # sort order inside files
    kept_on_match: tuple[str, ...]  # columns an update leaves alone
    renamed: dict[str, str] = field(default_factory=dict)  # curated name -> raw name
    rules: dict[str, Expression] = field(default_factory=dict)  # curated name -> cleaning
    phones: tuple[str, ...] = ()
    clamped: tuple[str, ...] = ()

    def raw_name(self, column: str) -> str:
        return self.renamed.get(column, column)

    @property
    def stamps(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c in ("load_time", "created_at", "updated_at"))

    @property
    def columns(self) -> list[str]:
        return curated_schema(self.entity).names

    @property
    def cleaned(self) -> list[str]:
        return [c for c in self.columns if c not in self.stamps]

    @property
    def tie(self) -> list[str]:
        """Columns that settle which row is the latest where the order stamps are equal."""
        return [c for c in self.cleaned if c != self.key]

    @property
    def on_match(self) -> list[str]:
        return [c for c in self.columns if c != self.key and c not in self.kept_on_match]

    def needed(self, null_keys: bool = False) -> list[str]:
        """Raw columns a row must have.

        A row without a business key can never match, so each load would insert it
        again; such rows are rejected unless ``null_keys`` asks for them.
        """
        key = () if null_keys else (self.raw_name(self.key),)
        return list(dict.fromkeys((*self.required, *key)))

    @property
    def typed(self) -> list[str]:
        """Columns whose text can turn out unreadable."""
        fields = curated_schema(self.entity)
        return [c for c in self.cleaned if fields[c].dataType.simpleString() != "string"]


SPECS = {
    spec.entity: spec
    for spec in (
        CuratedSpec(
            entity="customer",
            key="customer_id",
            newest="registration_date",
            required=("customer_name", "email", "phone"),
            partition=("updated_date", "updated_at"),
            cluster=("customer_id",),
            kept_on_match=("load_time", "created_at"),
            renamed={"name": "customer_name"},
            rules={
                "name": trim_whitespace,
                "email": valid_email,
                "account_id": strip_non_alnum,
                "dob": to_day,
                "registration_date": to_day,
            },
            phones=("phone",),
        ),
        CuratedSpec(
            entity="branch",
            key="branch_id",
            newest="opened_date",
            required=("branch_id",),
            partition=("opened_date", "opened_date"),
            cluster=("branch_id",),
            kept_on_match=("created_at",),
            rules={"opened_date": to_day},
            phones=("contact_number",),
        ),
        CuratedSpec(
            entity="account",
            key="account_id",
            newest="created_date",
            required=("account_id",),
            partition=("created_date", "created_date"),
            cluster=("account_id",),
            kept_on_match=("created_at",),
            rules={
                "account_id": strip_non_alnum,
                "account_name": strip_non_alnum,
                "address": blank_non_alnum,
                "created_date": to_day,
            },
            phones=("phone_number",),
            clamped=("created_date",),
        ),
        CuratedSpec(
            entity="products",
            key="product_id",
            newest="launch_date",
            required=("product_id", "product_name", "category"),
            partition=("launch_date", "launch_date"),
            cluster=("product_id",),
            kept_on_match=("created_at", "updated_at"),
            rules={
                "product_id": strip_non_alnum,
                "product_name": strip_non_word,
                "product_type": strip_non_alnum,
                "price": to_number,
                "launch_date": to_day,
                "is_active": flag_text,
                "category": strip_non_alnum,
                "vendor_name": strip_non_alnum,
            },
        ),
        CuratedSpec(
            entity="transaction",
            key="transaction_id",
            newest="date",
            required=("transaction_id",),
            partition=("date", "date"),
            cluster=("branch_id", "product_id", "transaction_id"),
            kept_on_match=("created_at",),
            rules={
                "transaction_id": strip_non_alnum,
                "account_id": strip_non_alnum,
                "product_id": strip_non_alnum,
                "branch_id": strip_non_alnum,
                "date": to_day,
                "timestamp": to_instant,
                "amount": to_number,
                "payment_method": strip_non_alnum,
                "status": strip_non_alnum,
                "is_refund": to_flag,
            },
        ),
    )
}


def complete_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in which none of the required columns is null.

    Plain IS NOT NULL tests: unlike ``dropna`` they are pushed into the file scan.
    """
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in required]))


def cleaned_key(spec: CuratedSpec) -> Column:
    return spec.rules.get(spec.key, lambda key: key)(F.col(spec.raw_name(spec.key)))


def blank_key(spec: CuratedSpec) -> Column:
    """Whether nothing is left of a row's key by cleaning, as of ``###``; never NULL."""
    return F.coalesce(cleaned_key(spec) == "", F.lit(False))


def accepted(raw: DataFrame, spec: CuratedSpec, null_keys: bool = False) -> DataFrame:
    """Raw rows fit for curation."""
    return complete_rows(raw, spec.needed(null_keys)).where(~blank_key(spec))


def check_spellings(raw: DataFrame, spec: CuratedSpec) -> None:
    """Raise when two raw keys become one by cleaning, as ``A-1`` and ``A1`` do."""
    spelled = F.col(spec.raw_name(spec.key))
    pairs = accepted(raw, spec).select(cleaned_key(spec).alias(spec.key), spelled.alias("_spelled")).distinct()
    check_unique(pairs, [spec.key])


def clean(
    raw: DataFrame,
    spec: CuratedSpec,
    as_of: dt.date | str | None = None,
    normalize_phone: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Cleaned columns and ``extra`` ones, with the order columns of the latest-row choice (``_newest``, ``_arrived``)."""

    def cleaned(name: str) -> Column:
        value = F.col(spec.raw_name(name))
        if name in spec.phones:
            value = valid_phone(value, normalize_phone)
        if name in spec.rules:
            value = spec.rules[name](value)
        if name in spec.clamped:
            value = clamp_future(value, day_literal(as_of))
        return value.alias(name)

    arrived = F.col("ingestion_timestamp") if "ingestion_timestamp" in raw.columns else F.lit(None).cast("timestamp")
    return raw.select(
        *[cleaned(c) for c in spec.cleaned],
        to_day(F.col(spec.newest)).alias("_newest"),
        arrived.alias("_arrived"),
        *extra,
    )


def upsert_source(
    raw: DataFrame,
    spec: CuratedSpec,
    as_of: dt.date | str | None = None,
    run_ts: dt.datetime | str | None = None,
    normalize_phone: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """One cleaned, stamped row per business key, in the columns of the curated table.

    The latest row is chosen by the cleaned key, so ``A-1`` and ``A1`` are one account.
    """
    return latest_rows(clean(accepted(raw, spec, null_keys), spec, as_of, normalize_phone), spec, run_ts)


def latest_rows(
    cleaned: DataFrame, spec: CuratedSpec, run_ts: dt.datetime | str | None = None, ordered: bool = False
) -> DataFrame:
    """The latest row of each key, stamped; ``ordered`` keeps its order stamps."""
    latest = latest_per_key(cleaned.select(*spec.cleaned, *ORDER_STAMPS.names), [spec.key], ORDER_STAMPS.names)
    fields = curated_schema(spec.entity)
    now = instant_literal(run_ts)
    columns = [(now if c in spec.stamps else F.col(c)).cast(fields[c].dataType).alias(c) for c in spec.columns]
    return latest.select(*columns, *(ORDER_STAMPS.names if ordered else ()))


def classified(
    raw: DataFrame,
    spec: CuratedSpec,
    as_of: dt.date | str | None = None,
    normalize_phone: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """Every raw row cleaned, with what there is to say about it.

    ``_missing`` names the required columns it lacks (none: it is accepted), ``_unreadable`` has a
    bit for each typed column whose text could not be read, ``_spelled`` is the key as it came, and
    ``_raw`` is the whole raw row where it is rejected.
    """
    needed = spec.needed(null_keys)
    blank = F.when(blank_key(spec), F.lit(spec.raw_name(spec.key)))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed], blank))
    rejected = reduce(or_, [F.col(c).isNull() for c in needed], blank_key(spec))
    unreadable = F.lit(0)
    for bit, name in enumerate(spec.typed):
        value = F.col(spec.raw_name(name))
        unreadable = unreadable + F.when(value.isNotNull() & spec.rules[name](value).isNull(), 1 << bit).otherwise(0)
    verdict = [
        missing.alias("_missing"),
        unreadable.alias("_unreadable"),
        F.col(spec.raw_name(spec.key)).alias("_spelled"),
        F.when(rejected, F.struct(*raw.columns)).alias("_raw"),
    ]
    return clean(raw, spec, as_of, normalize_phone, verdict)


def accepted_rows(rows: DataFrame) -> DataFrame:
    """The classified rows fit for curation."""
    return rows.where(F.size("_missing") == 0)


def merge_curated(target: DataFrame, source: DataFrame, spec: CuratedSpec) -> DataFrame:
    """The curated table after the load, with each row's ``action``."""
    return merge_upsert(target.select(*spec.columns), source, [spec.key], spec.on_match)
