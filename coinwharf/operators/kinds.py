"""The narrowest type each text column can have without a value changing.

A type fits a column if every value, read as that type and written again, is the same text. So ``00123``
and ``+911234567890`` stay text (as numbers they would lose their first characters), and so does a
column in which one value does not fit. Of the types that fit, the first in this order counts: long,
decimal, date, timestamp, boolean, text. A column without values fits none and is text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

TEXT = "string"


def _decimal(value: Column) -> Column:
    """Plain decimals of up to 38 digits; with a last place fixed for the column they keep their zeros."""
    return F.regexp_like(value, F.lit(r"^-?(0|[1-9][0-9]*)\.[0-9]+\z")) & (F.length(value) <= 38)


def _fits(value: Column) -> dict[str, Column]:
    """Per type, whether one text comes back as it is."""
    same = lambda typed: F.coalesce(typed.cast("string") == value, F.lit(False))
    return {
        "bigint": same(value.try_cast("bigint")),
        "decimal": _decimal(value),
        "date": same(value.try_cast("date")),
        "timestamp": same(value.try_cast("timestamp")),
        "boolean": same(value.try_cast("boolean")),
    }


def column_kinds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(name, n_values, kind) of each text column; one aggregate over all rows.

    ``kind`` is a type as Spark names it, such as ``decimal(12,2)``.
    """
    columns = list(columns or df.columns)
    parts = []
    for i, name in enumerate(columns):
        value = F.col(name)
        places = F.when(_decimal(value), F.length(F.substring_index(value, ".", -1)))
        digits = F.when(_decimal(value), F.length(F.regexp_replace(F.substring_index(value, ".", 1), "-", "")))
        parts.append(F.count(value).alias(f"n{i}"))
        parts += [F.bool_and(F.when(value.isNotNull(), fit)).alias(f"{kind}{i}") for kind, fit in _fits(value).items()]
        parts += [F.min(places).alias(f"least{i}"), F.max(places).alias(f"most{i}"), F.max(digits).alias(f"digits{i}")]
    row = df.agg(*parts)

    def kind(i: int) -> Column:
        # all values have as many places, so the column's scale writes them back as they were
        decimal = F.col(f"decimal{i}") & (F.col(f"least{i}") == F.col(f"most{i}")) & (F.col(f"digits{i}") + F.col(f"most{i}") <= 38)
        size = F.concat(F.lit("decimal("), (F.col(f"digits{i}") + F.col(f"most{i}")).cast("string"), F.lit(","), F.col(f"most{i}").cast("string"), F.lit(")"))
        chosen = F.when(F.col(f"n{i}") == 0, TEXT).when(F.col(f"bigint{i}"), "bigint").when(decimal, size)
        for other in ("date", "timestamp", "boolean"):
            chosen = chosen.when(F.col(f"{other}{i}"), other)
        return chosen.otherwise(TEXT)

    found = [F.struct(F.lit(name).alias("name"), F.col(f"n{i}").alias("n_values"), kind(i).alias("kind")) for i, name in enumerate(columns)]
    return row.select(F.inline(F.array(*found)))


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The rows with their columns cast to the kinds found."""
    return reduce(lambda rows, name: rows.withColumn(name, F.col(name).cast(kinds[name])), kinds, df)
