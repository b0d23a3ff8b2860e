"""Sums, shares and safe conversions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

AMOUNT_SCALE = 6


def exact_sum(amount: Column, scale: int = AMOUNT_SCALE) -> Column:
    """Sum finite amounts exactly to ``scale`` decimal places.

    A double sum changes in its last digits with the order in which rows meet, and thus
    with every retried task. Here the whole units and the rest, in units of the last
    place, are each summed as longs, which is as fast as a double sum. Amounts that are
    not finite or too large raise instead of turning into a wrong total.
    """
    amount = amount.cast("double")
    whole = F.floor(amount)
    rest = F.rint((amount - whole) * 10**scale).cast("bigint")
    last_place = F.lit(Decimal(1).scaleb(-scale))
    return F.sum(whole).cast("decimal(20, 0)") + F.sum(rest).cast("decimal(20, 0)") * last_place


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two decimals, halves away from zero.

    A zero or missing whole gives NULL.
    """
    return F.round(F.try_divide(part * 100, whole), 2)


def to_number(col: Column) -> Column:
    """Text to double; text that is no finite decimal number (``NaN``, ``12d``) gives NULL."""
    value = col.try_cast("double")
    typed = F.lower(F.right(F.trim(col.cast("string")), F.lit(1))).isin("d", "f")
    return F.when((F.abs(value) < float("inf")) & ~typed, value)


def to_flag(col: Column) -> Column:
    """``true`` or ``false`` in any case to boolean; any other text gives NULL."""
    return F.when(F.lower(F.trim(col.cast("string"))).isin("true", "false"), col.try_cast("boolean"))


def flag_text(col: Column) -> Column:
    """A boolean as ``true``/``false`` text; text that is no boolean is left as it is."""
    text = col.cast("string")
    word = F.lower(F.trim(text))
    return F.when(word.isin("true", "false"), word).otherwise(text)
